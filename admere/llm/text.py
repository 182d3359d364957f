"""Whole texts as byte arrays: words, lines and their 64-bit hashes, a batch at a time.

Spark hands Python Arrow batches; the functions here work on the UTF-8 bytes of many
texts at once, so no loop runs per word. A word is a run of bytes other than space
and the five control characters 0x09 to 0x0D, everywhere in this package.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; a single longer text is still handled whole.
PIECE = 1 << 20

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
_VALUE = np.random.default_rng(20260101).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every other."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column of strings or bytes into runs of about ``limit`` bytes: first row, end row, bytes, bounds.

    Bounds holds one more entry than rows: where each text starts in the bytes. NULL
    counts as empty.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, where, data = column.buffers()
    at = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end
    tidy()


@functools.cache
def _trim() -> Callable[[int], int]:
    """The C library's way to give freed memory back; nothing where it has none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def tidy() -> None:
    """Give freed memory back, since a worker that waits for its next task keeps it otherwise."""
    _trim()(0)
    pa.default_memory_pool().release_unused()


def gaps(data: np.ndarray) -> np.ndarray:
    """Which bytes lie between words."""
    return _GAP[data]


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of marked bytes; no run crosses a text's bounds."""
    n = len(inside)
    fresh, last = np.ones(n + 1, bool), np.ones(n + 1, bool)
    fresh[1:n] = ~inside[: n - 1]
    last[: max(n - 1, 0)] = ~inside[1:n]
    fresh[bounds] = True
    last[bounds[bounds > 0] - 1] = True
    start = np.flatnonzero(inside & fresh[:n])
    end = np.flatnonzero(inside & last[:n]) + 1
    edges = np.concatenate([[0], np.searchsorted(start, bounds), [len(start)]])
    return start, end, np.repeat(np.arange(-1, len(bounds)), np.diff(edges))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] = 1
    inside[end] -= 1
    covered = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    taken = _VALUE[data[covered]]
    first = np.zeros(len(start), np.int64)
    np.cumsum(length[:-1], out=first[1:])
    place = np.arange(len(taken)) - np.repeat(first, length)
    powers = np.cumprod(np.full(int(length.max()), _BASE, np.uint64), dtype=np.uint64)
    return mix(np.add.reduceat(taken * powers[place], first) + length.astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word."""
    return runs(~_GAP[data], bounds)


def together(values: np.ndarray) -> np.ndarray:
    """Places in an order in which equal numbers (64 bits, not negative) stand together, first places first."""
    values = values.astype(np.uint64, copy=False)
    bits = max(len(values) - 1, 1).bit_length()
    shift, place = np.uint64(bits), np.arange(len(values), dtype=np.uint64)
    mask = (np.uint64(1) << shift) - np.uint64(1)
    if not len(values) or int(values.max()).bit_length() + bits <= 64:
        return (np.sort((values << shift) | place) & mask).astype(np.int64)
    # long numbers make room for the place, so that plain numbers are sorted
    order = (np.sort((values & ~mask) | place) & mask).astype(np.int64)
    found = values[order]
    if (((found[1:] ^ found[:-1]) & ~mask == 0) & (found[1:] != found[:-1])).any():
        return np.argsort(values, kind="stable")
    return order


def windows(values: np.ndarray, texts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` consecutive values of one text, and where it starts."""
    if len(values) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(values) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out + values[k : k + n] * np.uint64(2 * k + 1))
    at = np.flatnonzero(texts[:n] == texts[size - 1 :])
    return out[at], at
