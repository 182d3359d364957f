"""Spans of bytes in groups of texts: batches put together, lower case, and strings of chosen spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from admere.llm.text import pieces

#: Bytes of text looked at together, and hashed at a time.
GROUP, STEP = 1 << 24, 1 << 21


def grouped(batches: Iterator[pa.RecordBatch], text: int, limit: int = GROUP) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists that hold about ``limit`` bytes of the column ``text``; a longer batch stays whole."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def lowered(column: pa.Array, limit: int = STEP) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Like :func:`admere.llm.text.pieces`, with A-Z in lower case and nothing else changed."""
    for first, end, data, bounds in pieces(column, limit):
        yield first, end, np.where((data >= 65) & (data <= 90), data | 32, data), bounds


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as an array of strings."""
    length = end - start
    to = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=to[1:])
    at = np.arange(to[-1]) + np.repeat(start - to[:-1], length)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(to), pa.py_buffer(data[at])).cast(pa.string())


def same(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal keys side by side, earlier ones first, and where each run of equal keys starts in it."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    return order, np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]] if len(ranked) else np.zeros(0, bool))


class Codes:
    """Numbers for values in the order they first turn up."""

    def __init__(self) -> None:
        self.values: list = []
        self._at: dict = {}

    def number(self, values: list) -> np.ndarray:
        out = np.empty(len(values), np.int64)
        for i, value in enumerate(values):
            at = self._at.get(value)
            if at is None:
                at = self._at[value] = len(self.values)
                self.values.append(value)
            out[i] = at
        return out
