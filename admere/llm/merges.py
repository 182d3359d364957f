"""Ranked pair merges over many words at once, and what texts are cut into before.

Words are rows of a matrix of symbol numbers. Each round every unfinished row merges its
neighbouring pair of lowest rank, the leftmost of equals, so a batch of distinct words
takes as many rounds as its longest chain of merges, not a loop per word.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

#: Widths of the matrices that words are sorted into; a longer word is folded by itself.
WIDTHS = (8, 16, 32, 64)
_NONE = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Merges:
    """Pairs of symbols with a rank and the symbol they merge into, as a hash table."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, into: np.ndarray):
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(max(len(key), 1) * 2 + 1)))))
        size = 1 << (64 - int(self.shift))
        self.size = size
        self.key = np.full(size, np.uint64(2**64 - 1))
        self.rank = np.full(size, _NONE, np.int32)
        self.into = np.full(size, -1, np.int32)
        todo = np.arange(len(key))
        slot = (key * _SPREAD >> self.shift).astype(np.int64)
        while len(todo):
            # of several keys that want a free slot the first gets it
            free = self.key[slot[todo]] == np.uint64(2**64 - 1)
            _, first = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][first]
            self.key[slot[won]], self.rank[slot[won]], self.into[slot[won]] = key[won], rank[won], into[won]
            done = np.zeros(len(key), bool)
            done[won] = True
            todo = todo[~done[todo]]
            slot[todo] = (slot[todo] + 1) % size
        self.pairs = {(int(a), int(b)): (int(r), int(i)) for a, b, r, i in zip(left, right, rank, into, strict=True)}

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; a rank beyond all others if it never merges."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = (key * _SPREAD >> self.shift).astype(np.int64)
        held = self.key[slot]
        todo = np.flatnonzero((held != key) & (held != np.uint64(2**64 - 1)))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % self.size
            held = self.key[slot[todo]]
            todo = todo[(held != key[todo]) & (held != np.uint64(2**64 - 1))]
        hit = self.key[slot] == key
        return np.where(hit, self.rank[slot], _NONE), self.into[slot]


def fold(merges: Merges, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row as far as it goes: what is left of each, at its front, and how much.

    ``symbols`` is one word a row, ``length`` of them from the left; the rest is ignored.
    """
    out, left_over = symbols.copy(), length.copy()
    width = symbols.shape[1]
    place = np.arange(width)
    row = np.flatnonzero(length > 1)
    word, size = symbols[row], length[row]
    rank = np.full((len(row), max(width - 1, 1)), _NONE, np.int32)
    into = np.full((len(row), max(width - 1, 1)), -1, np.int32)
    if width > 1:
        live = place[None, 1:] < size[:, None]
        rank[live], into[live] = merges.find(word[:, :-1][live], word[:, 1:][live])
    while len(row):
        at = rank.argmin(axis=1)
        each = np.arange(len(row))
        more = rank[each, at] < _NONE
        if not more.all():
            over = ~more
            out[row[over]], left_over[row[over]] = word[over], size[over]
            row, word, size, rank, into, at = row[more], word[more], size[more], rank[more], into[more], at[more]
            each = np.arange(len(row))
            if not len(row):
                break
        word[each, at] = into[each, at]
        # what stands behind the pair moves one place to the left
        source = np.minimum(place[None, :] + (place[None, :] > at[:, None]), width - 1)
        word = np.take_along_axis(word, source, axis=1)
        size = size - 1
        source = np.minimum(place[None, :-1] + (place[None, :-1] > at[:, None]), width - 2)
        rank, into = np.take_along_axis(rank, source, axis=1), np.take_along_axis(into, source, axis=1)
        rank[place[None, 1:] >= size[:, None]] = _NONE
        for k in (at - 1, at):
            some = np.flatnonzero((k >= 0) & (k + 1 < size))
            if len(some):
                rank[some, k[some]], into[some, k[some]] = merges.find(word[some, k[some]], word[some, k[some] + 1])
    return out, left_over


def fold_long(merges: Merges, symbols: list[int]) -> list[int]:
    """The same for one long word, with a heap: time grows little faster than its length."""
    import heapq

    n = len(symbols)
    value: list[int] = list(symbols)
    gone = bytearray(n)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs = merges.pairs
    heap = [(found[0], i, value[i], value[i + 1]) for i in range(n - 1) if (found := pairs.get((value[i], value[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        # an entry made before one of its two symbols changed no longer fits
        if gone[i] or j >= n or value[i] != left or value[j] != right:
            continue
        value[i] = pairs[left, right][1]
        gone[j] = 1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < n and (found := pairs.get((value[a], value[after[a]]))) is not None:
                heapq.heappush(heap, (found[0], a, value[a], value[after[a]]))
    return [v for v, g in zip(value, gone, strict=True) if not g]


def fold_spans(merges: Merges, symbols: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fold spans of one long array of symbols: all results one after another, and their bounds."""
    n = len(start)
    size = np.zeros(n, np.int64)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    low = 0
    for width in WIDTHS:
        some = np.flatnonzero((length > low) & (length <= width))
        low = width
        if len(some):
            place = np.minimum(start[some][:, None] + np.arange(width)[None, :], len(symbols) - 1)
            rows, left = fold(merges, symbols[place].astype(np.int32), length[some].astype(np.int64))
            size[some] = left
            parts.append((some, rows, left))
    long = {int(i): np.array(fold_long(merges, symbols[start[i] : start[i] + length[i]].tolist()), np.int64) for i in np.flatnonzero(length > low)}
    for i, value in long.items():
        size[i] = len(value)
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    out = np.zeros(int(bounds[-1]), np.int64)
    for some, rows, left in parts:
        live = np.arange(rows.shape[1])[None, :] < left[:, None]
        out[(bounds[some][:, None] + np.arange(rows.shape[1])[None, :])[live]] = rows[live]
    for i, value in long.items():
        out[bounds[i] : bounds[i + 1]] = value
    return out, bounds


#: Classes of characters that cutting tells apart.
LETTER, NUMBER, SPACE, OTHER = range(4)


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for low in range(0, 0x110000, 0x10000):
        text = "".join(map(chr, range(low, low + 0x10000))) if low else "".join(map(chr, [*range(0xD800), *([0x10FFFF] * 0x800), *range(0xE000, 0x10000)]))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for found in regex.finditer(pattern, text):
                out[low + found.start() : low + found.end()] = kind
    return out


def codes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, the bounds of the texts among them, and where each begins in the bytes."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    if len(begins) != len(points):
        raise ValueError("the text is not valid UTF-8")
    begins = np.append(begins, len(data))
    return points, np.searchsorted(begins, bounds), begins
