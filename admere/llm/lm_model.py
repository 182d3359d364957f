"""A byte model of words: bit predictors in hashed contexts, mixed by gated logistic weights.

A word is its bytes and a space; the end of a text is a line end. Bytes are written in a
prefix code of bits (Huffman, from the bytes of the vocabulary), so all bit decisions
together make one probability for every word, and these add up to one.

Each bit is predicted in several contexts: the last one to four bytes of the word, and
all of it so far. A context and a place in the code give a slot of a hashed table with
the zeros and ones counted there. The predictions are mixed in the logistic domain by
weights that a gate picks, the gate being how well the longer contexts are known. A last
map refines the mix by what followed equal mixes.

The first byte of a word has the word before as its context: two predictors, what followed
that word and what begins words at all, are mixed and refined the same way, the gate being
how often the word before was met on this way through the code (:class:`Starts`).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from admere.llm.text import mix

#: Log2 of the slots of each table: contexts of one to four bytes, and the whole word so far.
BITS = (16, 18, 19, 20, 21)
TABLES = len(BITS)
OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in BITS])])
SLOTS = int(OFFSETS[-1])
#: Slots of a block, in which tables travel.
BLOCK = 1 << 14
#: Added to both counts of a slot.
PRIOR = 0.05
_EDGES = np.array([1, 2, 3, 5, 9, 17, 65, 257, 1025, 4097], np.float32)
_MIDDLE = np.array([1, 4, 33], np.float32)
GATES = (len(_EDGES) + 1) * (len(_MIDDLE) + 1)
#: Steps of the refining map, from -LIMIT to LIMIT in the logistic domain.
STEPS, LIMIT = 33, 12.0
#: Bit decisions learnt from at a time.
BATCH = 1 << 14
#: Curvature that the first weights are held by, in decisions.
FIRM = 100.0
SPACE, END = 32, 10


@dataclass(frozen=True)
class Code:
    """For every byte, the places in the code tree it passes and the bits it takes there."""

    length: np.ndarray
    start: np.ndarray
    node: np.ndarray
    bit: np.ndarray


def code(frequency: np.ndarray) -> Code:
    """The prefix code for bytes of these frequencies; every byte has a word in it."""
    heap = [(int(f) + 1, i, i) for i, f in enumerate(frequency)]
    heapq.heapify(heap)
    up: dict[int, tuple[int, int]] = {}
    fresh = 256
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        up[x], up[y] = (fresh, 0), (fresh, 1)
        heapq.heappush(heap, (a + b, fresh, fresh))
        fresh += 1
    paths = []
    for byte in range(256):
        path, at = [], byte
        while at in up:
            at, bit = up[at]
            path.append((at - 256, bit))
        paths.append(path[::-1])
    length = np.array([len(p) for p in paths])
    flat = np.array([step for p in paths for step in p])
    return Code(length, np.concatenate([[0], np.cumsum(length)[:-1]]), flat[:, 0], flat[:, 1])


@dataclass(frozen=True)
class Events:
    """Bit decisions of words: slots in all tables (one row each), the bit, and the word."""

    slots: np.ndarray
    bit: np.ndarray
    word: np.ndarray


def events(words: list[bytes], coding: Code, rest: bool = False) -> Events:
    """All bit decisions of some words, or of their ``rest`` after the first byte, each followed by a space; the end of a text by nothing."""
    data = np.frombuffer(b"".join([w if w == b"\n" else w + b" " for w in words]), np.uint8).astype(np.uint64)
    size = np.array([len(w) + (w != b"\n") for w in words])
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(data)) - first[owner]
    past = []
    for back in range(1, 5):
        value = np.zeros(len(data), np.uint64)
        value[back:] = data[:-back] + np.uint64(1)
        value[place < back] = 0
        past.append(value)
    contexts = [past[0]]
    for value in past[1:]:
        contexts.append((contexts[-1] << np.uint64(9)) | value)
    # all of the word so far: a sum of mixed bytes and places, taken up to each byte
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix((data << np.uint64(32)) + place.astype(np.uint64) + np.uint64(1)), dtype=np.uint64)])
    contexts.append(total[:-1] - total[first][owner])
    contexts = [mix(c + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) for k, c in enumerate(contexts)]
    byte = data.astype(np.int64)
    each = coding.length[byte]
    if rest:
        each[place == 0] = 0
    source = np.repeat(np.arange(len(data)), each)
    at = (coding.start[byte] - np.cumsum(each) + each)[source] + np.arange(len(source))
    node, bit = coding.node[at], coding.bit[at].astype(np.float32)
    spread = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))[node]
    slots = np.empty((TABLES, len(at)), np.int64)
    for k, bits in enumerate(BITS):
        value = contexts[k][source]
        value ^= spread
        value *= np.uint64(0x9E3779B97F4A7C15)
        value >>= np.uint64(64 - bits)
        np.add(value.view(np.int64), OFFSETS[k], out=slots[k])
    return Events(slots, bit, owner[source])


def count(found: Events, weight: np.ndarray, table: np.ndarray) -> None:
    """Add the words' decisions, as often as each word occurs, to the two counts of their slots."""
    each = weight[found.word].astype(table.dtype)
    index = found.slots * 2 + found.bit.astype(np.int64)
    for k in range(TABLES - 1):
        np.add.at(table, index[k], each)
    # a word met once says nothing of its own about how it goes on
    often = each > 1
    np.add.at(table, index[-1][often], each[often])


def _stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Mixer:
    """Weights for every gate with how firmly they are known, and the refining map.

    ``bend`` is the curvature of all decisions so far, which sets how far a new one
    moves the weights; ``hits`` and ``visits`` are the ones and decisions of each step of the map.
    """

    weights: np.ndarray
    bend: np.ndarray
    hits: np.ndarray
    visits: np.ndarray

    @classmethod
    def starts(cls) -> Mixer:
        """A mixer of the two predictors of a word's first byte."""
        grid = _squash(np.linspace(-LIMIT, LIMIT, STEPS))
        trust = np.linspace(0.2, 1.0, len(_EDGES) + 1)
        n = len(trust)
        return cls(np.stack([trust, 1.2 - trust], axis=1), np.tile(np.eye(2) * FIRM, (n, 1, 1)), np.tile(grid * 20, (n, 1)), np.full((n, STEPS), 20.0))

    @classmethod
    def fresh(cls) -> Mixer:
        grid = _squash(np.linspace(-LIMIT, LIMIT, STEPS))
        weights = np.full((GATES, TABLES), 0.25)
        # the better the whole word so far is known, the more it says
        trust = np.repeat(np.linspace(0.2, 1.0, len(_EDGES) + 1), len(_MIDDLE) + 1)
        weights[:, :-1] *= (1.2 - trust)[:, None]
        weights[:, -1] = trust
        return cls(weights, np.tile(np.eye(TABLES) * FIRM, (GATES, 1, 1)), np.tile(grid * 20, (GATES, 1)), np.full((GATES, STEPS), 20.0))

    def to_bytes(self) -> bytes:
        return b"".join(a.astype(np.float64).tobytes() for a in (self.weights, self.bend, self.hits, self.visits))

    @classmethod
    def read(cls, raw: bytes, gates: int = GATES, tables: int = TABLES) -> Mixer:
        shapes = [(gates, tables), (gates, tables, tables), (gates, STEPS), (gates, STEPS)]
        edges = np.cumsum([0, *(int(np.prod(s)) for s in shapes)])
        flat = np.frombuffer(raw, np.float64)
        return cls(*(flat[a:b].reshape(s).copy() for a, b, s in zip(edges, edges[1:], shapes, strict=False)))

    @classmethod
    def joined(cls, mixers: list[Mixer], start: Mixer | None = None) -> Mixer:
        """One mixer of several that learnt apart from ``start``: weights as firmly as each knows them."""
        start = start or cls.fresh()
        bend = start.bend + sum(m.bend - start.bend for m in mixers)
        force = np.einsum("gij,gj->gi", start.bend, start.weights)
        force = force + sum(np.einsum("gij,gj->gi", m.bend, m.weights) - force for m in mixers)
        weights = np.linalg.solve(bend, force[:, :, None])[:, :, 0]
        return cls(weights, bend, start.hits + sum(m.hits - start.hits for m in mixers), start.visits + sum(m.visits - start.visits for m in mixers))

    def mix(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("kn,nk->n", inputs, self.weights.astype(np.float32)[gate]), -LIMIT, LIMIT)

    def refine(self, mixed: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """The mean of the mix and what the map makes of it, between the two nearest steps."""
        spot = (mixed + LIMIT) * ((STEPS - 1) / (2 * LIMIT))
        low = np.minimum(spot.astype(np.int64), STEPS - 2)
        part = spot - low
        grid = (self.hits / self.visits).astype(np.float32)
        found = grid[gate, low] * (1 - part) + grid[gate, low + 1] * part
        return np.clip(0.5 * (_squash(mixed) + found), 1e-7, 1 - 1e-7)


    def move(self, inputs: np.ndarray, gate: np.ndarray, mixed: np.ndarray, bit: np.ndarray, own: np.ndarray) -> None:
        """Move the weights by one step of Newton's method along some decisions, and add these to the map."""
        gates, tables = self.weights.shape
        p = _squash(mixed)
        pull, curve = (bit - p) * own, np.maximum(p * (1 - p), 1e-6) * own
        for j in range(tables):
            bent = curve * inputs[j]
            for k in range(j + 1):
                part = np.bincount(gate, weights=bent * inputs[k], minlength=gates)
                self.bend[:, j, k] += part
                if j != k:
                    self.bend[:, k, j] += part
        force = np.stack([np.bincount(gate, weights=pull * x, minlength=gates) for x in inputs], axis=1)
        self.weights += np.linalg.solve(self.bend, force[:, :, None])[:, :, 0]
        near = np.minimum(np.rint((mixed + LIMIT) * ((STEPS - 1) / (2 * LIMIT))).astype(np.int64), STEPS - 1)
        spot = gate * STEPS + near
        self.hits += np.bincount(spot, weights=own * bit, minlength=gates * STEPS).reshape(gates, STEPS)
        self.visits += np.bincount(spot, weights=own, minlength=gates * STEPS).reshape(gates, STEPS)


def _gates(long: np.ndarray, middle: np.ndarray) -> np.ndarray:
    return np.searchsorted(_EDGES, long, "right") * (len(_MIDDLE) + 1) + np.searchsorted(_MIDDLE, middle, "right")


def learn(found: Events, weight: np.ndarray, table: np.ndarray, mixer: Mixer) -> None:
    """Move weights and map along the words' decisions, each predicted from the others' counts.

    One occurrence of the word itself is taken off the counts first, so that the mixer
    learns from words as new as those it will meet.
    """
    pairs = table.reshape(-1, 2)
    total = weight[found.word].astype(np.float32)
    for low in range(0, len(found.bit), BATCH):
        cut = slice(low, low + BATCH)
        bit, own = found.bit[cut], total[cut]
        counts = pairs.take(found.slots[:, cut], axis=0)
        zeros, ones = (counts[:, :, k].astype(np.float32) for k in (0, 1))
        # the last table holds no word met once
        once = np.where(total[cut] > 1, np.float32(1), np.float32(0))
        for met, itself in ((ones, bit), (zeros, 1 - bit)):
            met[:-1] -= itself
            met[-1] -= itself * once
            np.maximum(met, 0, out=met)
        inputs = np.log((ones + PRIOR) / (zeros + PRIOR))
        gate = _gates(ones[4] + zeros[4], ones[3] + zeros[3])
        mixed = mixer.mix(inputs, gate)
        mixer.move(inputs, gate, mixed, bit, own)


class Starts:
    """First bytes of words after other words: what was counted, and how it is mixed."""

    def __init__(self, coding: Code, counts: np.ndarray, mixer: Mixer):
        self.code, self.mixer = coding, mixer
        node, bit, byte, _ = self._steps(np.arange(256))
        self.all = np.zeros((256, 2))
        np.add.at(self.all, (node, bit), counts[byte].astype(np.float64))

    def _steps(self, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place, bit, byte and row of every decision on the way to some bytes."""
        each = self.code.length[byte]
        row = np.repeat(np.arange(len(byte)), each)
        at = self.code.start[byte][row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        return self.code.node[at], self.code.bit[at], byte[row], row

    def _met(self, before: np.ndarray, byte: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        node, bit, _, row = self._steps(byte)
        place = before[row] * 256 + node
        size = (int(before.max()) + 1) * 512 if len(before) else 0
        table = np.bincount(place * 2 + bit, weights=count[row], minlength=size).reshape(-1, 2)
        return node, bit, row, table[place]

    @staticmethod
    def _inputs(own: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inputs = np.stack([np.log((c[:, 1] + PRIOR) / (c[:, 0] + PRIOR)) for c in (own, every)])
        return inputs, np.searchsorted(_EDGES, own.sum(axis=1), "right")

    def learn(self, before: np.ndarray, byte: np.ndarray, count: np.ndarray) -> None:
        """Move the mixer along first bytes met ``count`` times after words, each predicted from the other times."""
        some = count > 0
        before, byte, count = before[some], byte[some], count[some].astype(np.float64)
        node, bit, row, met = self._met(before, byte, count)
        itself = np.stack([1.0 - bit, bit], axis=1)
        for low in range(0, len(bit), BATCH):
            cut = slice(low, low + BATCH)
            inputs, gate = self._inputs(np.maximum(met[cut] - itself[cut], 0), np.maximum(self.all[node[cut]] - itself[cut], 0))
            self.mixer.move(inputs, gate, self.mixer.mix(inputs, gate), bit[cut].astype(np.float64), count[row[cut]])

    def score(self, before: np.ndarray, byte: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Log10 of the probability of each first byte after its word; all that followed a word stands in one call."""
        node, bit, row, met = self._met(before, byte, count.astype(np.float64))
        inputs, gate = self._inputs(met, self.all[node])
        p = self.mixer.refine(self.mixer.mix(inputs, gate), gate)
        return np.bincount(row, weights=np.log10(np.where(bit > 0, p, 1 - p)), minlength=len(byte))

    def first(self) -> np.ndarray:
        """Log10 of the probability of each byte where no word stands before."""
        return self.score(np.zeros(256, np.int64), np.arange(256), np.zeros(256))


class Scorer:
    """A finished model: what each slot predicts, ready to look up."""

    def __init__(self, coding: Code, table: np.ndarray, mixer: Mixer):
        pairs = table.reshape(-1, 2).astype(np.float32)
        self.code, self.mixer = coding, mixer
        self.input = np.log((pairs[:, 1] + PRIOR) / (pairs[:, 0] + PRIOR))
        self.total = pairs.sum(axis=1)
        # what the slots of the last two tables add to the gate
        middle, whole = self.total[OFFSETS[3] : OFFSETS[4]], self.total[OFFSETS[4] :]
        self.gate = np.zeros(SLOTS, np.int8)
        self.gate[OFFSETS[3] : OFFSETS[4]] = _gates(np.zeros(1, np.float32), middle)
        self.gate[OFFSETS[4] :] = _gates(whole, np.zeros(1, np.float32))

    def words(self, words: list[bytes], rest: bool = False) -> np.ndarray:
        """Log10 of the probability of each word, or of its ``rest`` once its first byte is known."""
        out = np.zeros(len(words))
        for low, part in _parts(words):
            found = events(part, self.code, rest)
            gate = self.gate[found.slots[4]].astype(np.int64) + self.gate[found.slots[3]]
            p = self.mixer.refine(self.mixer.mix(self.input[found.slots], gate), gate)
            cost = np.log10(np.where(found.bit > 0, p, 1 - p))
            out[low : low + len(part)] = np.bincount(found.word, weights=cost, minlength=len(part))
        return out


def _parts(words: list[bytes], limit: int = 1 << 17) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of words of about ``limit`` bytes, and where each begins."""
    first, size = 0, 0
    for i, word in enumerate(words):
        size += len(word) + 1
        if size >= limit:
            yield first, words[first : i + 1]
            first, size = i + 1, 0
    if first < len(words):
        yield first, words[first:]


def parts(words: list[bytes], weight: np.ndarray, coding: Code) -> Iterator[tuple[Events, np.ndarray]]:
    """Decisions of many words, a bounded number at a time, with the words' weights."""
    for low, part in _parts(words):
        yield events(part, coding), weight[low : low + len(part)]
