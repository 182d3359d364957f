"""Byte-level byte-pair encoding and decoding of whole texts.

A text is cut by the vocabulary's pattern, and every cut piece is folded on its own:
start from single bytes and merge the neighbouring pair of lowest rank until none has
one. Within an Arrow batch every distinct piece is folded once, all of them side by side
(:mod:`admere.llm.merges`), and the ids are put back in the order of the texts. Ids are
little-endian unsigned 32-bit numbers; decoding puts their byte strings end to end.

Defined results: NULL and empty texts have no ids and decode to no bytes. Very long
pieces are folded with a heap. Extra columns come through whatever their names.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.llm.merges import LETTER, OTHER, SPACE, Merges, classes, codes, fold_spans
from admere.llm.text import hashes, pieces

#: The cutting pattern that is also built as array operations; any other goes through its regular expression.
USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def cut(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the matches of :data:`USUAL` begin; each ends where the next one, or its text, does."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    fresh = first[:n].copy()
    fresh[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(fresh)
    end = np.append(start[1:], n)
    what = kind[start]
    followed = ~first[end]
    begins = fresh
    # the last blank of a run goes by itself, or with what follows if it is a plain space
    blank = (what == SPACE) & followed
    begins[end[blank] - 1] = True
    plain = blank & (points[end - 1] == 32)
    begins[end[plain]] = False
    # a lone apostrophe with a known ending, unless a plain space goes with it
    alone = (what == OTHER) & (end - start == 1) & (points[start] == 39) & followed
    after_plain = np.zeros(len(start), bool)
    after_plain[1:] = plain[:-1]
    at = np.flatnonzero(alone & ~after_plain)
    at = at[what[at + 1] == LETTER] if len(at) else at
    if len(at):
        here, stop = start[at] + 1, end[at + 1]
        one, two = points[here], np.where(here + 1 < stop, points[np.minimum(here + 1, n - 1)], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for a, b in ("re", "ve", "ll"):
            size = np.where((one == ord(a)) & (two == ord(b)), 2, size)
        here, stop, size = here[size > 0], stop[size > 0], size[size > 0]
        begins[here] = False
        rest = here + size
        begins[rest[rest < stop]] = True
    return np.flatnonzero(begins)


class Vocabulary:
    """Byte strings by rank, their merges, and the pattern that cuts texts."""

    def __init__(self, file: bytes, pattern: str):
        ranks = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in file.splitlines() if line.strip())}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        size = max(ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        self.start = np.zeros(size, np.int64)
        ordered = sorted(ranks, key=ranks.get)
        self.blob = np.frombuffer(b"".join(ordered), np.uint8)
        number = np.array([ranks[w] for w in ordered])
        self.length[number] = [len(w) for w in ordered]
        ends = np.cumsum(self.length[number])
        self.start[number] = ends - self.length[number]
        # a piece that is a word as a whole needs no merges
        name = hashes(self.blob, self.start[number], ends)
        order = np.argsort(name)
        self.names, self.named = name[order], number[order]
        found = [(ranks[w[:i]], ranks[w[i:]], r) for w, r in ranks.items() for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks]
        left, right, into = np.array(found, np.int64).reshape(-1, 3).T
        self.merges = Merges(left, right, into, into)
        self.pattern = None if pattern == USUAL else regex.compile(pattern)

    def _cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where pieces begin and end."""
        if self.pattern is None:
            points, edges, begins = codes(data, bounds)
            start = begins[cut(points, edges)]
            return start, np.append(start[1:], len(data))[: len(start)]
        found: list[int] = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            text = data[a:b].tobytes().decode("utf-8", "replace")
            place = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]) + a
            found.extend(int(place[x]) for m in self.pattern.finditer(text) if m.end() > m.start() for x in m.span())
        spans = np.array(found, np.int64).reshape(-1, 2)
        return spans[:, 0], spans[:, 1]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the bounds of each text's."""
        start, end = self._cut(data, bounds)
        name, first, place = np.unique(hashes(data, start, end), return_index=True, return_inverse=True)
        start_of, length = start[first], (end - start)[first]
        spot = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        whole = self.names[spot] == name
        ids, edges = fold_spans(self.merges, self.single[data], start_of[~whole], length[~whole])
        # words known as a whole come behind the folded ones
        size = np.ones(len(name), np.int64)
        size[~whole] = np.diff(edges)
        at = np.zeros(len(name), np.int64)
        at[~whole] = edges[:-1]
        at[whole] = len(ids) + np.arange(int(whole.sum()))
        ids = np.concatenate([ids, self.named[spot[whole]]])
        each = size[place]
        stop = np.concatenate([[0], np.cumsum(each)])
        flat = ids[np.repeat(at[place] - stop[:-1], each) + np.arange(stop[-1])]
        return flat.astype("<u4"), stop[np.searchsorted(start, bounds)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows of ids one after another, and the bounds of each row's."""
        each = self.length[ids]
        stop = np.concatenate([[0], np.cumsum(each)])
        return self.blob[np.repeat(self.start[ids] - stop[:-1], each) + np.arange(stop[-1])], stop[bounds]


@functools.lru_cache(maxsize=2)
def _vocabulary(file: VocabularyFile) -> Vocabulary:
    return Vocabulary(file.content, file.pattern)


class VocabularyFile:
    """A file of ranks on its way to the tasks, equal to any other of the same content."""

    def __init__(self, content: bytes, pattern: str):
        self.content, self.pattern = content, pattern
        self.digest = hashlib.sha256(content + pattern.encode()).hexdigest()

    def __eq__(self, other: object) -> bool:
        return isinstance(other, VocabularyFile) and self.digest == other.digest

    def __hash__(self) -> int:
        return hash(self.digest)

    def vocabulary(self) -> Vocabulary:
        """The vocabulary with its tables, made once in a worker process."""
        return _vocabulary(self)


def vocabulary_file(path: str, pattern: str) -> VocabularyFile:
    """Read a file of ranks; its size is that of the vocabulary."""
    with open(path, "rb") as file:
        return VocabularyFile(file.read(), pattern)


def _map(df: DataFrame, column: str, names: list[str], change: Callable[[np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]) -> DataFrame:
    """Add binary columns made of the bytes of ``column``; the other columns come through."""
    own = [f"c{i}" for i in range(len(df.columns))]
    added = [f"added{i}" for i in range(len(names))]
    where = df.columns.index(column)
    spec = ", ".join([f"{c} {f.dataType.simpleString()}" for c, f in zip(own, df.schema, strict=True)] + [f"{a} binary" for a in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, bounds in pieces(batch.column(where)):
                columns = []
                for value, edges in change(data, bounds):
                    buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(value))]
                    columns.append(pa.Array.from_buffers(pa.large_binary(), b - a, buffers).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *columns], names=[*own, *added])

    return df.toDF(*own).mapInArrow(run, spec).toDF(*df.columns, *names)


def encode(df: DataFrame, file: VocabularyFile, text: str = "text", name: str = "ids") -> DataFrame:
    """Add the ids of each text, as bytes of little-endian unsigned 32-bit numbers."""

    def change(data: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        ids, edges = file.vocabulary().encode(data, bounds)
        return [(ids, edges * 4)]

    return _map(df, text, [name], change)


def decode(df: DataFrame, file: VocabularyFile, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that ids stand for."""
    return _map(df, ids, [name], lambda data, bounds: [file.vocabulary().decode(np.frombuffer(data.tobytes(), "<u4"), bounds // 4)])


def round_trip(df: DataFrame, file: VocabularyFile, text: str = "text", names: tuple[str, str] = ("ids", "decoded")) -> DataFrame:
    """Add the ids of each text and what they decode to, in one pass, so with one Python worker a task."""

    def change(data: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        ids, edges = file.vocabulary().encode(data, bounds)
        return [(ids, edges * 4), file.vocabulary().decode(ids, edges)]

    return _map(df, text, list(names), change)


def digest_documents(docs: DataFrame, file: VocabularyFile) -> DataFrame:
    """Number of tokens of every document, and digests of its ids and of what they decode to."""
    coded = round_trip(docs.select("doc_id", "text"), file)
    count = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return coded.select("doc_id", count, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def tokenize(docs: DataFrame, file: VocabularyFile) -> DataFrame:
    """Ids of every document and whether they decode to its text."""
    coded = round_trip(docs.select("doc_id", "lang", "source", "text"), file)
    exact = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", exact.alias("exact"))
