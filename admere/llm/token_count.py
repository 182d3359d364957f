"""Token counts with a tokenizer compiled into finite-state transducers.

The cutting pattern becomes a deterministic transducer over classes of characters: a
table of next states, and one that says on which transitions a word begins. Texts are
run through it as one long stream, in chunks: a chunk's map gives the state it ends in
for every state it may begin in, maps are composed by a parallel prefix scan, and then
all chunks run side by side from the states the scan found. Words become arcs of a second
transducer, built as they turn up: each distinct word of a batch is folded once by the
vocabulary's ranked merges, and its arc emits as many tokens as symbols are left. A
text's count is the sum over its arcs.

Made for tokenizers whose file names these parts: composed and lower-cased text, cut into
known endings, letters, single numerals and other characters, bytes as symbols with a mark at a word's end.
:func:`tokenizer_file` refuses others.

Defined results: NULL and empty texts have no tokens. Special strings of the vocabulary
inside a text count one token each and end words. Extra columns come through whatever
their names.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.llm.merges import LETTER, NUMBER, SPACE, Merges, classes, fold_spans
from admere.llm.text import hashes, pieces

#: Most tokens of a text that is not over the limit.
LIMIT = 2048
#: Characters of a chunk.
CHUNK = 256
#: The cutting pattern that the transducer stands for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

# classes of characters: the last eight are letters of their own
_BLANK, _LETTER, _NUMERAL, _SIGN, _QUOTE = range(5)
_OWN = "stmdrvle"
_CLASSES = 5 + len(_OWN)
# states: between words, in letters, in signs, after a quote that begins a word, after a quote and r, v or l
_FREE, _WORD, _SIGNS, _QUOTED, _R, _V, _L = range(7)
_STATES = 7
#: What a transition says about words: none, one begins here, one began a character ago, both.
_NO, _HERE, _LATE, _BOTH = range(4)


@functools.cache
def transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and word mark for each state and class."""
    to = np.zeros((_STATES, _CLASSES), np.int8)
    mark = np.zeros((_STATES, _CLASSES), np.int8)
    letters = [_LETTER, *range(5, _CLASSES)]
    for state in range(_STATES):
        pending = state in (_R, _V, _L)
        for symbol in range(_CLASSES):
            if symbol == _BLANK:
                next_state, begins = _FREE, False
            elif symbol in letters:
                next_state, begins = _WORD, state != _WORD and not pending
            elif symbol == _NUMERAL:
                next_state, begins = _FREE, True
            elif state in (_SIGNS, _QUOTED):
                next_state, begins = _SIGNS, False
            else:
                next_state, begins = (_QUOTED if symbol == _QUOTE else _SIGNS), True
            to[state, symbol] = next_state
            mark[state, symbol] = (_HERE if begins else _NO) | (_LATE if pending else _NO)
    own = {c: 5 + i for i, c in enumerate(_OWN)}
    for c in "stmd":
        to[_QUOTED, own[c]], mark[_QUOTED, own[c]] = _FREE, _NO
    for c, state, last in (("r", _R, "e"), ("v", _V, "e"), ("l", _L, "l")):
        to[_QUOTED, own[c]], mark[_QUOTED, own[c]] = state, _NO
        to[state, own[last]], mark[state, own[last]] = _FREE, _NO
    return to, mark


def scan(maps: np.ndarray) -> np.ndarray:
    """Composition of each map with all before it: rows are maps from state to state."""
    out = maps.copy()
    step = 1
    while step < len(out):
        later = np.take_along_axis(out[step:], out[:-step].astype(np.int64), axis=1)
        out = np.concatenate([out[:step], later])
        step *= 2
    return out


def run(symbols: np.ndarray) -> np.ndarray:
    """Whether a word begins at each character of a stream that ends with a blank."""
    to, mark = transducer()
    n = len(symbols)
    width = -(-n // CHUNK)
    grid = np.zeros(width * CHUNK, np.int64)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(width, CHUNK).T)
    flat = to.ravel().astype(np.int64)
    ends = np.broadcast_to(np.arange(_STATES), (width, _STATES)).copy()
    for column in grid:
        ends = flat[ends * _CLASSES + column[:, None]]
    state = np.concatenate([[_FREE], scan(ends.astype(np.int8))[:-1, _FREE]]).astype(np.int64)
    marks = np.zeros((CHUNK, width), np.int8)
    said = mark.ravel()
    for k, column in enumerate(grid):
        arc = state * _CLASSES + column
        marks[k] = said[arc]
        state = flat[arc]
    marks = marks.T.ravel()[:n]
    begins = (marks & _HERE) > 0
    begins[:-1] |= (marks[1:] & _LATE) > 0
    return begins


@functools.cache
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and class of every code point."""
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x20000):
        low = chr(i).lower() if not 0xD800 <= i < 0xE000 else ""
        if len(low) == 1:
            lower[i] = ord(low)
    out = np.full(0x110000, _SIGN, np.uint8)
    kind = classes()
    out[kind == LETTER] = _LETTER
    out[kind == NUMBER] = _NUMERAL
    out[kind == SPACE] = _BLANK
    out[ord("'")] = _QUOTE
    for i, c in enumerate(_OWN):
        out[ord(c)] = 5 + i
    return lower, out


def _byte_names() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if it prints, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Tokenizer:
    """Tables of one tokenizer file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.single = np.array([vocab[c] for c in _byte_names()], np.int64)
        self.final = np.array([vocab[c + end] for c in _byte_names()], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        first = {}
        for rank, (a, b) in enumerate(pairs):
            first.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        table = np.array([(a, b, r, c) for (a, b), (r, c) in first.items()], np.int64).reshape(-1, 4)
        self.merges = Merges(*table.T)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.mark = [t.encode() for t in special]

    def _prepared(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts without special strings and composed; the text of each part; special strings of each text."""
        n = len(bounds) - 1
        extra = np.zeros(n, np.int64)
        whole = data.tobytes()
        odd = np.zeros(n, bool)
        # code points from U+0300 on may compose, and one before them has two lower-case ones
        high = np.flatnonzero((data >= 0xCC) | (data == 0xC4))
        odd[np.searchsorted(bounds, high, "right") - 1] = True
        for text in self.mark:
            at = whole.find(text)
            while at >= 0:
                odd[np.searchsorted(bounds, at, "right") - 1] = True
                at = whole.find(text, at + 1)
        if not odd.any():
            return data, bounds, np.arange(n), extra
        parts, owner = [], []
        for i in range(n):
            text = whole[bounds[i] : bounds[i + 1]]
            if not odd[i]:
                parts.append(text)
                owner.append(i)
                continue
            pieces_of = self.special.split(text.decode("utf-8", "replace")) if self.special else [text.decode("utf-8", "replace")]
            extra[i] = len(pieces_of) - 1
            for piece in pieces_of:
                parts.append(unicodedata.normalize("NFC", piece).replace("İ", "i̇").encode())
                owner.append(i)
        edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return np.frombuffer(b"".join(parts), np.uint8), edges, np.array(owner), extra

    def count(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        data, bounds, owner, total = self._prepared(data, bounds)
        if not len(data):
            return total
        lower, kind = _symbols()
        # a line end after each part keeps their words apart
        stream = np.insert(data, bounds[1:], 10)
        points = lower[np.frombuffer(stream.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
        stream = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        symbols = kind[points]
        begins = run(symbols)
        place = np.flatnonzero((stream & 0xC0) != 0x80)
        # a word ends where the next one begins or a blank stands
        stops = np.flatnonzero(begins | (symbols == _BLANK))
        start = stops[begins[stops]]
        if not len(start):
            return total
        end = np.append(stops[1:], len(points))[begins[stops]]
        sizes = np.add.reduceat(np.append((data & 0xC0) != 0x80, False).astype(np.int64), bounds[:-1]) * (np.diff(bounds) > 0)
        part = np.searchsorted(np.cumsum(sizes + 1), start, "right")
        first_byte, last_byte = place[start], np.append(place, len(stream))[end]
        _, first, which = np.unique(hashes(stream, first_byte, last_byte), return_index=True, return_inverse=True)
        a, b = first_byte[first], last_byte[first]
        letters = self.single[stream]
        letters[b - 1] = self.final[stream[b - 1]]
        _, edges = fold_spans(self.merges, letters, a, b - a)
        emitted = np.diff(edges)[which]
        return total + np.bincount(owner[part], weights=emitted, minlength=len(total)).astype(np.int64)


class TokenizerFile:
    """A tokenizer file on its way to the tasks, equal to any other of the same content."""

    def __init__(self, content: bytes):
        self.content = content
        self.digest = hashlib.sha256(content).hexdigest()

    def __eq__(self, other: object) -> bool:
        return isinstance(other, TokenizerFile) and self.digest == other.digest

    def __hash__(self) -> int:
        return hash(self.digest)

    def tokenizer(self) -> Tokenizer:
        """The compiled tokenizer, made once in a worker process."""
        return _tokenizer(self)


@functools.lru_cache(maxsize=2)
def _tokenizer(file: TokenizerFile) -> Tokenizer:
    return Tokenizer(file.content)


def tokenizer_file(path: str) -> TokenizerFile:
    """Read a tokenizer file; ValueError if its parts are not those the transducers stand for."""
    with open(path, "rb") as file:
        content = file.read()
    spec = json.loads(content)
    steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    cutting = [c["pattern"]["Regex"] for c in cuts if c["type"] == "Split"]
    if steps != ["NFC", "Replace", "Lowercase"] or cutting != [PATTERN] or not spec["model"].get("end_of_word_suffix") or any(t["normalized"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} is not a tokenizer of the kind compiled here")
    return TokenizerFile(content)


def count_tokens(df: DataFrame, file: TokenizerFile, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each text; all other columns come through."""
    own = [f"c{i}" for i in range(len(df.columns))]
    where = df.columns.index(text)
    spec = ", ".join([f"{c} {f.dataType.simpleString()}" for c, f in zip(own, df.schema, strict=True)] + ["added long"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(batch.num_rows, np.int64)
            for a, b, data, bounds in pieces(batch.column(where), 1 << 20):
                total[a:b] = file.tokenizer().count(data, bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total)], names=[*own, "added"])

    return df.toDF(*own).mapInArrow(count, spec).toDF(*df.columns, name)


def count_documents(docs: DataFrame, file: TokenizerFile, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the limit."""
    counted = count_tokens(docs.select("doc_id", "text"), file)
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
