"""Phrases whose words stand together more often than chance, by Toivonen's sampling method.

A phrase is frequent if it occurs ``SUPPORT`` times in its language; every part of a frequent phrase is
frequent. A sample is mined level by level with a lowered support and proposes phrases; it draws
pieces of text between punctuation, not documents, so that a phrase repeated in one document is drawn like any
other. One full pass then counts the proposals and their negative border: a run of
words is counted if its first words and its last words (all but one) are both proposed, so the border
is never listed, only met in the texts. This pass adds up by 64-bit hash of the phrase and by a trace of its
words: its size, 16 bits of the last word and 13 of all (a single word's length and first and last byte). The hash of a phrase follows from that of its first
words and its last word and can be taken back by that word, so what reached the support is spelt out size by
size: the last words of that trace lead to first words, and those that are frequent themselves are the phrase's.
The first task of those that hold a frequent word tells its text in the second full pass; and where a phrase of the border turned out to be
frequent, exactly by its words, all it opens: every run not counted yet whose first
and last words are proposed, frequent or opened themselves. No third pass is needed: the parts of a frequent
phrase that the first pass did not count are frequent, so each of them is proposed by now or opened as well.

Sets of phrases reach the tasks as bitmaps of at most ``MOST_BITS`` bits, sized by their number. A
false positive counts a phrase that need not be counted and changes no result. Words are 64-bit
hashes inside phrases, and a phrase is the list of its words' hashes; if two texts of words
that occur ``SUPPORT`` times share a hash, or two phrases a hash and a trace, all is counted again with another one.

Defined cases: NULL text is empty, NULL language ``und``. Repeated rows are documents of their own. Very
long texts are read whole. Without frequent phrases (or without rows) the result is empty. Equal
scores rank by count, then by phrase. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admere.llm.spans import STEP, Codes, gather, grouped, lowered, same
from admere.llm.text import hashes, mix, pieces, runs, tidy
from admere.session import release, stable

#: Words of a phrase at most, occurrences at least, share (in percent) of a part's occurrences within
#: a longer phrase that makes the part redundant, and phrases listed per language.
LONGEST, SUPPORT, PART, TOP = 5, 100, 100, 2000

#: One piece of text in so many is in the sample, of so many bytes at most; the lowered support is so many standard deviations
#: below the mean of a phrase that occurs ``SUPPORT`` times.
RATE, SEGMENT, DEVIATIONS = 4, 192, 3.0

#: Bits of a bitmap of phrases: for each phrase, at least and at most (32 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 28

#: Languages whose totals are broadcast at most.
BROADCAST_ROWS = 50_000

#: Rows of an Arrow batch that goes back, bytes of text counted together, rows added up together,
#: and rows of exact counts a task holds back to add them up.
ROWS, TEXTS, TOTAL_ROWS, HELD_ROWS = 1 << 16, 1 << 22, 1 << 18, 1 << 20

_KEYS = [f"w{k}" for k in range(1, LONGEST + 1)]
_COUNTS = "trace int, lang string, word string, " + ", ".join(f"{k} long" for k in _KEYS) + ", n long"
_HASHED, _PART = "key long, trace int, n long", "part int"
_TRACED = ["trace", "lang", "word", *_KEYS]
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: What undoes the factors of a key: 64-bit inverses.
_UNDO = [np.uint64(pow(x, -1, 1 << 64)) for x in (0x94D049BB133111EB, 0xBF58476D1CE4E5B9, 0x9E3779B97F4A7C15)]


class Phrases:
    """A set of phrases as a bitmap of their keys, which may hold more than it should."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def spots(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The two bits of each key in a bitmap of ``size`` bits, a power of two."""
        last = np.uint64(size - 1)
        return (key & last).astype(np.int64), (mix(key) >> np.uint64(20) & last).astype(np.int64)

    def holds(self, key: np.ndarray) -> np.ndarray:
        out = np.ones(len(key), bool)
        for spot in self.spots(key, len(self.bits) * 8):
            out &= (self.bits[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1
        return out


def _first_keys(words: np.ndarray, langs: np.ndarray) -> np.ndarray:
    # "de" in the language "en" is not "en" in "de"
    return mix(words + mix(langs))


def _next_keys(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(keys * _ODD + words)


def _first_words(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The keys of the phrases that ``words`` made longer to phrases of these keys; undoes :func:`_next_keys`."""
    x = (keys ^ (keys >> np.uint64(31)) ^ (keys >> np.uint64(62))) * _UNDO[0]
    x = (x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))) * _UNDO[1]
    return ((x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))) - words) * _UNDO[2]


def _traces(word: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """16 bits of the last word, 13 of all words and 3 of the size of the phrases at some places."""
    every = np.zeros(len(at), np.uint64)
    for k in range(size):
        every ^= word[at + k] >> np.uint64(16 + 6 * k)
    trace = (word[at + size - 1] & np.uint64(0xFFFF)) << np.uint64(16) | (every & np.uint64(0x1FFF)) << np.uint64(3) | np.uint64(size)
    return trace.astype(np.uint32).view(np.int32)


def _word_traces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Traces of single words, from their bytes."""
    ends = data[start].astype(np.uint64) << np.uint64(24) | data[end - 1].astype(np.uint64) << np.uint64(16)
    trace = ends | ((end - start).astype(np.uint64) & np.uint64(0x1FFF)) << np.uint64(3) | np.uint64(1)
    return trace.astype(np.uint32).view(np.int32)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Rows that differ from the row before."""
    fresh = np.zeros(len(columns[0]), bool)
    fresh[:1] = True
    for values in columns:
        fresh[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(fresh)


def _owned(key: np.ndarray, part: int | np.ndarray) -> np.ndarray:
    """Keys of words as those of one task."""
    return mix(key + np.asarray(part).astype(np.uint64))


def _task() -> int:
    return TaskContext.get().partitionId()


def _lang_hashes(values: list[str]) -> np.ndarray:
    data = [v.encode() for v in values]
    ends = np.cumsum([len(d) for d in data], dtype=np.int64)
    # an empty name has no span of its own
    return np.array([0 if not d else h for d, h in zip(data, _spans(data, ends), strict=True)], np.uint64)


def _spans(data: list[bytes], ends: np.ndarray) -> np.ndarray:
    whole = np.frombuffer(b"".join(data), np.uint8)
    some = np.array([len(d) > 0 for d in data])
    out = np.zeros(len(data), np.uint64)
    out[some] = hashes(whole, (ends - [len(d) for d in data])[some], ends[some])
    return out


def _permuted(salt: int) -> np.ndarray:
    """Bytes in another order, so that the same hash function gives other hashes."""
    return np.arange(256, dtype=np.uint8) if not salt else np.random.default_rng(salt).permutation(256).astype(np.uint8)


_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 32]] = True


def words(column: pa.Array, salt: int = 0) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes of texts; start, end, hash, text and piece number of each word."""
    order, parts, offset, piece = _permuted(salt), [], 0, 0
    for first, _, data, bounds in lowered(column):
        cut = _BREAK[data]
        start, end, text = runs(~(cut | _SPACE[data]), bounds)
        if len(start):
            before = np.cumsum(cut)[start]
            fresh = np.r_[False, (before[1:] != before[:-1]) | (text[1:] != text[:-1])]
            number = (piece + 1 + np.cumsum(fresh)).astype(np.int32)
            piece = int(number[-1])
            parts.append((data, start + offset, end + offset, hashes(order[data], start, end), (text + first).astype(np.int32), number))
        else:
            parts.append((data, start, end, np.zeros(0, np.uint64), text.astype(np.int32), start.astype(np.int32)))
        offset += len(data)
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none, np.zeros(0, np.uint64), none.astype(np.int32), none.astype(np.int32)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs(key: np.ndarray, word: np.ndarray, piece: np.ndarray, longest: int, gate: Phrases, before: Phrases | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of 2 to ``longest`` words whose first and last words ``gate`` holds: size, places, keys, and which are opened.

    A run is opened if ``before`` held its first and last words not; an opened run counts as held for longer ones.
    """
    # where a held phrase of the size before starts; where one that was held before does
    held, old = gate.holds(key), before.holds(key) if before else None
    for size in range(2, longest + 1):
        at = np.flatnonzero(held[:-1] & held[1:] & (piece[: len(held) - 1] == piece[size - 1 :]))
        if not len(at):
            return
        keys = _next_keys(key[at], word[at + size - 1])
        opened = ~(old[at] & old[at + 1]) if before else np.zeros(len(at), bool)
        yield size, at, keys, opened
        if size == longest:
            return
        last = len(held) - 1
        key, held = np.zeros(last, np.uint64), np.zeros(last, bool)
        key[at], held[at] = keys, gate.holds(keys) | opened
        if before:
            old = np.zeros(last, bool)
            old[at[~opened]] = before.holds(keys[~opened])


def _texts(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[tuple]:
    """Groups of texts: bytes, start, end, hash, piece and language number of each word, language names and hashes."""
    for held in grouped(batches, 1, TEXTS):
        codes = Codes()
        code = codes.number([v for b in held for v in b.column(0).to_pylist()]).astype(np.int32)
        data, start, end, word, text, piece = words(pa.concat_arrays([b.column(1) for b in held]), salt)
        if len(word):
            yield data, start, end, word, piece, code[text], codes.values, _lang_hashes(codes.values)
    tidy()


def _hashed(batches: Iterator[pa.RecordBatch], levels: range, gate: Phrases | None, salt: int, part: int) -> Iterator[pa.RecordBatch]:
    """Counts by key and trace of the phrases of ``levels`` words whose first and last words ``gate`` holds; single words always."""
    for data, start, end, word, piece, lang, _, seeds in _texts(batches, salt):
        key = _first_keys(word, seeds[lang])
        longer = _runs(key, word, piece, levels[-1], gate, None) if levels[-1] > 1 else ()
        for size, at, keys, *_ in chain([(1, np.arange(len(key)), key)], longer):
            if size not in levels:
                continue
            order = np.argsort(keys)
            keys, at = keys[order], at[order]
            trace = _traces(word, at, size) if size > 1 else _word_traces(data, start[at], end[at])
            first = _changes(keys, trace)
            n = np.diff(np.r_[first, len(keys)])
            own = pa.array(np.full(len(first), part, np.int32))
            yield from pa.Table.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(trace[first]), pa.array(n), own], names=["key", "trace", "n", "part"]).to_batches(ROWS)


def _resolved(batches: Iterator[pa.RecordBatch], longest: int, gate: Phrases, before: Phrases, wanted: Phrases, salt: int, part: int) -> Iterator[pa.RecordBatch]:
    """The text of the single words that ``wanted`` holds as this task's, and counts by words of the phrases that ``gate`` opens.

    The words of each language are counted in a row without any.
    """
    for data, start, end, word, piece, lang, values, seeds in _texts(batches, salt):
        names = pa.array(values, pa.string())

        def rows(at: np.ndarray, keys: np.ndarray, size: int, n: np.ndarray, texts: pa.Array | None = None, traces: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(at), ROWS):
                some = at[a : a + ROWS]
                none = pa.nulls(len(some), pa.int64())
                trace = pa.array(traces[a : a + ROWS]) if traces is not None else pa.nulls(len(some), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a : a + ROWS].view(np.int64)), trace, names.take(pa.array(lang[some])), texts.slice(a, ROWS) if texts is not None else pa.nulls(len(some), pa.string())]
                    + [pa.array(word[some + k].view(np.int64)) if k < size else none for k in range(LONGEST)]
                    + [pa.array(n[a : a + ROWS])],
                    names=["key", *_TRACED, "n"],
                )

        key = _first_keys(word, seeds[lang])
        mine = np.flatnonzero(wanted.holds(_owned(key, part)))
        mine = mine[np.argsort(key[mine], kind="stable")]
        traces = _word_traces(data, start[mine], end[mine])
        first = _changes(key[mine], traces, lang[mine])
        lead = mine[first]
        yield from rows(lead, key[lead], 1, np.diff(np.r_[first, len(mine)]), gather(data, start[lead], end[lead]), traces[first])
        order, first = same(lang)
        at = lang[order[first]]
        yield from rows(order[first], mix(~seeds[at]), 0, np.diff(np.r_[first, len(order)]))
        del data, start, end
        for size, at, keys, opened in _runs(key, word, piece, longest, gate, before):
            yield from _distinct(at[opened], keys[opened], size, word, lang, rows)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task added up, so that a phrase found in each group of texts goes out once; at most some rows are held."""
    held, size = [], 0

    def added() -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(held).group_by(["key", *_TRACED]).aggregate([("n", "sum")])
        return table.rename_columns({"n_sum": "n"}).select(["key", *_TRACED, "n"]).combine_chunks().to_batches(ROWS)

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size > HELD_ROWS:
            found = added()
            held, size = found, sum(b.num_rows for b in found)
            if size > HELD_ROWS // 2:  # too many distinct ones
                yield from held
                held, size = [], 0
    if held:
        yield from added()


def _distinct(at: np.ndarray, keys: np.ndarray, size: int, word: np.ndarray, lang: np.ndarray, rows) -> Iterator[pa.RecordBatch]:
    """One row per phrase at the places ``at``; phrases of one key but other words stay apart."""
    order, first = same(keys)
    at = at[order]
    fresh = np.zeros(len(at), bool)
    fresh[first] = True
    for k in range(size):
        fresh[1:] |= word[at[1:] + k] != word[at[:-1] + k]
    fresh[1:] |= lang[at[1:]] != lang[at[:-1]]
    first = np.flatnonzero(fresh)
    yield from rows(at[first], keys[order[first]], size, np.diff(np.r_[first, len(at)]))


def _totals(batches: Iterator[pa.RecordBatch], support: int) -> Iterator[pa.RecordBatch]:
    """Phrases that occur ``support`` times, from counts sorted by key.

    Few keys reach the support; only their rows are told apart by language and words.
    """

    def whole() -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < TOTAL_ROWS:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            other = np.flatnonzero(key != key[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
            size -= cut
        if held:
            yield pa.Table.from_batches(held)

    for table in whole():
        key, n = table.column("key").to_numpy(), table.column("n").to_numpy()
        if not len(key):
            continue
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        many = np.repeat(np.add.reduceat(n, first) >= support, np.diff(np.r_[first, len(key)]))
        if many.any():
            found = table.take(pa.array(np.flatnonzero(many))).group_by(_TRACED).aggregate([("n", "sum")])
            found = found.filter(pc.greater_equal(found.column("n_sum"), support)).rename_columns({"n_sum": "n"})
            yield from found.select([*_TRACED, "n"]).to_batches()
    tidy()


def _shared(value):
    """A broadcast bitmap as a set, on the executor."""
    return value and Phrases(value.value)


def hash_counts(texts: DataFrame, levels: range, support: int, gate=None, salt: int = 0) -> DataFrame:
    """Keys, traces and counts of the phrases of ``levels`` words that occur ``support`` times or more, and the first task that holds each; ``gate`` is a broadcast bitmap."""
    counted = texts.mapInArrow(lambda b: _hashed(b, levels, _shared(gate), salt, _task()), f"{_HASHED}, {_PART}")
    return counted.groupBy("key", "trace").agg(F.sum("n").alias("n"), F.min("part").alias("part")).filter(F.col("n") >= support)


def exact_counts(texts: DataFrame, longest: int, support: int, gate, before, many: DataFrame, salt: int = 0) -> DataFrame:
    """The words of ``many``, totals of languages, and opened phrases that occur ``support`` times, counted by their words; see :func:`_resolved`."""
    share = texts.sparkSession.sparkContext.broadcast
    single = many.filter(F.col("trace").bitwiseAND(7) == 1).select("key", "trace", "n", "part")

    def told(keys: DataFrame, longest: int, part: int | None) -> DataFrame:
        owned = keys.mapInArrow(lambda b: _owners(b, part), "key long")
        wanted = share(_bitmap(owned, bitmap_size(keys.count())))
        schema = "key long, " + _COUNTS
        return stable(texts.mapInArrow(lambda b: _gathered(_resolved(b, longest, _shared(gate), _shared(before), _shared(wanted), salt, _task() if part is None else part)), schema))

    def named(rows: DataFrame) -> DataFrame:
        return rows.filter("w1 IS NOT NULL AND w2 IS NULL").drop("n").distinct().join(single.select("key", "trace", "n"), ["key", "trace"])

    counted = told(single, longest, None)
    words_ = stable(named(counted))
    rest = single.join(words_, ["key", "trace"], "left_anti")
    if not rest.isEmpty():
        # the rows were dealt to other tasks than before: every task that holds one of these words tells it
        words_ = words_.unionByName(named(told(rest, 1, 0)).join(rest, ["key", "trace"], "left_semi"))
    others = counted.filter("w1 IS NULL OR w2 IS NOT NULL").repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _totals(b, support), _COUNTS)
    return others.withColumn("key", F.lit(None).cast("long")).unionByName(words_)


def _owners(batches: Iterator[pa.RecordBatch], part: int | None) -> Iterator[pa.RecordBatch]:
    """Keys of words (``key``, ``trace``, ``n``, ``part``) as those of their first task, or of ``part``."""
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        owner = batch.column(3).to_numpy(zero_copy_only=False) if part is None else part
        yield pa.RecordBatch.from_arrays([pa.array(_owned(key, owner).view(np.int64))], names=["key"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of each single word (``lang``, ``w1``)."""
    for batch in batches:
        codes = Codes()
        code = codes.number(batch.column(0).to_pylist())
        seeds = _lang_hashes(codes.values) if codes.values else np.zeros(0, np.uint64)
        word = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_first_keys(word, seeds[code]).view(np.int64))], names=["lang", "w1", "key"])


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of phrases with the key of their first words, if ``w`` is the last one."""
    for batch in batches:
        key, word = (batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64) for name in ("key", "w"))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_first_words(key, word).view(np.int64))], names=[*batch.schema.names, "shorter"])


def spelt(many: DataFrame, single: DataFrame, longest: int) -> DataFrame:
    """The words of frequent phrases, from keys and traces of all their parts and single words (``lang``, ``w1``): ``lang``, ``word`` (null), ``w1`` to ``w5``, ``n``, ``key``, ``trace``."""
    last = stable(single.select(F.col("w1").alias("w"), F.col("w1").bitwiseAND(0xFFFF).cast("int").alias("low")).distinct())
    held = stable(single.select("lang", "w1").mapInArrow(_keyed, "lang string, w1 long, key long"))
    out, size_of = None, F.col("trace").bitwiseAND(7)
    many = many.drop("part")
    for size in range(2, longest + 1):
        found = many.filter(size_of == size).withColumn("low", F.shiftrightunsigned("trace", 16)).join(last, "low").select("key", "trace", "n", "w")
        found = found.mapInArrow(_shortened, f"{_HASHED}, w long, shorter long")
        words_ = [F.col(k) for k in _KEYS[: size - 1]] + [F.col("w").alias(_KEYS[size - 1])]
        found = found.join(held.withColumnRenamed("key", "shorter"), "shorter").select("key", "trace", "n", "lang", *words_)
        every = F.lit(0).cast("long")
        for k, name in enumerate(_KEYS[:size]):
            every = every.bitwiseXOR(F.shiftrightunsigned(name, 16 + 6 * k))
        held = stable(found.filter(every.bitwiseAND(0x1FFF) == F.shiftrightunsigned("trace", 3).bitwiseAND(0x1FFF)))
        none = [F.lit(None).cast("string").alias("word"), *(F.lit(None).cast("long").alias(k) for k in _KEYS[size:])]
        rows = held.select("lang", *_KEYS[:size], *none, "n", "key", "trace")
        out = rows if out is None else out.unionByName(rows)
        held = held.drop("n", "trace")
    return out


def _places(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The bits of keys in a bitmap of ``size`` bits, by block of 2^15."""
    for batch in batches:
        spot = np.concatenate(Phrases.spots(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), size))
        yield pa.RecordBatch.from_arrays([pa.array((spot >> 15).astype(np.int64)), pa.array((spot & 32767).astype(np.int64))], names=["block", "bit"])


def _bitmap(keys: DataFrame, size: int) -> np.ndarray:
    """The bitmap of a table of keys; the driver gets ``size`` bits, whatever their number."""
    blocks = keys.mapInArrow(lambda b: _places(b, size), "block long, bit long")
    out = np.zeros(size // 8, np.uint8)
    for row in blocks.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[row["block"] * 4096 : row["block"] * 4096 + 4096] |= np.frombuffer(row["bits"], np.uint8)
    return out


def bitmap_size(proposals: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(max(1, proposals * BITS_EACH)))))


def lowered_support(support: int, rate: int = RATE, deviations: float = DEVIATIONS) -> int:
    """Occurrences in the sample from which a phrase is proposed."""
    mean = support / rate
    return max(1, math.floor(mean - deviations * math.sqrt(mean)))


def _sampled(batches: Iterator[pa.RecordBatch], rate: int) -> Iterator[pa.RecordBatch]:
    """Texts with one piece in ``rate`` left, drawn by a hash of the row's seed and the piece's place.

    Pieces longer than ``SEGMENT`` bytes are drawn in parts.
    """
    for batch in batches:
        seeds = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        for first, end, data, bounds in pieces(batch.column(1), STEP):
            fresh = _BREAK[data]
            size = np.diff(bounds)
            fresh[bounds[:-1][size > 0]] = True
            # long pieces are cut at a space, where a break takes its place
            at = np.flatnonzero(fresh)
            space = np.flatnonzero(_SPACE[data] & ~fresh)
            start = at[np.searchsorted(at, space, "right") - 1]
            part = (space - start) // SEGMENT
            late = part > np.where(np.r_[False, start[1:] == start[:-1]], np.r_[0, part[:-1]], 0)
            fresh[space[late]] = True
            data = data.copy()
            data[space[late]] = 10
            piece = np.cumsum(fresh) - 1
            at = np.flatnonzero(fresh)
            text = np.searchsorted(bounds, at, "right") - 1
            drawn = mix(seeds[first:end][text] + mix((at - bounds[text]).astype(np.uint64))) % np.uint64(rate) == 0
            taken = drawn[piece] if len(piece) else np.zeros(0, bool)
            ends = np.r_[0, np.cumsum(taken)][bounds].astype(np.int64)
            texts = pa.LargeStringArray.from_buffers(end - first, pa.py_buffer(ends), pa.py_buffer(data[taken]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), texts.cast(pa.string())], names=["lang", "text"])


def draw(texts: DataFrame, seed: Column, rate: int = RATE) -> DataFrame:
    """A sample of the pieces of ``texts`` (``lang``, ``text``); rows of different seeds are drawn independently."""
    return texts.select("lang", "text", seed.alias("seed")).mapInArrow(lambda b: _sampled(b, rate), "lang string, text string")


def proposals(sample: DataFrame, support: int, longest: int, salt: int = 0) -> DataFrame:
    """Keys of phrases of less than ``longest`` words with ``support`` occurrences in the sample, level by level."""
    spark, found, gate = sample.sparkSession, None, None
    for size in range(1, longest):
        level = stable(hash_counts(sample, range(size, size + 1), support, gate, salt).select("key"))
        found = level if found is None else found.union(level)
        if size == longest - 1 or not level.count():
            return found
        gate = spark.sparkContext.broadcast(_bitmap(found, bitmap_size(found.count())))
    return found


def frequent(texts: DataFrame, sample: DataFrame, support: int = SUPPORT, longest: int = LONGEST, rate: int = RATE, salt: int = 0) -> tuple[DataFrame, int]:
    """All phrases of ``texts`` (``lang``, ``text``) with ``support`` occurrences, counted exactly; and the border's failures.

    Rows without words hold the number of words of a language; ``key`` and ``trace`` are those a phrase was spelt out from.
    """
    share = texts.sparkSession.sparkContext.broadcast
    proposed = proposals(sample, lowered_support(support, rate), longest, salt)
    size = bitmap_size(proposed.count())
    bits = _bitmap(proposed, size)
    gate = share(bits)
    many = stable(hash_counts(texts, range(1, longest + 1), support, gate, salt))
    failures = many.join(proposed, "key", "left_anti").count()
    wider = share(bits | _bitmap(many, size))
    exact = stable(exact_counts(texts, longest, support, wider, gate, many, salt))
    phrases = spelt(many, exact.filter("w1 IS NOT NULL AND w2 IS NULL"), longest)
    return exact.unionByName(phrases), failures


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    part: int = PART,
    top: int = TOP,
    rate: int = RATE,
    id: str = "doc_id",
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, its count ``a``, those of its two parts ``l`` and ``r``, the words ``n`` and ``score``."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"), F.xxhash64(id, text).alias("seed"))
    texts = read.drop("seed")
    sample = stable(draw(read, F.col("seed"), rate))
    salt = 0
    while True:
        every, _ = frequent(texts, sample, support, longest, rate, salt)
        counts = stable(every)
        single = counts.filter("w1 IS NOT NULL AND w2 IS NULL").groupBy("lang", "w1").count()
        traced = counts.filter("trace IS NOT NULL").groupBy("key", "trace").count()
        if not single.select("count").union(traced.select("count")).filter("count > 1").limit(1).count():
            break
        salt += 1
    release(sample)
    return ranked(counts, part, top)


def ranked(counts: DataFrame, part: int = PART, top: int = TOP) -> DataFrame:
    """Scores, drops and ranks the phrases of a written table of counts that holds all parts of each."""
    found = counts.filter("w1 IS NOT NULL").select("lang", "word", F.array_compact(F.array(*_KEYS)).alias("g"), "n")
    totals = stable(counts.filter("w1 IS NULL").select("lang", "n"))
    few = F.broadcast(totals) if totals.count() <= BROADCAST_ROWS else totals
    candidates = found.filter(F.size("g") > 1).select("lang", "g", F.col("n").alias("a"))
    # A longer phrase that holds most of a shorter one also holds one of a word more that does.
    longer = candidates.filter(F.size("g") > 2)
    ends = [F.slice("g", 1, F.size("g") - 1), F.slice("g", F.lit(2), F.size("g") - 1)]
    inner = longer.select("lang", F.explode(F.array(*ends)).alias("g"), "a").groupBy("lang", "g").agg(F.max("a").alias("most"))
    kept = candidates.join(inner, ["lang", "g"], "left").filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * part)).drop("most")
    cut = F.explode(F.sequence(F.lit(1), F.size("g") - 1))
    cuts = kept.withColumn("k", cut).select("*", F.slice("g", F.lit(1), F.col("k")).alias("left"), F.slice("g", F.col("k") + 1, F.size("g") - F.col("k")).alias("right"))
    sides = found.select("lang", F.col("g").alias("side"), "n")
    cuts = cuts.join(sides.select("lang", F.col("side").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(sides.select("lang", F.col("side").alias("right"), F.col("n").alias("r")), ["lang", "right"]).join(few, "lang")
    scored = cuts.select("lang", "g", "a", "n", F.struct(score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"))
    scored = scored.groupBy("lang", "g", "a", "n").agg(F.min("cut").alias("cut")).select("lang", "g", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a")]
    best = stable(scored.withColumn("tie", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("tie") <= top).drop("tie"))
    names = found.filter(F.size("g") == 1).select("lang", F.col("g")[0].alias("w"), "word")
    spelt = (
        best.select("lang", "g", F.posexplode("g").alias("at", "w")).join(names, ["lang", "w"])
        .groupBy("lang", "g")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    listed = best.join(spelt, ["lang", "g"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return listed.withColumn("rank", place).filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """``floor(1000 a n / (l r))``, exact."""
    long = "decimal(19,0)"
    above = (F.lit(1000).cast("decimal(4,0)") * (a.cast("decimal(16,0)") * n.cast("decimal(17,0)")).cast("decimal(34,0)")).cast("decimal(38,0)")
    below = (left.cast(long) * right.cast(long)).cast("decimal(38,0)")
    return F.call_function("div", above, below)


#: The same in SQL, for the query.
ORACLE = rf"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
),
pieces AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM docs),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY 1),
runs AS (
  SELECT lang, w[i:i + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, {LONGEST + 1}) s(k) WHERE len(w) >= k)
),
counts AS (SELECT lang, g, count(*) AS c FROM runs GROUP BY 1, 2 HAVING count(*) >= {SUPPORT}),
candidates AS (SELECT lang, g, c AS a FROM counts WHERE len(g) > 1),
inner_parts AS (
  SELECT lang, g[i:i + k - 1] AS g, max(a) AS most
  FROM (SELECT lang, g, a, k, unnest(range(1, len(g) - k + 2)) AS i FROM candidates, range(2, {LONGEST}) s(k) WHERE len(g) > k) GROUP BY 1, 2
),
kept AS (SELECT c.* FROM candidates c LEFT JOIN inner_parts p ON p.lang = c.lang AND p.g = c.g WHERE p.most IS NULL OR 100 * p.most < {PART} * c.a),
cuts AS (
  SELECT x.lang, x.g, x.a, x.k, l.c AS l, r.c AS r, t.n, (1000::HUGEINT * x.a * t.n) // (l.c::HUGEINT * r.c) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM kept) x
  JOIN counts l ON l.lang = x.lang AND l.g = x.g[1:x.k] JOIN counts r ON r.lang = x.lang AND r.g = x.g[x.k + 1:] JOIN totals t ON t.lang = x.lang
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM scored)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {TOP}
"""
