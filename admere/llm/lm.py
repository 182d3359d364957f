"""Language-model scores of whole texts: logistic context mixing, learnt on one part of a table.

1. Words, and the first bytes of what follows each, are counted over the whole table, those
   to learn from apart.
2. Every partition of the vocabulary adds its words' bit decisions, as often as each word
   occurs, to hashed tables of counts (:mod:`admere.llm.lm_model`); the tables, of fixed
   size, are added up. What follows a word stays with the word, so it grows with the corpus.
3. The vocabulary is cut by a hash of the word into parts of about ``PART`` words. Every part
   learns mixing weights and the refining map online, in the order of the hash, each word
   predicted without itself; parts are joined by how firmly each knows its weights.
4. Every distinct word gets its probability once its first byte is known, and the
   probability of each first byte that follows it anywhere.
5. Texts are scored: the first byte of a word by the word before, its rest by the word model,
   mixed with the word's share of the text's words so far that begin alike (``CACHE``), so
   a text that repeats itself becomes likelier as it goes.

Words of a share above 1 in ``COMMON`` of all tokens, and first bytes after such a word of a share
above 1 in ``PAIRS * COMMON``, so at most that many of each, travel to the tasks that read the texts; the others of
a text, added up first, are joined with the vocabulary in a shuffle where no word holds more
than that share. What is learnt never depends on the texts held out, and scores depend
neither on the order of rows nor on how many partitions or executors there are.

The text scored is its lower-cased words, each followed by a space, and an end; its
probability is one of all such texts. Bits per byte is over these bytes.

Defined results: NULL and empty texts are an end alone. Rows without id are neither held
out nor learnt from. Rows equal in id and text are scored alike. With nothing to learn
from, counts are 0 and the model is the untrained one. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admere.llm import lm_model
from admere.llm.langid import fold
from admere.llm.text import hashes, mix, pieces, together, words
from admere.session import release, stable

#: Weight of the text's own words in a prediction.
CACHE = 0.2
#: Words that may travel to every task, at most, and pairs of one and a first byte after it for each of these.
COMMON, PAIRS = 1 << 20, 8
#: Mixers that reach the driver, at most.
MERGES = 16
#: Words that one mixer learns from, on average, and words it takes in at a time.
PART, CHUNK = 1 << 16, 1 << 12
#: Bytes whose words are counted together.
PIECE = 8 << 20


def _lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Spans of bytes as strings."""
    size = end - start
    stop = np.concatenate([[0], np.cumsum(size)])
    flat = data[np.repeat(start - stop[:-1], size) + np.arange(stop[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(stop.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.string())


def _following(data: np.ndarray, start: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The first byte of the word after each word; the end's after the last of a text."""
    out = np.full(len(start), lm_model.END)
    same = np.flatnonzero(text[1:] == text[:-1])
    out[same] = data[start[same + 1]]
    return out


def _fresh(values: np.ndarray) -> np.ndarray:
    """Which values differ from the one before."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _since(fresh: np.ndarray) -> np.ndarray:
    """How many places each place comes after the last marked one."""
    place = np.arange(len(fresh))
    return place - np.maximum.accumulate(np.where(fresh, place, 0))


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Small batches put together to about ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each batch; per first byte after one: the byte, occurrences in texts to learn from, and all."""
    for rows in _gathered(batches, PIECE):
        learnt = rows.column(1).to_numpy()
        for a, b, data, bounds in pieces(rows.column(0).combine_chunks(), PIECE):
            data = _lower(data)
            start, end, text = words(data, bounds)
            if not len(start):
                continue
            name = hashes(data, start, end)
            order = together(name)
            begun = _fresh(name[order])
            first = order[begun]
            key = np.empty(len(name), np.int64)
            key[order] = (np.cumsum(begun) - 1) * 256
            key += _following(data, start, text)
            order = together(key)
            head = np.flatnonzero(_fresh(key[order]))
            met = key[order[head]]
            total = np.diff(np.append(head, len(order)))
            own = np.add.reduceat(learnt[a:b][text][order].astype(np.int64), head)
            edges = np.searchsorted(met >> 8, np.arange(len(first) + 1))
            yield pa.RecordBatch.from_arrays([_strings(data, start[first], end[first]), _pack(edges, met & 255, own, total)], names=["word", "after"])


def _pack(edges: np.ndarray, byte: np.ndarray, own: np.ndarray, total: np.ndarray) -> pa.Array:
    """What follows each word, between the edges, in two numbers an entry: all occurrences with the byte, and those learnt from."""
    raw = np.stack([total << 8 | byte, own], axis=1).astype(np.int64)
    where = (edges * 16).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(where), pa.py_buffer(raw)]).cast(pa.binary())


def _unpack(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """How many entries each word has, and their bytes and counts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    _, where, raw = column.buffers()
    where = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    pairs = np.frombuffer(raw, np.uint8)[where[0] : where[-1]].view(np.int64).reshape(-1, 2) if raw is not None else np.zeros((0, 2), np.int64)
    return np.diff(where) // 16, [pairs[:, 0] & 255, pairs[:, 1].copy(), pairs[:, 0] >> 8]


def _add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hash as one row per word, wherever batches begin."""
    held: tuple | None = None

    def rows(word: pa.Array, size: np.ndarray, byte: np.ndarray, own: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        edges = np.concatenate([[0], np.cumsum(size)])
        sums = [pa.array(np.add.reduceat(c, edges[:-1]) if len(size) else c) for c in (own, total)]
        return pa.RecordBatch.from_arrays([word.cast(pa.string()), *sums, _pack(edges, byte, own, total)], names=["word", "own", "total", "after"])

    for batch in batches:
        if not batch.num_rows:
            continue
        word, name = batch.column(0).cast(pa.large_string()), batch.column(2).to_numpy()
        size, values = _unpack(batch.column(1))
        if held:
            word, name, size = pa.concat_arrays([held[0], word]), np.append(held[1], name), np.append(held[2], size)
            values = [np.concatenate(pair) for pair in zip(held[3:], values, strict=True)]
        fresh = _fresh(name)
        group, first = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
        other = np.zeros(len(word), bool)
        other[1:] = pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
        if (other & ~fresh).any():
            # different words of one hash
            code = word.dictionary_encode().indices.to_numpy().astype(np.int64)
            _, first, group = np.unique(group * len(word) + code, return_index=True, return_inverse=True)
        key = np.repeat(group, size) * 256 + values[0]
        order = together(key)
        head = np.flatnonzero(_fresh(key[order]))
        met = key[order[head]]
        byte, own, total = met & 255, *(np.add.reduceat(v[order], head) for v in values[1:])
        size = np.bincount(met >> 8, minlength=len(first))
        # words of the last hash may go on
        kept = int(np.count_nonzero(name[first] != name[-1]))
        cut = int(size[:kept].sum())
        word = word.take(pa.array(first))
        held = (word.slice(kept), name[first[kept:]], size[kept:], byte[cut:], own[cut:], total[cut:])
        yield rows(word.slice(0, kept), size[:kept], byte[:cut], own[:cut], total[:cut])
    if held:
        yield rows(held[0], *held[2:])


def vocabulary(docs: DataFrame, text: str, learnt: Column) -> DataFrame:
    """Every word with its occurrences, those in texts to learn from, and, packed, both for each first byte ``after`` it."""
    rows = docs.select(F.col(text).alias("text"), learnt.alias("learnt"))
    # one row a word and piece of text; a word's rows meet once, whatever follows it
    counted = rows.mapInArrow(_count, "word string, after binary").repartition("word")
    counted = counted.withColumn("name", F.xxhash64("word")).sortWithinPartitions("name")
    return counted.mapInArrow(_add_words, "word string, own long, total long, after binary")


def _word_bytes(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column(0).cast(pa.binary()).to_pylist()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the distinct words, then how often a word begins with each byte."""
    total = np.zeros(512, np.int64)
    for batch in batches:
        own = batch.column(1).to_numpy()
        for a, b, data, bounds in pieces(batch.column(0)):
            total[:256] += np.bincount(data, minlength=256)
            total[lm_model.SPACE] += len(bounds) - 1
            np.add.at(total[256:], data[bounds[:-1]], own[a:b])
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and their occurrences."""
    for batch in batches:
        yield _word_bytes(batch), batch.column(1).to_numpy().astype(np.float64)


def _tables(batches: Iterator[pa.RecordBatch], coding: lm_model.Code) -> Iterator[pa.RecordBatch]:
    # whole numbers, exact up to 2^53
    table = np.zeros(lm_model.SLOTS * 2)
    for found, weight in _weighted(batches):
        for events, each in lm_model.parts(found, weight, coding):
            lm_model.count(events, each, table)
    rows = table.reshape(-1, lm_model.BLOCK * 2)
    some = np.flatnonzero(rows.any(axis=1))
    for block in some:
        yield pa.RecordBatch.from_arrays([pa.array([int(block)], pa.int32()), pa.array([_packed(rows[block])], pa.binary())], names=["block", "counts"])


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes each as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max())))


def _packed(counts: np.ndarray) -> bytes:
    return _narrow(counts).tobytes()


def _unpacked(raw: bytes | pa.Buffer) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // (lm_model.BLOCK * 2)}").astype(np.float64)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: the sum of its rows in all partitions."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            value = _unpacked(counts.as_py())
            total[block] = total[block] + value if block in total else value
    for block, value in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([_packed(value)], pa.binary())], names=["block", "counts"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows sorted by part as runs of ``CHUNK`` rows of one part, wherever batches begin."""
    held: list[pa.RecordBatch] = []
    part, rows = 0, 0
    for batch in batches:
        ids = batch.column(0).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a == b:
                continue
            if held and int(ids[a]) != part:
                yield part, pa.Table.from_batches(held)
                held, rows = [], 0
            part = int(ids[a])
            while a < b:
                take = min(b - a, CHUNK - rows)
                held.append(batch.slice(a, take))
                a, rows = a + take, rows + take
                if rows == CHUNK:
                    yield part, pa.Table.from_batches(held)
                    held, rows = [], 0
    if held:
        yield part, pa.Table.from_batches(held)


def _after(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, list[pa.Array]]:
    """What stands after each word: the word's place in the column, and next bytes and counts."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(lists)), size), lists.flatten().flatten()


def _join_mixers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mixers of each group as one, joined in the order of their parts."""
    groups: dict[int, list[tuple[int, bytes, bytes]]] = {}
    for batch in batches:
        for part, raw, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            groups.setdefault(part % MERGES, []).append((part, raw, starts))
    for group, found in sorted(groups.items()):
        found.sort()
        mixer = lm_model.Mixer.joined([lm_model.Mixer.read(raw) for _, raw, _ in found])
        starts = _join_starts([raw for _, _, raw in found])
        yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([mixer.to_bytes()]), pa.array([starts.to_bytes()])], names=_MIXERS)


def _join_starts(raw: list[bytes]) -> lm_model.Mixer:
    start = lm_model.Mixer.starts()
    return lm_model.Mixer.joined([lm_model.Mixer.read(r, *start.weights.shape) for r in raw], start)


_MIXERS = ["part", "mixer", "starts"]


class Model:
    """What was learnt, and the totals that go with it."""

    def __init__(self, coding: lm_model.Code, table: np.ndarray, mixer: lm_model.Mixer, starts: lm_model.Starts, tokens: int, distinct: int, ends: int):
        self.coding, self.table, self.mixer, self.starts = coding, table, mixer, starts
        self.tokens, self.distinct, self.ends = tokens, distinct, ends

    def base(self, count: float | np.ndarray) -> np.ndarray:
        return np.log10((count + 1.0) / (self.tokens + 1.0 * (self.distinct + 1)))


def train(vocab: DataFrame, ends: int) -> Model:
    """Learn from a vocabulary; tables of fixed size pass through the driver. Without ``after`` no order is learnt."""
    spark = vocab.sparkSession
    known = vocab.filter("own > 0").select("word", "own", *(c for c in vocab.columns if c == "after"))
    totals = known.agg(F.coalesce(F.sum("own"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    sums = known.select("word", "own").mapInArrow(_frequencies, "total binary").collect()
    frequency, firsts = sum((np.frombuffer(p.total, np.int64) for p in sums), np.zeros(512, np.int64)).reshape(2, 256)
    frequency[lm_model.END] += 1
    firsts[lm_model.END] += ends
    coding = lm_model.code(frequency)
    found = known.mapInArrow(lambda b: _tables(b, coding), "block int, counts binary").repartition("block").mapInArrow(_add_up, "block int, counts binary")
    table = np.zeros((lm_model.SLOTS * 2 // (lm_model.BLOCK * 2), lm_model.BLOCK * 2))
    for row in found.collect():
        table[row.block] = _unpacked(row.counts)
    table = table.ravel()
    last, times = lm_model.events([b"\n"], coding), np.array([float(ends)])
    if ends:
        lm_model.count(last, times, table)
    shared = spark.sparkContext.broadcast(_narrow(table))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        at, mixer, starts = -1, None, None

        def learnt() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([mixer.to_bytes()]), pa.array([starts.mixer.to_bytes()])], names=_MIXERS)

        for part, rows in _chunks(batches):
            if part != at:
                if mixer:
                    yield learnt()
                at, mixer, starts = part, lm_model.Mixer.fresh(), lm_model.Starts(coding, firsts, lm_model.Mixer.starts())
            words_ = rows.column("word").cast(pa.binary()).to_pylist()
            for events, each in lm_model.parts(words_, rows.column("own").to_numpy().astype(np.float64), coding):
                lm_model.learn(events, each, counts, mixer)
            if "after" in rows.column_names:
                size, (byte, own, _) = _unpack(rows.column("after"))
                starts.learn(np.repeat(np.arange(len(size)), size), byte, own)
        if mixer:
            yield learnt()

    # the parts follow from the words alone; a tree of two levels, so that few mixers reach the driver from any number of parts
    parts = max(1, -(-int(totals.v) // PART))
    order = F.xxhash64("word")
    cut = known.select(F.pmod(order, F.lit(parts)).cast("int").alias("part"), "*").repartition("part").sortWithinPartitions("part", order, "word")
    schema = "part int, mixer binary, starts binary"
    some = cut.mapInArrow(learn, schema).repartition(MERGES, F.col("part") % MERGES).mapInArrow(_join_mixers, schema)
    found = sorted((row.part, bytes(row.mixer), bytes(row.starts)) for row in some.collect())
    mixers = [lm_model.Mixer.read(raw) for _, raw, _ in found]
    shared.destroy()
    if ends:
        # learnt from once, whatever the number of parts
        own = lm_model.Mixer.fresh()
        lm_model.learn(last, times, table, own)
        mixers.append(own)
    mixer = lm_model.Mixer.joined(mixers)
    starts = lm_model.Starts(coding, firsts, _join_starts([raw for _, _, raw in found]))
    return Model(coding, table, mixer, starts, int(totals.n) + ends, int(totals.v) + bool(ends), ends)


def _scored(vocab: DataFrame, model: Model) -> DataFrame:
    """The vocabulary with the log10 probability of each word's rest, its hash, and that of each first byte after it."""
    shared = vocab.sparkSession.sparkContext.broadcast((model.coding, _narrow(model.table), model.mixer, model.starts))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            *tables, starts = shared.value
            scorer = scorer or lm_model.Scorer(*tables)
            name = [hashes(data, bounds[:-1], bounds[1:]) for _, _, data, bounds in pieces(batch.column(0))]
            size, (byte, own, total) = _unpack(batch.column(3))
            log_p = pa.array(starts.score(np.repeat(np.arange(len(size)), size), byte, own))
            edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            after = pa.StructArray.from_arrays([pa.array(byte, pa.int32()), pa.array(total), log_p], names=["next", "total", "log_p"])
            after = pa.ListArray.from_arrays(pa.array(edges), after)
            rest = pa.array(scorer.words(_word_bytes(batch), rest=True))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], rest, pa.array(np.concatenate(name).view(np.int64)), after], names=["word", "own", "total", "log_p", "name", "after"]
            )

    return vocab.mapInArrow(score, "word string, own long, total long, log_p double, name long, after array<struct<next:int,total:long,log_p:double>>")


def _texts(common: tuple[np.ndarray, ...], model_base: Callable[[np.ndarray], np.ndarray], begin: np.ndarray, end_base: float, ends: int):
    """Per text one row with what its common words and its end add up to, and one per other word.

    A common word followed by a first byte that is not common after it has such a row too, with no occurrences.
    """
    names, count, log_p, pairs, pair_p = common
    base, chance = model_base(count), 10.0**log_p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, bounds in pieces(batch.column(2)):
                n, data = b - a, _lower(data)
                start, end, text = words(data, bounds)
                name = hashes(data, start, end)
                each = np.bincount(text, minlength=n)
                follow = _following(data, start, text)
                # how many words of the text so far begin like this one
                alike = text * 256 + data[start]
                sorted_ = together(alike)
                place = np.empty(len(text), np.int64)
                place[sorted_] = _since(_fresh(alike[sorted_]))
                opening = np.full(n, lm_model.END)
                heads = np.flatnonzero(np.diff(text, prepend=-1))
                opening[text[heads]] = data[start[heads]]
                # by word, then by text
                order = together(name)
                same = name[order]
                begun = _fresh(same)
                fresh = begun | _fresh(text[order])
                head = np.flatnonzero(fresh)
                group = np.cumsum(fresh) - 1
                before = _since(fresh)
                at = place[order]
                again = CACHE * before / np.maximum(at, 1)
                scale = np.where(at > 0, 1 - CACHE, 1.0)
                first = order[head]
                distinct, kind = same[begun], np.cumsum(begun)[head] - 1
                if len(names):
                    spot = np.minimum(np.searchsorted(names, distinct), len(names) - 1)
                    spot, usual = spot[kind], (names[spot] == distinct)[kind]
                else:
                    spot, usual = np.zeros(len(first), np.int64), np.zeros(len(first), bool)
                mine = usual[group]
                token = spot[group[mine]]
                owner = text[order[mine]]
                value = np.log10(scale[mine] * chance[token] + again[mine])
                key = token * 256 + follow[order[mine]]
                if len(pairs):
                    at_pair = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                    usual_pair = pairs[at_pair] == key
                    value += np.where(usual_pair, pair_p[at_pair], 0.0)
                else:
                    usual_pair = np.zeros(len(key), bool)
                score = np.bincount(owner, weights=value, minlength=n) + begin[opening]
                base_sum = np.bincount(owner, weights=base[token], minlength=n) + end_base
                known = np.bincount(owner, weights=count[token] > 0, minlength=n).astype(np.int64) + (ends > 0)
                size = np.bincount(text, weights=end - start + 1, minlength=n).astype(np.int64) + 1
                rare = np.flatnonzero(~usual)
                size_of = np.diff(np.append(head, len(order)))[rare]
                # common words before a first byte that is not common after them
                odd = order[mine][~usual_pair]
                # shares of the later occurrences of each other word
                later = ~mine & ~fresh
                edges = np.concatenate([[0], np.cumsum(size_of - 1)])
                repeats = pa.ListArray.from_arrays(pa.array(np.append(edges, np.full(len(odd), edges[-1])).astype(np.int32)), pa.array(again[later]))
                spans = np.concatenate([[0], np.cumsum(size_of), int(size_of.sum()) + np.arange(1, len(odd) + 1)])
                nexts = pa.ListArray.from_arrays(pa.array(spans.astype(np.int32)), pa.array(np.concatenate([follow[order[~mine]], follow[odd]]), pa.int32()))
                ids, marks = batch.column(0).slice(a, n), batch.column(1).slice(a, n)
                nothing = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array(np.zeros(0)))
                no_next = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array(np.zeros(0), pa.int32()))
                no = np.zeros(n)
                yield pa.RecordBatch.from_arrays(
                    [ids, marks, pa.nulls(n, pa.string()), pa.array(no), nothing, no_next, pa.array(each + 1), pa.array(known), pa.array(base_sum), pa.array(score), pa.array(size)], names=_COLUMNS
                )
                token_at = np.concatenate([first[rare], odd])
                owner = pa.array(text[token_at])
                none, zero = pa.array(np.zeros(len(token_at), np.int64)), pa.array(np.zeros(len(token_at)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(owner),
                        marks.take(owner),
                        _strings(data, start[token_at], end[token_at]),
                        pa.array(np.append(np.log10(scale[head[rare]]), np.zeros(len(odd)))),
                        repeats,
                        nexts,
                        none,
                        pa.array(np.append(size_of, np.zeros(len(odd), np.int64))),
                        zero,
                        zero,
                        none,
                    ],
                    names=_COLUMNS,
                )

    return run


_COLUMNS = ["id", "mark", "word", "scale", "repeats", "nexts", "tokens", "known", "base", "score", "bytes"]
_SPEC = "mark long, word string, scale double, repeats array<double>, nexts array<int>, tokens long, known long, base double, score double, bytes long"


def score(docs: DataFrame, learnt: Column, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, Model]:
    """One row per row of ``docs``: id, ``n_tokens, n_known, base_score, score, n_bytes``; and the model."""
    twice = docs.groupBy(id).agg(F.count(F.lit(1)).alias("n")).filter(F.col(id).isNull() | (F.col("n") > 1))
    mark = F.lit(0).cast("long") if twice.isEmpty() else F.xxhash64(text)
    ends = docs.filter(learnt).count()
    vocab = stable(vocabulary(docs, text, learnt))
    model = train(vocab, ends)
    scored = stable(_scored(vocab, model))
    release(vocab)
    total = scored.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    # at most COMMON words have such a share, and at most PAIRS * COMMON pairs of a word and a first byte after it
    share, rarer = F.lit(total / COMMON), F.lit(total / (PAIRS * COMMON))
    usual = scored.filter(F.col("total") >= share).select("name", "own", "log_p", F.filter("after", lambda a: a.total >= rarer).alias("after")).toArrow()
    name = usual.column("name").to_numpy().view(np.uint64)
    order = np.argsort(name)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before, (byte, _, pair_p) = _after(usual.column("after"))
    key = place[before] * 256 + byte.to_numpy()
    by_key = np.argsort(key)
    common = (name[order], usual.column("own").to_numpy()[order].astype(np.float64), usual.column("log_p").to_numpy()[order], key[by_key], pair_p.to_numpy()[by_key])
    begin = model.starts.first()
    shared = docs.sparkSession.sparkContext.broadcast(common)
    divisor = model.tokens + 1.0 * (model.distinct + 1)
    end_base = math.log10((ends + 1) / divisor)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _texts(shared.value, lambda c: np.log10((c + 1.0) / divisor), begin, end_base, ends)(batches)

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), mark.alias("mark"), F.col(text).alias("text")).mapInArrow(texts, f"id {kind}, {_SPEC}")
    # a text's own row meets no word: words hold no line ends
    spread = F.coalesce("word", F.concat(F.lit("\n"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("mark").cast("string")))
    follows = [F.col("after.next").alias("byte"), F.col("after.log_p").alias("chance")]
    words_of = scored.select(F.col("word").alias("spread"), "own", "log_p", *follows).hint("shuffle_hash")
    joined = rows.withColumn("spread", spread).join(words_of, "spread", "left")
    p = F.pow(F.lit(10.0), F.col("log_p")) * (1 - CACHE)
    repeated = F.when(F.size("repeats") > 0, F.aggregate("repeats", F.lit(0.0), lambda a, q: a + F.log10(p + q))).otherwise(0.0)
    other = F.col("own").isNotNull()
    order_p = F.aggregate("nexts", F.lit(0.0), lambda a, b: a + F.get("chance", (F.array_position("byte", b) - 1).cast("int")))
    # rows without occurrences tell what follows only
    own_p = F.when(F.col("known") > 0, F.col("scale") + F.col("log_p") + repeated).otherwise(0.0)
    parts = joined.select(
        "id",
        "mark",
        (F.col("tokens") > 0).cast("long").alias("rows"),
        "tokens",
        "bytes",
        F.when(other & (F.col("own") == 0), 0).otherwise(F.col("known")).alias("known"),
        F.when(other, F.col("known") * F.log10((F.col("own") + 1.0) / F.lit(divisor))).otherwise(F.col("base")).alias("base"),
        F.when(other, own_p + order_p).otherwise(F.col("score")).alias("score"),
    )
    sums = parts.groupBy("id", "mark").agg(*[F.sum(c).alias(c) for c in ("rows", "tokens", "bytes", "known", "base", "score")])
    # rows equal in id and text have been added up
    each = [(F.col(c) / F.col("rows")).cast("long").alias(n) for c, n in (("tokens", "n_tokens"), ("known", "n_known"), ("bytes", "n_bytes"))]
    each += [(F.col(c) / F.col("rows")).alias(n) for c, n in (("base", "base_score"), ("score", "score"))]
    out = sums.select(F.col("id").alias(id), *each, F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy")).drop("copy")
    return out, model


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of every document, learnt from the folds other than 2 of 7."""
    part = fold("doc_id", 7)
    docs = docs.select("doc_id", "text")
    found, model = score(docs, F.coalesce(part != 2, F.lit(False)))
    bits = (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte")
    return found.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", bits)
