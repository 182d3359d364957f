"""How the sources of a language differ in their use of terms.

The count vectors of documents are built as a CountVectorizer with ``minDF`` and no bound on the vocabulary
builds them: per language, one place for each term in at least ``MIN_DF`` documents. The
vocabulary is a table, since it grows with the corpus; the estimator of Spark ML holds it on
the driver. Document vectors are summed by group the way a Summarizer does: inside Arrow batches
first, then by (language, source, term). Dropping rare terms commutes with these sums, so it is done after them.

With ``p = 1 + floor(10^9 (count + 1) / (N + V))`` and ``f(p, q) = floor((p - q)^2 / q)``, the
divergence of source s from source t is the sum of f over all V terms. Only terms both hold are
looked at in pairs: with p0 and q0 for terms a source lacks,

    sum f(p, q) = V f(p0, q0) + sum over terms of s of (f(p, q0) - f(p0, q0))
                + sum over terms of t of (f(p0, q) - f(p0, q0))
                + sum over terms of both of (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))

The middle sums need only the number of terms per value of p. The last one meets the holders of a
term inside tiles of at most ``BLOCK`` x ``BLOCK`` sources, in numpy, and gives back sums per pair of sources.

Defined cases: NULL text, language and source read as ''. A group without terms takes part with
count 0 everywhere; a language without kept terms has divergence 0 for all pairs and no term rows; a
language with one source has no pairs. Repeated rows are documents of their own. An empty table
gives an empty result. Other columns are ignored. Terms are told apart by a 64-bit hash inside a
batch and by their text everywhere else. Counts are longs; N up to 10^15 and V up to 10^9 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admere.llm.spans import Codes, gather, grouped, lowered, same
from admere.llm.text import hashes, mix, runs, tidy
from admere.session import stable

TERM_PATTERN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

#: Documents of a language that must hold a kept term, and terms listed per group.
MIN_DF, TERMS = 3, 200

#: Parts of one in which shares are counted.
UNIT = 1_000_000_000

#: Sources on a side of a tile; rows and pairs a task looks at together.
BLOCK, CHUNK_ROWS, CHUNK_PAIRS = 512, 1 << 18, 1 << 21

#: Groups that are broadcast at most; beyond that the joins with them are shuffled.
BROADCAST_ROWS = 50_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of texts; start, end, text number and hash of each term."""
    parts, offset = [], 0
    for first, _, data, bounds in lowered(column):
        start, end, text = runs(_LETTER[data], bounds)
        parts.append((data, start + offset, end + offset, text + first, hashes(data, start, end)))
        offset += len(data)
    if not parts:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), empty, empty, empty, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group sums of document vectors: occurrences and documents of each term in each (language, source)."""
    for held in grouped(batches, 2):
        codes = Codes()
        group = codes.number([pair for b in held for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)])
        data, start, end, text, key = terms(pa.concat_arrays([b.column(2) for b in held]))
        order, first = same(mix(key + group[text].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        if not len(first):
            continue
        lead, doc = order[first], text[order]
        # runs are in the order of documents, so a change of document is a new one
        fresh = np.r_[True, doc[1:] != doc[:-1]]
        fresh[first] = True
        n = np.diff(np.r_[first, len(order)])
        docs = np.add.reduceat(fresh.astype(np.int64), first)
        named = pa.array(group[text[lead]].astype(np.int32))
        langs, sources = (pa.DictionaryArray.from_arrays(named, pa.array([v[i] for v in codes.values], pa.string())).cast(pa.string()) for i in (0, 1))
        found = gather(data, start[lead], end[lead])
        del data, start, end, text, key, order, doc, fresh
        for at in range(0, len(n), 1 << 16):
            cut = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [x.slice(at, 1 << 16) for x in (langs, sources, found)] + [pa.array(n[cut]), pa.array(docs[cut])], names=["lang", "source", "term", "n", "df"]
            )
        tidy()


def _read(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])


def group_counts(docs: DataFrame, min_df: int = MIN_DF, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Kept terms of each (language, source) that holds them: ``n`` there, ``total`` and ``df`` in the language.

    ``lead`` marks one row of each (language, term).
    """
    sums = _read(docs, lang, source, text).mapInArrow(_sums, "lang string, source string, term string, n long, df long")
    each = sums.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    # One row a source by now, so the window of a term is as long as the sources that hold it.
    term = Window.partitionBy("lang", "term")
    return (
        each.withColumn("total", F.sum("n").over(term))
        .withColumn("docs", F.sum("df").over(term))
        .filter(F.col("docs") >= min_df)
        .select("lang", "source", "term", "n", "total", F.col("docs").alias("df"), (F.row_number().over(term.orderBy("source")) == 1).alias("lead"))
    )


def vocabulary(docs: DataFrame, min_df: int = MIN_DF, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Terms in at least ``min_df`` documents of a language, with their documents and occurrences."""
    return group_counts(docs, min_df, lang, source, text).filter("lead").select("lang", "term", "df", F.col("total").alias("n"))


def share(count: Column, total: Column, size: Column) -> Column:
    """``1 + floor(10^9 (count + 1) / (total + size))``, exact."""
    whole = (F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(18,0)")).cast("decimal(38,0)")
    return F.call_function("div", whole, (total + size).cast("decimal(38,0)")) + 1


def excess(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)`` of longs."""
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _meet(key: np.ndarray, side: np.ndarray, p: np.ndarray, p0: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Both holders (row numbers) and the correction of every ordered pair of rows with one key, which lie side by side.

    In a tile of two blocks only sources of different blocks meet; ``side`` tells the blocks apart, -1 where all meet.
    """
    left, step = np.arange(len(key) - 1), 1
    while len(left):
        left = left[left + step < len(key)]
        left = left[key[left] == key[left + step]]
        right = left + step
        apart = (side[left] < 0) | (side[left] != side[right])
        a, b = left[apart], right[apart]
        for x, y in ((a, b), (b, a)):
            yield x, y, _f(p[x], p[y]) - _f(p[x], p0[y]) - _f(p0[x], p[y]) + _f(p0[x], p0[y])
        step += 1


def _summed(of: np.ndarray, to: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((to, of))
    of, to = of[order], to[order]
    first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (to[1:] != to[:-1])])
    return of[first], to[first], np.add.reduceat(value[order], first)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of corrections per pair of groups, from rows sorted by key; no key is cut in two."""

    def whole() -> Iterator[list[np.ndarray]]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
            if sum(len(h[0]) for h in held) < CHUNK_ROWS:
                continue
            table = [np.concatenate(c) for c in zip(*held, strict=True)]
            other = np.flatnonzero(table[0] != table[0][-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield [c[:cut] for c in table]
            held = [[c[cut:] for c in table]]
        if held:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]

    for key, group, side, p, p0 in whole():
        found, size = [], 0
        for a, b, value in _meet(key, side, p, p0):
            found.append((group[a], group[b], value))
            size += len(a)
            if size > CHUNK_PAIRS:
                found = [_summed(*(np.concatenate(x) for x in zip(*found, strict=True)))]
                size = len(found[0][0])
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))], names=["s", "t", "v"])


def _sized(table: DataFrame) -> DataFrame:
    """Broadcast a written table of groups if it is small."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def audit(docs: DataFrame, min_df: int = MIN_DF, top: int = TERMS, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Rows of part ``pair`` (divergence of a source from each other one of its language) and part ``term`` (its most typical terms)."""
    counts = stable(group_counts(docs, min_df, lang, source, text))
    groups = stable(_groups(_read(docs, lang, source, text).select("lang", "source").distinct(), counts))
    few = _sized(groups)
    rows = counts.join(few, ["lang", "source"])
    rows = rows.select("lang", "source", "term", "total", "all", "size", "grp", "place", "blocks", "p0", share(F.col("n"), F.col("own"), F.col("size")).alias("p"))

    q = share(F.col("total"), F.col("all"), F.col("size"))
    typical = rows.withColumn("q", q).filter("p > q").select("lang", "source", F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    typical = typical.withColumn("rank", place).filter(F.col("rank") <= top)
    pairs = pair_values(rows, groups, few).withColumn("rank", place)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").union(
        typical.select("lang", "source", F.lit("term"), "item", "value", "rank")
    )


def _groups(every: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per (language, source): its words ``own``, those of the language ``all``, its ``size`` V, and p of terms it lacks."""
    langs = counts.groupBy("lang").agg(F.sum("n").alias("all"), F.count_if("lead").alias("size"))
    held = counts.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    zero = F.lit(0).cast("long")
    return (
        every.join(held, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("own", "all", "size")])
        .withColumn("grp", F.monotonically_increasing_id())
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        .withColumn("blocks", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / BLOCK).cast("int"))
        .withColumn("p0", F.when(F.col("size") > 0, share(F.lit(0), F.col("own"), F.col("size"))))
    )


def pair_values(rows: DataFrame, groups: DataFrame, few: DataFrame) -> DataFrame:
    """``value`` of every ordered pair of sources of a language, ``source`` and ``item``."""
    other = few.select("lang", F.col("grp").alias("t"), F.col("p0").alias("q0"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    base = groups.join(other, "lang").filter("grp <> t").select(F.col("grp").alias("s"), "t", F.coalesce(F.col("size") * excess(p0, q0), F.lit(0)).alias("v"))
    # Terms of one source: how many have each value of p.
    held = stable(rows.groupBy("lang", "grp", "p0", "p").agg(F.count(F.lit(1)).alias("c")))
    alone = (
        held.join(other, "lang").filter("grp <> t").groupBy("grp", "t")
        .agg(F.sum(F.col("c") * (excess(p, q0) - excess(p0, q0))).alias("here"), F.sum(F.col("c") * (excess(q0, p) - excess(q0, p0))).alias("there"))
    )
    # Terms of two sources, in tiles of two blocks of sources; a row goes to every tile of its block.
    mine, facing = F.floor(F.col("place") / BLOCK), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tile = F.least("mine", "facing") * F.col("blocks") + F.greatest("mine", "facing")
    tiled = rows.withColumn("mine", mine).withColumn("facing", facing).withColumn("tile", tile)
    sorted_rows = tiled.repartition("lang", "term", "tile").sortWithinPartitions("lang", "term", "tile")
    both = sorted_rows.select(
        F.xxhash64("lang", "term", "tile").alias("key"), "grp", F.when(F.col("mine") == F.col("facing"), -1).otherwise(F.col("mine")).cast("long").alias("side"), "p", "p0"
    ).mapInArrow(_pairs, "s long, t long, v long")
    parts = base.union(alone.select("grp", "t", "here")).union(alone.select("t", "grp", "there")).union(both)
    total = parts.groupBy("s", "t").agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("long").alias("value"))
    name = few.select("lang", "source", F.col("grp").alias("s"))
    return total.join(name, "s").join(few.select(F.col("source").alias("item"), F.col("grp").alias("t")), "t").select("lang", "source", "item", "value")


def document_vectors(docs: DataFrame, vocab: DataFrame, id: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """Sparse count vectors: one row per document and kept term it holds (``id``, ``lang``, ``term``, ``n``).

    Rows of a repeated id are added up. For use beside the audit, which never needs them one by one.
    """
    kind = docs.schema[id].dataType.simpleString()
    read = docs.select(F.col(id).alias("id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    found = read.mapInArrow(_vectors, f"id {kind}, lang string, term string, n long").groupBy("id", "lang", "term").agg(F.sum("n").alias("n"))
    return found.join(vocab.select("lang", "term"), ["lang", "term"], "left_semi").select("id", "lang", "term", "n")


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, start, end, text, key = terms(batch.column(2))
        order, first = same(mix(key + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        lead = order[first]
        row = pa.array(text[lead])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(row), batch.column(1).take(row), gather(data, start[lead], end[lead]), pa.array(np.diff(np.r_[first, len(order)]))],
            names=["id", "lang", "term", "n"],
        )


#: The same in SQL, for the query.
ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
  SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '{TERM_PATTERN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs
),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY 1, 2 HAVING count(DISTINCT d) >= {MIN_DF}),
counted AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY 1, 2, 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
dense AS (SELECT lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
shares AS (
  SELECT *, 1 + ({UNIT}::HUGEINT * (n + 1)) // (sum(n) OVER own + count(*) OVER own) AS p, 1 + ({UNIT}::HUGEINT * (total + 1)) // (sum(total) OVER own + count(*) OVER own) AS q
  FROM dense WINDOW own AS (PARTITION BY lang, source)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TERMS}
"""
