"""Exact top-k search by inner product.

Queries are dealt into blocks and all vectors into shards; a block and a shard make a
tile. A tile is one product of two matrices of whole numbers, computed a bounded slice
at a time, and hands back the k best rows per query. The lists of a query's tiles are
merged up a tree of bounded width. No pair of vectors is ever a row.

Defined results: vectors that are NULL or hold NULL or non-finite components take no part, nor do rows
without id. A vector meets those of its own length only. A repeated row is a row of its own, as
candidate and as query; what the queries of one id find shares its k ranks. A row never meets one with
its own id. Ties go to the smaller id. With fewer candidates than k all are returned. All products are exact:
rows whose products may pass 64 bits are multiplied as Python integers; ranks follow the exact
scores, and a score beyond 64 bits is shown as the end of that range. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Components are scaled by this and rounded down.
SCALE = 256
#: Queries of a block and vectors of a shard, about.
BLOCK, SHARD = 1024, 4096
#: Vectors multiplied at a time.
SLICE = 2048
#: Lists merged into one at a time.
FAN = 16
_END = 2**63 - 1


def usable(vector: Column) -> Column:
    inside = F.lit(float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < inside)), F.lit(False))


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` best scores, ties to the smaller id; -inf never."""
    n, m = scores.shape
    never = -np.inf if scores.dtype == np.float64 else np.iinfo(np.int64).min
    least = np.partition(scores, m - k, axis=1)[:, m - k] if m > k else np.full(n, never)
    row, column = np.nonzero((scores >= least[:, None]) & (scores > never))
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _product(queries: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All scores of whole numbers below :func:`_limit`, as order and as whole numbers."""
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(queries.shape[1], 1)
    if reach < 2**53:
        exact = queries @ vectors.T
        return exact, exact
    whole = queries.astype(np.int64) @ vectors.astype(np.int64).T
    return whole, whole


def _limit(size: int) -> int:
    """Components below this have products of 64 bits."""
    return math.isqrt(2**62 // max(size, 1))


def _rest(score: int) -> bytes:
    """Orders scores that pass 64 bits as bytes do: sign and length, then the digits; empty for all others."""
    if abs(score) < _END:
        return b""
    digits = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    text = b"\x01" + len(digits).to_bytes(2, "big") + digits
    return text if score > 0 else bytes(255 - x for x in text)


def _best_large(queries: list[list[int]], asked: np.ndarray, vectors: list[list[int]], ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """Query, id and score of each query's ``k`` best rows, in Python integers."""
    for values, of in zip(queries, asked.tolist(), strict=True):
        scores = ((sum(map(int.__mul__, values, other)), i) for other, i in zip(vectors, ids.tolist(), strict=True) if i != of)
        for score, i in heapq.nsmallest(k, scores, key=lambda s: (-s[0], s[1])):
            yield of, i, score


def _tiles(batches: Iterator[pa.RecordBatch], k: int, scale: int = SCALE) -> Iterator[pa.RecordBatch]:
    """Best rows of each tile; rows come sorted by tile, its queries first."""
    names = ["query_id", "shard", "vec_id", "score", "rest"]
    key: tuple | None = None
    asked: list[pa.RecordBatch] = []
    queries: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None

    def matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
        return batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)

    def rows(shard: int, found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        asked, ids, scores = zip(*found, strict=True) if found else ((), (), ())
        held = [max(-_END - 1, min(_END, s)) for s in scores]
        columns = [pa.array(asked, pa.int64()), pa.array([shard] * len(found), pa.int64()), pa.array(ids, pa.int64()), pa.array(held, pa.int64()), pa.array(map(_rest, scores), pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def split(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Scaled and rounded components, and which rows may pass 64 bits."""
        with np.errstate(over="ignore"):
            whole = np.floor(values * scale)
        return whole, (np.abs(whole) >= _limit(size)).any(axis=1)

    def integers(values: np.ndarray) -> list[list[int]]:
        return [[math.floor(Fraction(x) * scale) for x in row] for row in values.tolist()]

    for batch in batches:
        marks = np.stack([batch.column(c).to_numpy() for c in ("size", "block", "shard", "side")], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1, [len(marks)]])
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            size, block, shard, side = (int(x) for x in marks[a])
            if (size, block, shard) != key:
                key, asked, queries = (size, block, shard), [], None
            part = batch.slice(a, b - a)
            if side == 0:
                asked.append(part)
                continue
            if not asked:
                continue
            if queries is None:
                raw = np.concatenate([matrix(p, size) for p in asked])
                queries = raw, *split(raw, size), np.concatenate([p.column("id").to_numpy() for p in asked])
            raw, scaled, large, of = queries
            for low in range(0, part.num_rows, SLICE):
                some = part.slice(low, SLICE)
                ids, given = some.column("id").to_numpy(), matrix(some, size)
                whole, wide = split(given, size)
                near, near_of = ids[~wide], of[~large]
                order, score = _product(scaled[~large], whole[~wide])
                order = np.where(near_of[:, None] == near[None, :], -np.inf, order) if order.dtype == np.float64 else np.where(near_of[:, None] == near[None, :], np.iinfo(np.int64).min, order)
                row, column = best_of(order, near, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near_of[row]), pa.array(np.full(len(row), shard)), pa.array(near[column]), pa.array(score[row, column].astype(np.int64)), pa.array([b""] * len(row), pa.binary())], names=names
                )
                if large.any():
                    yield rows(shard, list(_best_large(integers(raw[large]), of[large], integers(given), ids, k)))
                if wide.any() and not large.all():
                    yield rows(shard, list(_best_large(integers(raw[~large]), near_of, integers(given[wide]), ids[wide], k)))


def search(vectors: DataFrame, is_query: Column, k: int, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The ``k`` best other vectors of every query: ``query_id, rank, vec_id, score``."""
    asks = F.coalesce(is_query, F.lit(False)).alias("asks")
    rows = vectors.filter(F.col(id).isNotNull() & usable(F.col(vector))).select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("values"), asks)
    rows = rows.withColumn("size", F.size("values"))
    counts = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if("asks").alias("asked")).first()
    blocks, shards = max(1, math.ceil(counts["asked"] / BLOCK)), max(1, math.ceil(counts["all"] / SHARD))
    # by row, not by id, so that a row repeated very often is spread; drawn before rows are sent to several tiles
    row = F.monotonically_increasing_id()
    drawn = lambda n, seed: F.pmod(F.xxhash64("id", row, F.lit(seed)), F.lit(n)).cast("int")
    asked = rows.filter("asks").select("size", drawn(blocks, 1).alias("block"), F.lit(0).alias("side"), "id", "values")
    asked = asked.select("size", "block", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "side", "id", "values")
    given = rows.select("size", drawn(shards, 2).alias("shard"), F.lit(1).alias("side"), "id", "values")
    given = given.select("size", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "shard", "side", "id", "values")
    tiled = asked.unionByName(given).repartition("size", "block", "shard").sortWithinPartitions("size", "block", "shard", "side")
    lists = tiled.mapInArrow(lambda b: _tiles(b, k, scale), "query_id long, shard long, vec_id long, score long, rest binary")

    def best(df: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy("query_id", *keys).orderBy(F.col("score").desc(), F.col("rest").desc(), "vec_id")
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    while shards > FAN:
        shards = math.ceil(shards / FAN)
        lists = best(lists.withColumn("shard", F.floor(F.col("shard") / FAN)), "shard").drop("rank")
    return best(lists).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
