"""Join of near-equal texts: Jaccard similarity of their sets of five-word runs.

1. Every text becomes its set of hashed n-grams. Texts with one and the same set are
   copies and go on as one representative with a count.
2. MinHash: ``rows`` minima make a band, ``bands`` bands a signature, both chosen for a
   target recall at the threshold (``plan``). Representatives are shuffled by band hash;
   a bucket with one member, or with the members of another bucket, is dropped.
3. Buckets are cut into blocks, and pairs of blocks are tiles of bounded size. A tile
   verifies its pairs on the full n-gram sets, as products of 0/1 matrices. A pair that
   shares several buckets counts in the first of them. A tile hands back one number of
   links per member and a spanning forest, so no pair is ever a row.
4. Links make components; a component is a class, named by its smallest id.

``n_links`` counts the other rows whose sets have at least the threshold's similarity,
copies included. Verification is exact but for 64-bit hash collisions; a link at the very
threshold is missed with probability ``1 - RECALL``, a closer one far less often.

Defined results: texts with one to four words are one n-gram of all their words. Texts
without words (NULL, empty, blanks) are their own class and have no links. Repeated rows
are copies. A row without id takes part as a copy if a row with an id has its set, and
has no class otherwise. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.llm.text import hashes, mix, pieces, windows, words
from admere.operators.identity import connected_components
from admere.session import release, stable

#: Words in an n-gram, and the least similarity that links.
SIZE, THRESHOLD = 5, 0.8
#: Share of links at the threshold that must become candidates.
RECALL = 0.99999
#: Minima per text, at most.
MINIMA = 100
#: Members of a block; a tile holds two blocks.
BLOCK = 256
#: Bits of the bitmap that picks texts for verification: 8 MB.
BITS = 1 << 26
#: Matrix columns that a tile multiplies at a time.
COLUMNS = 4096


def plan(threshold: float = THRESHOLD, recall: float = RECALL, minima: int = MINIMA) -> tuple[int, int]:
    """Bands and rows: the most selective bands whose recall at the threshold is high enough."""
    for rows in range(16, 0, -1):
        match = threshold**rows
        bands = 1 if match >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-match))
        if bands * rows <= minima:
            return bands, rows
    raise ValueError("no bands of so few minima have that recall")


def sets(data: np.ndarray, bounds: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text in ascending order, one after another, and their bounds."""
    n = len(bounds) - 1
    start, end, text = words(data, bounds)
    single = hashes(data, start, end)
    grams, at = windows(single, text, size)
    owner = text[at]
    count = np.bincount(text, minlength=n)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(text, short)
        whole = np.empty(len(short), np.uint64)
        for k, (i, c) in enumerate(zip(first, count[short], strict=True)):
            value = np.array([c], np.uint64)
            for word in single[i : i + c]:
                value = mix(value * np.uint64(31) + word)
            whole[k] = value[0]
        grams, owner = np.concatenate([grams, whole]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[keep], owner[keep]
    return grams, np.searchsorted(owner, np.arange(n + 1))


def _keys(grams: np.ndarray, edges: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set; None for an empty one."""
    size = np.diff(edges)
    some = size > 0
    out = np.zeros((len(size), 2), np.uint64)
    if some.any():
        first = edges[:-1][some]
        out[some, 0] = np.add.reduceat(mix(grams), first)
        out[some, 1] = np.add.reduceat(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first) + size[some].astype(np.uint64)
    return [row.tobytes() if yes else None for row, yes in zip(out, some, strict=True)]


def _minima(grams: np.ndarray, edges: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of each set, one row a set."""
    draw = np.random.default_rng(8).integers(1, 2**63, (2, bands * rows), dtype=np.uint64)
    some = np.diff(edges) > 0
    out = np.zeros((len(edges) - 1, bands), np.uint64)
    if some.any():
        first = edges[:-1][some]
        for b in range(bands):
            value = np.full(len(first), b + 1, np.uint64)
            for r in range(b * rows, b * rows + rows):
                least = np.minimum.reduceat((grams ^ draw[0, r]) * (draw[1, r] | np.uint64(1)), first)
                value = mix(value * np.uint64(31) + least)
            out[some, b] = value
    return out


def _sign(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, bounds in pieces(batch.column(1)):
            grams, edges = sets(data, bounds, size)
            minima = _minima(grams, edges, bands, rows).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * bands), pa.array(minima.ravel()))
            own = [batch.column(i).slice(a, b - a) for i in (0, 2)]
            yield pa.RecordBatch.from_arrays([own[0], own[1], pa.array(_keys(grams, edges), pa.binary()), lists], names=["id", "mark", "key", "bands"])


def _members(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The sets of the wanted texts; a text that is not the wanted one of its id goes."""
    for batch in batches:
        for a, b, data, bounds in pieces(batch.column(0)):
            grams, edges = sets(data, bounds, size)
            wanted = batch.column(1).slice(a, b - a).to_pylist()
            keep = [i for i, key in enumerate(_keys(grams, edges)) if key == wanted[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([wanted[i] for i in keep], pa.binary()), pa.array([grams[edges[i] : edges[i + 1]].tobytes() for i in keep], pa.binary())],
                names=["key", "grams"],
            )


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of ``left`` and ``right`` are at least as similar as the threshold."""
    a, b = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    if len(left) == 1 and len(right) == 1:
        shared = np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]], np.float64)
    else:
        every, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
        owner = np.repeat(np.arange(len(a) + len(b)), np.concatenate([a, b]))
        # n-grams of one set alone add nothing
        often = np.bincount(place, minlength=len(every)) > 1
        number = np.cumsum(often) - 1
        use = often[place]
        place, owner = number[place[use]], owner[use]
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        shared = np.zeros((len(a), len(b)))
        for low in range(0, int(often.sum()), COLUMNS):
            lo, hi = np.searchsorted(place, [low, low + COLUMNS])
            marks = np.zeros((len(a) + len(b), min(COLUMNS, int(often.sum()) - low)), np.float32)
            marks[owner[lo:hi], place[lo:hi] - low] = 1
            shared += marks[: len(a)] @ marks[len(a) :].T
    return shared >= threshold * (a[:, None] + b[None, :] - shared) - 1e-9


def _forest(joined: np.ndarray) -> np.ndarray:
    """For each of n things, the first thing of its component under an n x n link matrix."""
    label = np.arange(len(joined))
    while True:
        least = np.minimum(label, np.where(joined, label[None, :], len(label)).min(axis=1, initial=len(label)))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _tile(bucket: int, same: bool, rows: list[tuple], threshold: float) -> Iterator[tuple[bytes, int, bytes | None]]:
    """Links per member and a spanning forest of one tile; ``rows``: side, key, copies, buckets, n-grams."""
    seen: dict[tuple[int, bytes], tuple] = {(r[0], r[1]): r for r in rows}
    left, right = ([r for (s, _), r in seen.items() if s == side] for side in (0, 1))
    right = left if same else right
    if not left or not right or (same and len(left) < 2):
        return
    bits = [[np.frombuffer(r[4], np.uint64) for r in part] for part in (left, right)]
    found = linked(bits[0], bits[1], threshold)
    earlier = {b for r in left for b in r[3] if b < bucket} & {b for r in right for b in r[3] if b < bucket}
    if earlier:
        place = {b: i for i, b in enumerate(sorted(earlier))}
        marks = [np.zeros((len(part), len(place)), np.float32) for part in (left, right)]
        for mark, part in zip(marks, (left, right), strict=True):
            for i, r in enumerate(part):
                mark[i, [place[b] for b in r[3] if b in place]] = 1
        found &= (marks[0] @ marks[1].T) == 0
    if same:
        np.fill_diagonal(found, False)
    copies = [np.array([r[2] for r in part], np.int64) for part in (left, right)]
    links = [found @ copies[1], found.T @ copies[0]]
    members = left if same else left + right
    total = links[0] if same else np.concatenate(links)
    if same:
        joined = found
    else:
        joined = np.zeros((len(members), len(members)), bool)
        joined[: len(left), len(left) :] = found
        joined |= joined.T
    label = _forest(joined)
    for i, r in enumerate(members):
        if total[i]:
            yield r[1], int(total[i]), members[label[i]][1] if label[i] != i else None


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Tiles of a partition, whose rows come sorted by tile."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        keys, links, roots = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(links, pa.int64()), pa.array(roots, pa.binary())], names=["key", "links", "root"])

    current, held, ready = None, [], []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bucket, low, high, *member = row
            if (bucket, low, high) != current:
                if held:
                    ready.extend(_tile(current[0], current[1] == current[2], held, threshold))
                current, held = (bucket, low, high), []
            held.append(tuple(member))
        if len(ready) > 10_000:
            yield out(ready)
            ready = []
    if held:
        ready.extend(_tile(current[0], current[1] == current[2], held, threshold))
    yield out(ready)


def _marked(df: DataFrame, wanted: DataFrame, id: str) -> DataFrame:
    """Add ``__marked``: false if the row's id is surely not wanted, so it need not be shuffled to find out.

    Wanted ids set bits in a bitmap of ``BITS`` bits, which is broadcast whatever their
    number. A row that shares its bit with a wanted id is marked as well.
    """
    place = F.pmod(F.xxhash64(id), F.lit(BITS))
    bitmap = (
        wanted.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("__part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))
    )
    spot = "bitmap_bit_position(__place)"
    bit = F.expr(f"shiftright(cast(conv(hex(substring(__bits, cast({spot} / 8 AS int) + 1, 1)), 16, 10) AS int), cast({spot} % 8 AS int)) & 1 = 1")
    found = df.withColumn("__place", place).withColumn("__part", F.bitmap_bucket_number("__place"))
    found = found.join(F.broadcast(bitmap), "__part", "left").withColumn("__marked", F.coalesce(bit, F.lit(False)))
    return found.select(*df.columns, "__marked")


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: its id, ``class_id`` and ``n_links``."""
    return _classes(docs, id, text, size, threshold, recall).select(id, "class_id", "n_links")


def _classes(docs: DataFrame, id: str, text: str, size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of :func:`classes` with a hash of each text (``mark``) and of the text that leads its class (``lead``)."""
    bands, rows = plan(threshold, recall)
    kind = docs.schema[id].dataType.simpleString()
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    signed = stable(texts.mapInArrow(lambda b: _sign(b, size, bands, rows), f"id {kind}, mark bigint, key binary, bands array<bigint>"))
    heads = stable(
        signed.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "mark"))).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
        .select("key", "first", "first.id", "copies", "bands")
        .filter(F.col("id").isNotNull())
    )
    keyed = heads.select("key", F.posexplode("bands").alias("band", "value"))
    bucket = F.xxhash64("band", "value").alias("bucket")
    placed = keyed.select(bucket, "key", F.xxhash64("key").alias("h"))
    counted = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor("h").alias("x"), F.sum(F.shiftrightunsigned("h", 24)).alias("s")
    )
    # buckets with the same members are one
    kept = stable(counted.filter("members > 1").groupBy("members", "x", "s").agg(F.min("bucket").alias("bucket")).select("bucket", "members"))
    member = stable(placed.drop("h").join(kept, "bucket").select("bucket", "members", "key"))
    near = stable(
        member.groupBy("key").agg(F.sort_array(F.collect_list("bucket")).alias("buckets")).join(heads.select("key", "id", "copies"), "key")
    )
    wanted = near.select("id", F.col("key").alias("wanted"))
    whole = _marked(texts, wanted, "id").filter("__marked").join(wanted, "id").select("text", "wanted").mapInArrow(lambda b: _members(b, size), "key binary, grams binary")
    armed = member.join(near.select("key", "copies", "buckets").join(whole, "key"), "key")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("key", "bucket"), blocks).cast("int")
    tiled = armed.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    tiled = tiled.select(
        "bucket",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "key",
        "copies",
        "buckets",
        "grams",
    )
    parts = tiled.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    found = stable(parts.mapInArrow(lambda b: _verify(b, threshold), "key binary, links long, root binary"))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    component = connected_components(found.filter("root IS NOT NULL").select("key", "root"), "key", "root")
    component = component.withColumnRenamed("node", "key").join(heads.select("key", "first"), "key")
    named = component.join(component.groupBy("component").agg(F.min("first").alias("class")), "component").select("key", "class")
    facts = heads.select("key", "first", "copies").join(links, "key", "left").join(named, "key", "left")
    facts = stable(facts.select("key", F.coalesce("class", "first").alias("class"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
    for frame in (kept, member, near, found):
        release(frame)
    return (
        signed.select("id", "mark", "key")
        .join(facts, "key", "left")
        .select(
            F.col("id").alias(id),
            F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class.id")).alias("class_id"),
            F.coalesce("links", F.lit(0)).alias("n_links"),
            "mark",
            F.when(F.col("key").isNull(), F.col("mark")).otherwise(F.col("class.mark")).alias("lead"),
        )
    )


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without those that near-equal another one: of each class the smallest id stays.

    A document is an id and a text: rows that repeat both are one, other texts under the same id are others.
    Rows without an id stay.
    """
    found = stable(_classes(docs, id, text).filter(F.col(id).isNotNull()))
    gone = stable(found.filter((F.col("class_id") != F.col(id)) | (F.col("lead") != F.col("mark"))).select(id, F.col("mark").alias("__mark")).distinct())
    marked = _marked(docs, gone, id)
    suspect = marked.filter("__marked").withColumn("__mark", F.xxhash64(text))
    kept = marked.filter(~F.col("__marked")).select(docs.columns).union(suspect.join(gone, [id, "__mark"], "left_anti").select(docs.columns))
    repeated = found.groupBy(id).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(id)
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, id, "left_anti").union(kept.join(repeated, id, "left_semi").dropDuplicates([id, text]).select(kept.columns))
