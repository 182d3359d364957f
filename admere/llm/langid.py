"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A three-letter gram is bound from
its letters' vectors, rotated by two places, one and none, and multiplied; a text is
the sum (bundle) of its grams' vectors, a language the sum of its texts' vectors, each
scaled to the same length first. A text gets the language whose prototype has the
largest cosine with it. Short texts hold few grams, so their cosines are low in any
language: what a text must reach to be kept follows from the learnt texts of the language
that are about as long (a class for each doubling of the length).

Word edges take part as one extra letter; the middle of a gram is always a letter.
Counting grams first and multiplying the counts by the gram vectors gives the same
bundle as adding vectors letter by letter, at the cost of one matrix product a batch.

Defined results: NULL, empty and letterless texts get ``und`` with score 0, and so does
everything if no language was learnt. Ties go to the first language by name. Repeated
rows are scored alike. Columns with names of this module's own are kept out of the way
by selecting the input columns first. Rows without a fold (NULL id) are never learnt
from and count as not held out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admere.llm.text import pieces

#: Places in a vector.
PLACES = 1024
#: Texts with a cosine below this are like no language learnt, whatever their length.
FLOOR = 0.05
#: Share of the learnt texts of a language and length that may lie below the cosine taken as usual, and
#: the part of that cosine which a text of the language must reach.
LOWEST, MARGIN = 0.01, 0.5
#: Classes of length, each twice as long as the one before; a text has fewer than 2^31 code points.
_CLASSES = 31
#: Steps of a cosine between 0 and 1, for its distribution.
_STEPS = 1000
UNKNOWN = "und"
#: Bytes of text whose grams are counted together.
PIECE = 2 << 20
#: Prototypes are summed as whole numbers of this part, so that the order of addition does not matter.
_UNIT = float(2**20)
#: Code points above this are no letters.
_LETTERS = 0x33480


@functools.cache
def _folding() -> np.ndarray:
    """Lower case of each code point; 0 for what is no letter."""
    out = np.zeros(_LETTERS + 1, np.int64)
    for i in range(_LETTERS):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low[0])
    return out


@functools.lru_cache(maxsize=20_000)
def _letter(code: int) -> np.ndarray:
    return (np.random.default_rng([7, code]).integers(0, 2, PLACES, dtype=np.int8) * 2 - 1).astype(np.float32)


def _letters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of all texts, 0 once before, between and after words; and each one's text."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    sizes = np.diff(begins[bounds])
    folded = _folding()[np.minimum(codes, _LETTERS)]
    texts = np.repeat(np.arange(len(sizes)), sizes)
    # one edge after each text and one before the next, then runs of edges are cut to one
    at = np.cumsum(sizes) - sizes
    letters = np.insert(folded, np.concatenate([at + sizes, at]), 0)
    owner = np.insert(texts, np.concatenate([at + sizes, at]), np.concatenate([np.arange(len(sizes))] * 2))
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0) | (owner[1:] != owner[:-1])
    return letters[keep], owner[keep]


def bundles(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bundle of each text, one row a text; zeros for a text without letters."""
    n = len(bounds) - 1
    out = np.zeros((n, PLACES), np.float32)
    letters, owner = _letters(data, bounds)
    if len(letters) < 3:
        return out
    known, index = np.flatnonzero(np.bincount(letters, minlength=1)), None
    index = np.zeros(int(known[-1]) + 1, np.int64)
    index[known] = np.arange(len(known))
    small = index[letters]
    m = len(known)
    use = (owner[:-2] == owner[2:]) & (letters[1:-1] != 0)
    grams, owner = ((small[:-2] * m + small[1:-1]) * m + small[2:])[use], owner[:-2][use]
    if not len(grams):
        return out
    if m**3 <= 1 << 24:
        seen = np.flatnonzero(np.bincount(grams, minlength=1))
        place = np.zeros(int(seen[-1]) + 1, np.int64)
        place[seen] = np.arange(len(seen))
        place = place[grams]
    else:
        seen, place = np.unique(grams, return_inverse=True)
    vectors = np.stack([_letter(int(c)) for c in known])
    once, twice = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
    step = max(1, (8 << 20) // max(n, PLACES))
    for low in range(0, len(seen), step):
        part = seen[low : low + step]
        here = (place >= low) & (place < low + step) if len(seen) > step else slice(None)
        counts = np.bincount(owner[here] * len(part) + (place[here] - low), minlength=n * len(part)).reshape(n, len(part))
        bound = twice[part // (m * m)] * once[part // m % m] * vectors[part % m]
        out += counts.astype(np.float32) @ bound
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition and language, the sum of its texts' scaled bundles."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        names = np.array(batch.column(1).to_pylist(), object)
        for first, end, data, bounds in pieces(batch.column(0), PIECE):
            whole = np.rint(_unit(bundles(data, bounds)) * _UNIT).astype(np.int64)
            for name in set(names[first:end]):
                total[name] = total.get(name, 0) + whole[names[first:end] == name].sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], names=["name", "total"])


def learn(docs: DataFrame, text: str, lang: str) -> dict[str, np.ndarray]:
    """Prototype of each language; ``languages x PLACES`` numbers reach the driver, whatever the rows."""
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("name"))
    sums = rows.mapInArrow(_sums, "name string, total array<bigint>")
    parts = sums.select("name", F.posexplode("total").alias("place", "part")).groupBy("name", "place").agg(F.sum("part").alias("part"))
    found: dict[str, np.ndarray] = {}
    for name, place, part in parts.collect():
        found.setdefault(name, np.zeros(PLACES))[place] = part
    return {name: found[name] for name in sorted(found) if found[name].any()}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Add the language of each text and its cosine, cut at 0. All other columns stay."""
    langs = list(prototypes)
    profile = _unit(np.array([prototypes[k] for k in langs])) if langs else np.zeros((0, PLACES))
    where = docs.columns.index(text)
    # rows travel whole, so extra columns come through whatever their names
    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)] + ["pred string", "cosine double"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.full(batch.num_rows, -1)
            score = np.zeros(batch.num_rows)
            for first, end, data, bounds in pieces(batch.column(where), PIECE):
                rows = _unit(bundles(data, bounds))
                if langs:
                    cosine = rows @ profile.T
                    best[first:end] = np.where(rows.any(axis=1), cosine.argmax(axis=1), -1)
                    score[first:end] = np.where(rows.any(axis=1), np.clip(cosine.max(axis=1), 0.0, 1.0), 0.0)
            named = [langs[i] if i >= 0 else UNKNOWN for i in best]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(named, pa.string()), pa.array(score)], names=[f"c{i}" for i in range(batch.num_columns)] + ["pred", "cosine"])

    out = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(predict, schema)
    return out.toDF(*docs.columns, *names)


def fold(key: str, parts: int) -> Column:
    """Which of ``parts`` folds a row is in: the CRC of its id as text."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def label_documents(docs: DataFrame) -> DataFrame:
    """Language of every document, learnt from the folds other than 1 of 3."""
    docs = docs.select("doc_id", "text", "lang")
    prototypes = learn(docs.filter(fold("doc_id", 3) != 1), "text", "lang")
    held = docs.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "text")
    return identify(held, prototypes).drop("text")


def _class(text: str) -> Column:
    """Length class of a text: a step for each doubling of its code points."""
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)).cast("double"))).cast("int")


def floors(learnt: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", lang: str = "lang") -> dict[tuple[str, int], float]:
    """The cosine that texts of each language and length class must reach, from all texts learnt.

    Counts by step of the cosine are added up in Spark; a language gives at most 31 numbers, fewer than its prototype has.
    """
    marked = identify(learnt.select(F.col(text).alias("text"), F.col(lang).alias("lang")), prototypes)
    step = F.floor(F.col("score") * _STEPS).cast("int").alias("step")
    counts = marked.filter("lang_pred = lang").groupBy("lang_pred", _class("text").alias("class"), step).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("lang_pred", "class")
    so_far = counts.select("*", F.sum("n").over(group.orderBy("step")).alias("below"), F.sum("n").over(group).alias("all"))
    usual = so_far.filter(F.col("below") > F.col("all") * LOWEST).groupBy("lang_pred", "class").agg(F.min("step").alias("step"))
    found = {(r["lang_pred"], r["class"]): max(FLOOR, MARGIN * r["step"] / _STEPS) for r in usual.collect()}
    # at a length not learnt, what the next shorter texts must reach
    for name in prototypes:
        for size in range(_CLASSES):
            found.setdefault((name, size), found.get((name, size - 1), FLOOR))
    return found


def keep_known(docs: DataFrame) -> DataFrame:
    """Documents in one of the languages learnt from their own ``lang`` column; the others go.

    A text goes if it has no letters or its cosine is below the floor of its language and length (``floors``).
    Lengths at which a language was not learnt have the floor of the next shorter ones, else ``FLOOR``. The result has the columns of documents.
    """
    learnt = docs.filter(fold("doc_id", 3) != 1)
    prototypes = learn(learnt, "text", "lang")
    found = floors(learnt, prototypes)
    marked = identify(docs.select("doc_id", "text", "lang", "source", "n_chars"), prototypes, names=("_pred", "_score")).withColumn("_class", _class("text"))
    # at most 31 rows a language
    least = docs.sparkSession.createDataFrame([(k, c, f) for (k, c), f in sorted(found.items())], "_pred string, _class int, _floor double")
    kept = marked.join(F.broadcast(least), ["_pred", "_class"], "left").filter((F.col("_pred") != UNKNOWN) & (F.col("_score") >= F.coalesce("_floor", F.lit(FLOOR))))
    return kept.select("doc_id", "text", "lang", "source", "n_chars")
