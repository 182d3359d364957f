"""Quality rules: fixed text rules, then a calibrated classifier on hashed n-grams.

Features are the shares of hashed words, word pairs, and byte runs of three and four
among all of their kind in a text. The classifier is a logistic regression fitted by
averaged stochastic steps on a bounded sample of labelled rows (``SAMPLE``), spread over
partitions; a fifth of the sample is kept out to calibrate margins into probabilities.
Texts are scored in Arrow batches against fixed thresholds; every whole text is read.

Defined results: NULL and empty texts have zero counts and fail the base rule. Rows with
a NULL id or label are not learnt from; of repeated labels the lowest counts. Without
labels of both kinds nothing is learnt and the base rule alone decides. Extra columns
come through whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.llm.text import gaps, hashes, mix, pieces, runs, windows, words

#: Hashed features.
SIZE = 1 << 18
#: Labelled rows that the classifier is fitted on, at most; chosen by a hash of the id.
SAMPLE = 6000
#: Partitions that fit a model each, and rounds after which these are averaged.
PARTS, ROUNDS, PASSES = 6, 3, 4
#: One row of the sample in so many calibrates.
CALIBRATE = 5
#: Least probability of good quality that is kept.
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEATED = 50
_SCALE = 40.0
_RATE = 0.5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Model:
    """Weights of the hashed features, and the line from margin to log-odds."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -700, 700)))


def _grams(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind of feature: hashed places, and where those of each text begin and end."""
    start, end, text = words(data, bounds)
    single = hashes(data, start, end)
    edge = np.searchsorted(text, np.arange(len(bounds)))
    yield (single % SIZE).astype(np.int64), edge[:-1], edge[1:]
    pair, at = windows(single, text, 2)
    edge = np.searchsorted(text[at], np.arange(len(bounds)))
    yield (pair % SIZE).astype(np.int64), edge[:-1], edge[1:]
    wide = data.astype(np.uint32)
    for size in (3, 4):
        n = max(len(data) - size + 1, 0)
        code = np.zeros(n, np.uint32)
        for k in range(size):
            code = (code << np.uint32(8)) | wide[k : k + n]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * size)
        yield (code >> np.uint32(32 - 18)).astype(np.int64), bounds[:-1], np.maximum(bounds[1:] - size + 1, bounds[:-1])


def _spread(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sum of values from ``first`` up to ``last``, for each pair."""
    out = np.zeros(len(first))
    some = last > first
    if some.any():
        edges = np.stack([first[some], last[some]], axis=1).ravel()
        out[some] = np.add.reduceat(np.append(values, 0.0), edges)[::2]
    return out


def margins(model: Model, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The classifier's margin for each text."""
    out = np.full(len(bounds) - 1, model.bias)
    for place, first, last in _grams(data, bounds):
        out += _SCALE * _spread(model.weights[place].astype(np.float64), first, last) / np.maximum(last - first, 1)
    return out


def _fit(batches: Iterator[pa.RecordBatch], model: Model, passes: int) -> Iterator[pa.RecordBatch]:
    """Adaptive-rate logistic steps over the rows of one partition, from the given model."""
    held = [(data.copy(), bounds, batch.column(1).to_numpy(zero_copy_only=False)[a:b], batch.column(2).to_numpy(zero_copy_only=False)[a:b]) for batch in batches for a, b, data, bounds in pieces(batch.column(0), 1 << 18)]
    if held:
        weights, bias = model.weights.astype(np.float64), model.bias
        seen = np.full(SIZE, 1e-3)
        for _ in range(passes):
            for data, bounds, label, weight in held:
                kinds = list(_grams(data, bounds))
                total = np.full(len(label), bias)
                for place, first, last in kinds:
                    total += _SCALE * _spread(weights[place], first, last) / np.maximum(last - first, 1)
                error = weight * (1.0 / (1.0 + np.exp(-np.clip(total, -30, 30))) - label) / max(weight.sum(), 1e-9)
                step = np.zeros(SIZE)
                for place, first, last in kinds:
                    each = _SCALE * error / np.maximum(last - first, 1)
                    share = np.zeros(len(place) + 1)
                    np.add.at(share, first, each)
                    np.add.at(share, last, -each)
                    step += np.bincount(place, weights=np.cumsum(share)[:-1], minlength=SIZE)
                seen += step * step
                weights -= _RATE * step / np.sqrt(seen)
                bias -= _RATE * error.sum()
        n = sum(len(label) for _, _, label, _ in held)
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([float(bias)]), pa.array([n], pa.int64())], names=["weights", "bias", "n"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` labelled documents; None if they are all of one kind."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ranked = known.withColumn("turn", F.xxhash64(F.col("doc_id"), F.lit(11))).orderBy("turn", "doc_id").limit(sample)
    # at most ``sample`` ids and labels
    chosen = [(r.doc_id, float(r.quality > 0)) for r in ranked.collect()]
    share = sum(y for _, y in chosen) / max(len(chosen), 1)
    if not 0 < share < 1:
        return None
    spark = docs.sparkSession
    rows = [(k, y, 0.5 / share if y else 0.5 / (1 - share)) for k, y in chosen]
    picked = spark.createDataFrame(rows, "doc_id long, label double, weight double")
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    turn = F.xxhash64(F.col("doc_id"), F.lit(12))
    found = found.select("text", "label", "weight", "doc_id", (F.pmod(turn, F.lit(CALIBRATE)) == 0).alias("calibrate"), F.pmod(turn / CALIBRATE, F.lit(PARTS)).cast("int").alias("part"))
    fitting = found.filter(~F.col("calibrate")).repartition(PARTS, "part").sortWithinPartitions("part", "doc_id", "label").select("text", "label", "weight").cache()
    model = Model(np.zeros(SIZE, np.float32), 0.0)
    for _ in range(ROUNDS):
        parts = fitting.mapInArrow(lambda batches, model=model: _fit(batches, model, PASSES), "weights binary, bias double, n long").collect()
        n = sum(p.n for p in parts)
        if not n:
            return None
        parts.sort(key=lambda p: (p.n, p.bias))
        model = Model(sum(np.frombuffer(p.weights, np.float32) * np.float32(p.n / n) for p in parts), sum(p.bias * p.n / n for p in parts))
    fitting.unpersist()

    def outcome(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [margins(model, data, bounds) for _, _, data, bounds in pieces(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got) if got else np.zeros(0)), batch.column(1)], names=["margin", "label"])

    pairs = found.filter("calibrate").select("text", "label").mapInArrow(outcome, "margin double, label double").collect()
    return calibrated(model, np.array([p.margin for p in pairs]), np.array([p.label for p in pairs]))


def calibrated(model: Model, margin: np.ndarray, label: np.ndarray) -> Model:
    """The model with the slope and shift under which its margins give the labels' odds."""
    good, bad = label.sum(), (1 - label).sum()
    if not good or not bad:
        return model
    order = np.argsort(margin, kind="stable")
    margin, label = margin[order], label[order]
    # targets kept off 0 and 1, so that a clean split has finite odds
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        gap, curve = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(gap * margin).sum() + 1e-3 * (slope - 1), gap.sum()])
        h = np.array([[(curve * margin * margin).sum() + 1e-3, (curve * margin).sum()], [(curve * margin).sum(), curve.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        move *= min(1.0, 2.0 / max(np.abs(move).max(), 1e-12))
        slope, shift = slope - move[0], shift - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return Model(model.weights, model.bias, float(slope), float(shift)) if math.isfinite(slope) and math.isfinite(shift) and slope > 0 else model


def counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n = len(bounds) - 1
    start, end, text = words(data, bounds)
    gap = gaps(data)
    total = lambda marked: np.diff(np.concatenate([[0], np.cumsum(marked)])[bounds])
    # lines: the newline ends one, and a text's end the last
    first, last, owner = runs(data != 10, bounds)
    solid = np.concatenate([[0], np.cumsum(~gap)])
    some = solid[last] > solid[first]
    line, owner = hashes(data, first, last)[some], owner[some].astype(np.uint64)
    distinct = np.unique(mix(line + mix(owner + np.uint64(1))) if len(line) else line, return_index=True)[1]
    lines = np.bincount(owner.astype(np.int64), minlength=n) - np.bincount(owner[distinct].astype(np.int64), minlength=n)
    triple, at = windows(hashes(data, start, end), text, 3)
    covered = np.zeros(len(start) + 2, bool)
    if len(triple):
        key = mix(triple + mix(text[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(3):
            covered[at[twice] + k] = True
    return {
        "n_words": np.bincount(text, minlength=n),
        "word_chars": total(~gap & ((data & 0xC0) != 0x80)),
        "n_symbols": total(_SYMBOLS[data]),
        "n_dup_lines": lines,
        "n_repeat_words": np.bincount(text[covered[: len(start)]], minlength=n),
    }


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, model: Model | None, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the base counts, ``base_failed``, the probability of good quality and ``kept``."""
    where = docs.columns.index(text)
    own = [f"c{i}" for i in range(len(docs.columns))]
    schema = ", ".join([f"{c} {f.dataType.simpleString()}" for c, f in zip(own, docs.schema, strict=True)] + [f"m_{m} long" for m in MEASURES] + ["m_failed boolean", "m_quality double", "m_kept boolean"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {m: np.zeros(batch.num_rows, np.int64) for m in MEASURES}
            chance = np.ones(batch.num_rows)
            for a, b, data, bounds in pieces(batch.column(where)):
                for m, values in counts(data, bounds).items():
                    found[m][a:b] = values
                if model is not None:
                    chance[a:b] = model.probability(margins(model, data, bounds))
            failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEATED * found["n_words"])
            columns = [*batch.columns, *(pa.array(found[m]) for m in MEASURES), pa.array(failed), pa.array(chance), pa.array(~failed & (chance >= THRESHOLD))]
            yield pa.RecordBatch.from_arrays(columns, names=own + [f"m_{m}" for m in MEASURES] + ["m_failed", "m_quality", "m_kept"])

    out = docs.toDF(*own).mapInArrow(measure, schema)
    return out.toDF(*docs.columns, *(prefix + n for n in [*MEASURES, "base_failed", "quality", "kept"]))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The verdict on every document."""
    return judge(docs.select("doc_id", "text"), train(docs, labels)).drop("text")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that pass the base rule and the classifier; the others go."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    marked = judge(docs.select(*columns), train(docs, labels), prefix="_")
    return marked.filter("_kept").select(*columns)
