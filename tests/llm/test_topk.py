import math
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from admere.llm import topk
from admere.llm.ship import ship

SPEC = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    good = []
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * Fraction(float(np.float32(x)))) for x in v]))
    found = {}
    for q, a in good:
        if q % every == 0:
            found.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in good if c != q and len(a) == len(b))
    held = lambda s: max(-(2**63), min(2**63 - 1, s))
    return sorted((q, r + 1, c, held(-s)) for q, scores in found.items() for r, (s, c) in enumerate(sorted(scores)[:k]))


def check(spark, rows, k=5, every=10):
    df = ship(spark).createDataFrame(rows, SPEC)
    found = topk.search(df, F.col("vec_id") % every == 0, k)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect())) == brute(rows, k, every)


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist(), 0) for i in range(300)]
    check(spark, rows)
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "SHARD", 11)
    check(spark, rows)


def test_ties_nulls_lengths_and_repeated_rows(spark):
    same = [(i, [0.5, 0.25], 0) for i in range(40)]
    odd = [(100, None, 0), (101, [1.0, None], 0), (102, [math.nan, 1.0], 0), (103, [math.inf, 1.0], 0), (None, [1.0, 1.0], 0), (110, [1.0], 0), (111, [2.0], 0), (0, [0.5, 0.25], 1), (120, [], 0), (121, [], 0), (130, [-1e6, 1e6], 0)]
    check(spark, same + odd)
    check(spark, [(10, [1.0], 0), (20, [2.0], 0)])
    check(spark, [])


def test_large_components_stay_exact(spark):
    check(spark, [(i, [float(2**21 + i), float(i)], 0) for i in range(0, 30)], 3)


def test_large_finite_components_take_part(spark):
    rows = [(0, [4e13, 1.0], 0), (10, [-4e13, 2.0], 0), (1, [4e13, 1.5], 0), (2, [3e38, -3e38], 0), (3, [1.0, 1.0], 0), (20, [3e38, 3e38], 0), (30, [0.5, 0.25], 0), (4, [4e13, 1.0], 0), (5, [1e-40, 0.0], 0)]
    check(spark, rows)
    check(spark, rows * 2, 3)


def test_names_of_other_columns_do_not_clash(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], 0, 1, 2) for i in range(20)], SPEC + ", asks int, __asked int").withColumnRenamed("label", "id")
    want = brute([(i, [float(i), 1.0], 0) for i in range(20)], 2, 10)
    assert sorted(map(tuple, topk.search(df, F.col("vec_id") % 10 == 0, 2).collect())) == want
