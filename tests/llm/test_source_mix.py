import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from admere.llm import source_mix


def brute(rows):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (_, t, _) in enumerate(rows)}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, r in enumerate(rows) if r[2] == s) for s in sources}
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    budget, over, level = sum(total.values()), set(), 0.0
    while True:
        left = sum(weight[s] for s in sources if s not in over)
        if not left:
            break
        level = (budget - sum(3 * total[s] for s in over)) / left
        more = {s for s in sources if weight[s] * level > 3 * total[s] or not total[s]}
        if more == over:
            break
        over = more
    target = {s: float(min(3 * total[s], weight[s] * level)) for s in sources}
    queue = dict.fromkeys(sources, 0)
    entries = []
    key = lambda i: (hashlib.md5(f"mix|{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), rows[i][0] is not None, rows[i][0] or 0, size[i])
    for i in sorted(size, key=key):
        s = rows[i][2]
        queue[s] += size[i]
        if size[i]:
            entries += [((queue[s] + total[s] * t) / target[s], sources.index(s), i) for t in range(3)]
    taken, run = dict.fromkeys(size, 0), 0
    for _, _, i in sorted(entries):
        run += size[i]
        if run > budget:
            break
        taken[i] += size[i]
    return sorted(((r[0], size[i], total[r[2]], target[r[2]], taken[i]) for i, r in enumerate(rows)), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def corpus(n=400):
    rng = np.random.default_rng(6)
    names = ["a"] * 10 + ["b", "B", "é", None, "tiny"]
    return [(i, " ".join(["w"] * int(rng.integers(1, 40))), names[int(rng.integers(0, len(names)))]) for i in range(n)] + [(n, "w " * 30_000, "a"), (n + 1, None, "a"), (n + 2, "", "only empty")]


def test_equals_brute_force(spark):
    rows = corpus()
    assert sorted(map(tuple, source_mix.mix_documents(table(spark, rows).repartition(3)).collect()), key=str) == brute(rows)


def test_targets_are_met_and_no_document_is_taken_too_often(spark):
    rows = corpus()[:-3]
    found = source_mix.mix_documents(table(spark, rows)).collect()
    per = {}
    for r in found:
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        per.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(t) - target) <= 40 for (_, target), t in per.items())


def test_reruns_agree_whatever_the_partitions(spark):
    df = table(spark, corpus())
    a, b = (sorted(map(tuple, source_mix.mix_documents(d).collect())) for d in (df.repartition(1), df.repartition(7)))
    assert a == b


def test_repeated_null_and_empty(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "c", None), (None, "c", None), (2, "d e f", "x"), (3, None, None)]
    assert sorted(map(tuple, source_mix.mix_documents(table(spark, rows)).collect()), key=str) == brute(rows)
    assert source_mix.mix_documents(table(spark, [])).collect() == []
    nothing = source_mix.mix_documents(table(spark, [(1, "", "x"), (2, None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


def test_drawing_repeats_whole_rows(spark):
    rows = corpus(120)
    df = table(spark, rows).withColumn("mark", F.lit(1)).withColumn("copies", F.lit("x"))
    drawn = source_mix.draw(df)
    assert drawn.columns == df.columns
    taken = {r.doc_id: r.taken // max(r.size, 1) for r in source_mix.mix_documents(df).collect()}
    assert {r.doc_id: r["count"] for r in drawn.groupBy("doc_id").count().collect()} == {k: v for k, v in taken.items() if v}


def test_only_dataframe_functions(spark):
    plan = source_mix.mix_documents(table(spark, corpus(50)))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("share", [0.5, 1.0])
def test_a_running_total_is_that_of_one_sort(spark, share):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 13).alias("v")).sample(share, 1)
    got = {r.id: r.total for r in source_mix.running_total(df.repartition(5), [F.col("id").desc()], "v").collect()}
    run, want = 0, {}
    for r in sorted(df.collect(), key=lambda r: -r.id):
        run += r.v
        want[r.id] = run
    assert got == want
