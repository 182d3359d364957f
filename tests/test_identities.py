"""Components of hot stars and of graphs that grow."""

import random
import statistics

from admere.operators import identity
from admere.plans.identities import Labels


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def components(df):
    return {r["node"]: r["component"] for r in df.collect()}


def test_hot_nodes_change_no_component(spark, monkeypatch):
    monkeypatch.setattr(identity, "HOT_DEGREE", 3)
    rng = random.Random(4)
    edges = [("m0", f"z{i}") for i in range(200)] + [(f"a{i}", "z7") for i in range(50)] + [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(150)]
    df = spark.createDataFrame(edges, "src string, dst string")
    assert components(identity.connected_components(df)) == union_find(edges)


def test_the_star_of_a_hot_node_is_not_shuffled(spark):
    """No task reads more than three times the median, counted by partition of what the join shuffles."""
    from pyspark.sql import functions as F

    links = spark.range(100_000).select(F.concat(F.lit("z"), F.col("id")).alias("u"), F.lit("a").alias("v"))
    more = spark.range(20_000).select(F.concat(F.lit("y"), F.col("id")).alias("u"), F.concat(F.lit("b"), F.col("id") % 5000).alias("v"))
    star = identity._large_star(links.union(more), 64)
    sizes = [r["n"] for r in star.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 120_000
    both = links.union(more).select(F.col("u").alias("n"), F.col("v").alias("m")).union(links.union(more).select(F.col("v").alias("n"), F.col("u").alias("m")))
    least = both.groupBy("n").agg(F.min("m").alias("root"), F.count(F.lit(1)).alias("degree"))
    # what goes through the exchange of the join: the links of all but the hot node
    assert least.filter("degree > 64").count() == 1
    shuffled = both.join(least.filter("degree <= 64"), "n").repartition(8, "n").groupBy(F.spark_partition_id()).count()
    counts = [r["count"] for r in shuffled.collect()]
    assert max(counts) < 3 * statistics.median(counts)
    plan = identity._with_least(both, least, 64)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_labels_of_a_growing_graph(spark, tmp_path):
    rng = random.Random(7)
    labels, seen = Labels(spark, str(tmp_path / "labels")), []
    assert components(labels.read()) == {}
    for load in range(4):
        edges = [(f"n{rng.randrange(60 * (load + 1))}", f"n{rng.randrange(60 * (load + 1))}") for _ in range(25)]
        before = components(labels.read())
        changes = {r["old"]: r["new"] for r in labels.add(spark.createDataFrame(edges, "src string, dst string")).collect()}
        seen += edges
        now = components(labels.read())
        assert now == union_find(seen)
        assert {n: changes.get(c, c) for n, c in before.items()} == {n: now[n] for n in before}
        assert set(changes) <= set(before.values())
    again = labels.add(spark.createDataFrame(edges, "src string, dst string"))  # the same load once more
    assert again.count() == 0 and components(labels.read()) == union_find(seen)
    assert labels.add(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_a_round_writes_its_large_star_once(spark, monkeypatch):
    """The second step read the first one's plan four times over, so each round did the first step several times."""
    written, keep, given = [], identity.stable, []
    monkeypatch.setattr(identity, "stable", lambda df: written.append(keep(df)) or written[-1])
    monkeypatch.setattr(identity, "_small_star", lambda links, degree, real=identity._small_star: given.append(links) or real(links, degree))
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "src string, dst string")
    found = {r.node: r.component for r in identity.connected_components(df).collect()}
    assert found == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}
    assert given and all(any(links is kept for kept in written) for links in given)
