"""One key owns a third of all rows: its work must spread over several tasks."""

import time

import pytest
from pyspark.sql import functions as F

from admere.operators import lookup, matching, spread, versions


@pytest.fixture
def no_broadcast(spark):
    """Sizes scaled down so that a small test counts as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(spark, tmp_path):
    df = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"), F.md5(F.col("id").cast("string")).alias("text")
    )
    df.write.parquet(str(tmp_path / "hot"))
    return spark.read.parquet(str(tmp_path / "hot"))


def run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def largest_partition(df):
    # Every column is used, so that no join can be optimized away.
    return df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns) % 7).alias("h")).agg(F.max("n"), F.sum("h")).first()[0]


def test_group_totals_split_the_hot_key(no_broadcast, hot):
    rows, plan = run(spread.with_group_values(hot, ["k"], {"n": F.count(F.lit(1))}))
    assert "skew=true" in plan
    assert len(rows) == 90_000 and sum(r.n for r in rows if r.k == 0) == 30_000 * 30_000


def test_null_keys_spread_without_help(no_broadcast, hot, spark):
    df = hot.withColumn("k", F.nullif("k", F.lit(0)))
    dim = hot.select("k").distinct().withColumn("x", F.lit(1))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert largest_partition(lookup.left_lookup(df, dim, ["k"])) < 12_000
        assert largest_partition(df.join(dim, "k", "left")) > 30_000
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_versions_shuffle_one_row_per_key_and_task(no_broadcast, hot):
    df = versions.latest_version(hot, ["k"], ["v"])
    rows, plan = run(df)
    assert len(rows) == 60_001 and plan.count("WindowGroupLimit") == 2
    assert next(r.v for r in rows if r.k == 0) == 89_997


def test_one_total_order_over_ties(no_broadcast, hot):
    df = spread.global_row_number(hot.select("k", "v"), [F.col("k").asc(), F.col("v").asc()], "n")
    assert largest_partition(df) < 30_000  # the 30,000 equal keys are cut by the second column
    assert df.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 90_000, 90_000)


def test_nearest_session_of_a_hot_person(no_broadcast, spark):
    at = lambda c: F.timestamp_micros(F.col(c) * 60_000_000)
    sessions = spark.range(20_000).select(F.col("id").alias("sid"), at("id").alias("sts"), F.lit(1).alias("who"), F.lit(None).cast("long").alias("link"))
    orders = spark.range(0, 20_000, 10).select(F.col("id").alias("oid"), at("id").alias("ots"), F.lit(1).alias("who"))
    names = dict(order_id="oid", order_at="ots", session_id="sid", session_at="sts", person="who")
    rows = matching.interval_matches(orders, sessions, **names, before=86_400, after=3_600).collect()
    assert len(rows) == 2_000 and all(r.sid == r.oid for r in rows)
    middle = next(r for r in rows if r.oid == 10_000)
    assert middle.n_matches == 1_440 + 1 + 60


def _busy_hour(spark, n):
    """``n`` sessions of one person in one hour, and orders among them."""
    second = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * (3_600_000_000 // n))
    sessions = spark.range(n).select(F.col("id").alias("sid"), F.lit("p").alias("who"), second.alias("sat"))
    orders = spark.range(0, n, n // 50).select(F.col("id").alias("oid"), F.lit("p").alias("who"), (second + F.expr("INTERVAL 10 MICROSECONDS")).alias("oat"))
    return orders, sessions


def test_one_busy_hour_is_linear_and_split(spark, monkeypatch):
    names = {"order_id": "oid", "order_at": "oat", "session_id": "sid", "session_at": "sat", "person": "who"}
    written = []
    monkeypatch.setattr(matching, "stable", lambda df, keep=matching.stable: written.append(keep(df)) or written[-1])
    took = {}
    for n in (40_000, 160_000):
        orders, sessions = _busy_hour(spark, n)
        start = time.time()
        rows = matching.interval_matches(orders, sessions, **names, before=60, after=60).collect()
        took[n] = time.time() - start
        step = 3_600_000_000 // n
        for r in rows:
            # whole seconds decide, then the later start
            assert r.distance_s == 0 and r.sid == min(n - 1, r.oid + (1_000_000 + 9) // step)
            low, high = max(0, r.oid - (60_000_000 - 10) // step), min(n - 1, r.oid + (60_000_000 + 10) // step)
            assert r.n_matches == high - low + 1
        assert len(rows) == 50
    parts = written[-1].groupBy(F.shiftrightunsigned("place", 33)).count().collect()
    assert len(parts) > 2 and max(p["count"] for p in parts) < 100_000
    # a quadratic window would take sixteen times as long
    assert took[160_000] < 8 * max(took[40_000], 1.0)
