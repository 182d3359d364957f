"""The physical plans the operators are written for."""

import pytest
from pyspark.sql import functions as F

from admere.functions import nested
from admere.operators import matching, sessions, spread, versions
from admere.plans import conformed, staging
from admere.sources import files, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "t")
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"), F.timestamp_seconds("id").alias("ts"),
        F.lit("x").alias("unused"), F.expr("date_add(date'2024-01-01', cast(id % 10 as int))").alias("dt"),
    )
    df.write.partitionBy("dt").parquet(path)
    return spark.read.parquet(path)


def test_versions_are_cut_before_the_shuffle(wide):
    text = plan(versions.latest_version(wide, ["k"], ["v"]))
    before = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_group_values_use_no_window(wide):
    text = plan(spread.with_group_values(wide, ["k"], {"n": F.count(F.lit(1))}))
    assert "Window" not in text and "partial_count" in text


def test_or_join_and_nearest_session_are_equi_joins(wide):
    orders = wide.select(F.col("v").alias("o"), F.col("ts").alias("o_ts"), "k")
    visits = wide.select(F.col("v").alias("s"), F.col("ts").alias("s_ts"), "k", F.col("v").alias("link"))
    names = dict(order_id="o", order_at="o_ts", session_id="s", session_at="s_ts", person="k", link="link")
    for df in (matching.best_session(orders, visits, **names), matching.candidate_counts(orders, visits, **names)):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "SinglePartition" not in text


def test_newest_date_is_a_subquery_not_a_window(wide):
    text = plan(staging.mark_provisional(wide.withColumn("event_date", F.col("dt"))))
    assert "Window" not in text and "Subquery" in text


def test_lookback_prunes_folders_and_columns(wide):
    import datetime

    text = plan(tables.lookback(wide, datetime.date(2024, 1, 9)).select("v"))
    assert "PartitionFilters: [isnotnull(dt" in text and "ReadSchema: struct<v:bigint>" in text


def test_nested_reads_only_the_fields_used(spark, tmp_path):
    schema = files.schemas.EVENT_SCHEMA
    empty = spark.createDataFrame([], schema + ", dt DATE, source_file_name STRING")
    empty.write.parquet(str(tmp_path / "e"))
    text = plan(spark.read.parquet(str(tmp_path / "e")).select("device.category"))
    assert "ReadSchema: struct<device:struct<category:string>>" in text


def test_raw_events_are_parsed_once(spark, tmp_path):
    import gzip

    folder = tmp_path / "events" / "dt=2024-01-01"
    folder.mkdir(parents=True)
    with gzip.open(folder / "events.json.gz", "wt") as file:
        file.write('{"event_date":"20240101","event_timestamp":1704067200000000,"event_name":"x","user_pseudo_id":"u"}\n' * 3)
    raw = files.read_nested_json(spark, str(tmp_path / "events"), "*.json.gz", files.schemas.EVENT_SCHEMA)
    landed = files.land(raw)
    text = plan(staging.ga4_events(landed))
    assert plan(raw.hint("rebalance", "dt")).count("FileScan json") == 1 and "FileScan json" not in text and "FileScan parquet" in text
    assert staging.ga4_events(landed).count() == 1


def test_headers_join_without_shuffling_lines(spark, tmp_path):
    lines = spark.createDataFrame([("segments_date,b", "f1"), ("2024-01-01,2", "f1"), ("b,x", "f2"), ("2024-01-01,3", "f1")], "raw_line string, source_file_name string")
    lines.withColumn("dt", F.lit("2024-01-01").cast("date")).write.parquet(str(tmp_path / "l"))
    df = staging.by_header(spark.read.parquet(str(tmp_path / "l")), "segments_date", ["segments_date", "b", "c"])
    text = plan(df)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and text.count("FileScan parquet") == 2
    assert sorted((r.b, r.c) for r in df.collect()) == [("2", None), ("3", None)]


def test_session_rollup_aggregates_before_the_shuffle(spark, wide):
    events = wide.select(
        F.col("k").alias("user_pseudo_id"), F.col("k").alias("ga_session_id"), F.col("ts").alias("event_timestamp_utc"), F.col("dt").alias("event_date"), "dt",
        *[F.lit("a").alias(c) for c in ("city", "device_category", "operating_system", "transaction_id", "source_file_name", *sessions.CARRIED)],
        F.lit(False).alias("is_internal_traffic"), F.lit(False).alias("is_provisional"), F.lit(1).alias("engagement_time_msec"),
    )
    text = plan(sessions.roll_up(events))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_min_by" in text


def test_sessions_read_people_of_named_orders_only(spark, monkeypatch):
    """All orders went through the joins to identities and sessions, most of them named by no event."""
    written, keep = [], conformed.stable
    monkeypatch.setattr(conformed, "stable", lambda df: written.append(keep(df)) or written[-1])
    monkeypatch.setattr(conformed, "place_sessions", lambda rolled, named, people, clicks, ads: people)
    monkeypatch.setattr(conformed, "roll_up", lambda events: None)
    monkeypatch.setattr(conformed, "session_orders", lambda events: None)
    monkeypatch.setattr(conformed, "current_ads", lambda meta: None)
    orders = spark.range(100).select(F.concat(F.lit("O"), "id").alias("order_id"), F.concat(F.lit("C"), F.col("id") % 7).alias("customer_id"))
    identity = spark.range(7).select(F.concat(F.lit("C"), "id").alias("customer_id"), F.col("id").cast("string").alias("customer_key"))
    events = spark.createDataFrame([("O1",), ("O1",), (None,), ("O9",), ("none",)], "transaction_id string")
    found = conformed.sessions(events, orders, identity, None, None)
    assert sorted((r.order_id, r.customer_key) for r in found.collect()) == [("O1", "1"), ("O9", "2")] and len(written) == 1


def test_whole_orders_carry_no_person_key_to_their_session(spark, monkeypatch):
    """The key joined first, so that each order carried it through the shuffle by order id."""
    seen = []
    monkeypatch.setattr(conformed, "chosen_sessions", lambda genuine, sessions: genuine.select("order_id"))
    monkeypatch.setattr(conformed, "with_session", lambda orders, chosen, real=conformed.with_session: seen.append(orders.columns) or orders)
    monkeypatch.setattr(conformed, "ORDER_COLUMNS", ("order_id", "customer_key"))
    orders = spark.createDataFrame([("O1", "C1", False), ("O2", "C1", True)], "order_id string, customer_id string, is_test_order boolean")
    identity = spark.createDataFrame([("C1", "k")], "customer_id string, customer_key string")
    assert [tuple(r) for r in conformed.orders_attributed(orders, identity, None).collect()] == [("O1", "k")]
    assert seen == [["order_id", "customer_id", "is_test_order"]]


def test_orders_stay_where_they_are_for_the_internal_flag(spark, monkeypatch):
    """Only internal customers tell; joining all of them shuffled every order once more."""
    written, keep = [], staging.stable
    monkeypatch.setattr(staging, "stable", lambda df: written.append(keep(df)) or written[-1])
    names = ["order_id", "customer_id", "order_ts", "currency", "subtotal", "discount", "revenue", "status", "item_count", "updated_at"]
    row = lambda o, c, revenue: (o, c, "2024-01-01 00:00:00", "ZAR", "5", "", revenue, "completed", "1", "2024-01-01 00:00:00", "f")
    raw = spark.createDataFrame([row("O1", "C1", "9"), row("O2", "C2", "9"), row("O3", None, "9"), row("O4", "C2", "1")], ", ".join(f"{n} string" for n in [*names, "source_file_name"])).withColumn("dt", F.lit("2024-01-01").cast("date"))
    customers = spark.createDataFrame([("C1", True), ("C2", False), (None, False)], "customer_id string, is_internal_customer boolean")
    found = staging.crm_orders(raw, customers)
    assert {r.order_id: r.is_test_order for r in found.collect()} == {"O1": True, "O2": False, "O3": False, "O4": True}
    assert [df.count() for df in written] == [1]


def test_a_json_line_is_parsed_once(spark):
    lines = spark.createDataFrame([('{"a": "1"}',), ('{"a": ',)], "raw_line string")
    good, bad = nested.split_json(lines)
    assert plan(good.select(nested.json_text(F.col("payload"), "$.a"))).count("parseJson") == 1
    assert [r[0] for r in good.select(nested.json_text(F.col("payload"), "$.a")).collect()] == ["1"] and bad.count() == 1


def test_tables_are_written_with_an_entropy_coder(spark, tmp_path):
    tables.write_full(spark.range(3), str(tmp_path / "t"))
    assert list((tmp_path / "t").glob("*.zstd.parquet")) and not list((tmp_path / "t").glob("*.snappy.parquet"))
