"""Streams over the event file, run to the end; the sinks must equal the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.proofs.registry import Tables, proof
from admere.session import scratch_path
from admere.sources.versioned import VersionedTable
from admere.streaming import jobs


def _event_stream(t: Tables) -> DataFrame:
    schema = t.spark.read.parquet(f"{t.sf_dir}/events.parquet").schema
    return jobs.file_stream(t.spark, t.sf_dir, schema, "events.parquet", 1).withColumn("ts", F.col("ts").cast("timestamp"))


def _finish(query) -> None:
    query.awaitTermination()


@proof("event_id:i user_id:i event_type value:n2", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedupe(t: Tables) -> DataFrame:
    """Purchases are sent twice; the stream keeps one of each."""
    copies = F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = _event_stream(t).withColumn("copy", F.explode(copies))
    path = scratch_path(t.spark, "stream-dedupe")
    _finish(jobs.append_sink(jobs.dedupe_stream(sent, "ts", ["event_id", "user_id"]).drop("copy"), path, scratch_path(t.spark, "cp")))
    return t.spark.read.parquet(path)


@proof("user_id:i week:d started:t ended:t n:i buys:i", "SELECT user_id, date_trunc('week', ts) AS week, min(ts) AS started, max(ts) AS ended, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS buys FROM events GROUP BY 1, 2")
def stream_sessions(t: Tables) -> DataFrame:
    """Sessions of a visitor and week, in daily parts; every change of a part replaces its row."""
    session = ["user_id", "week"]
    parts = jobs.session_stream(
        _event_stream(t).withColumn("week", F.to_date(F.date_trunc("week", "ts"))), "ts", session,
        {"started": F.min("ts"), "ended": F.max("ts"), "n": F.count(F.lit(1)), "buys": F.count_if(F.col("event_type") == "purchase")},
    )
    path = scratch_path(t.spark, "stream-sessions")
    _finish(jobs.upsert_sink(parts, path, scratch_path(t.spark, "cp"), [*session, "window_start"], "window_day", ["n"], output_mode="update"))
    merges = {"started": F.min("started"), "ended": F.max("ended"), "n": F.sum("n"), "buys": F.sum("buys")}
    return jobs.whole_sessions(t.spark.read.parquet(path), session, merges)


@proof("user_id:i day:d event_id:i value:n2", "SELECT DISTINCT ON (user_id, CAST(ts AS DATE)) user_id, CAST(ts AS DATE) AS day, event_id, value FROM events ORDER BY user_id, CAST(ts AS DATE), ts DESC, event_id DESC")
def stream_upsert(t: Tables) -> DataFrame:
    """The latest event of a visitor and day restates the earlier ones."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "stream-upsert"), "day")
    rows = _event_stream(t).withColumn("day", F.to_date("ts"))
    _finish(jobs.upsert_sink(rows, table, scratch_path(t.spark, "cp"), ["user_id", "day"], "day", ["ts", "event_id"]))
    return table.read()
