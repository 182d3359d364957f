"""Streams fed file by file: out-of-order copies, a restatement, a replayed batch."""

from pyspark.sql import functions as F

from admere.streaming import jobs

SCHEMA = "id int, who string, ts timestamp, v int, day date"


def feed(spark, folder, rows, name):
    df = spark.createDataFrame(rows, "id int, who string, ts string, v int").withColumn("ts", F.to_timestamp("ts")).withColumn("day", F.to_date("ts"))
    df.coalesce(1).write.mode("append").parquet(str(folder))


def test_dedupe_and_sessions_over_several_files(spark, tmp_path):
    source, sink, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    files = [
        [(1, "a", "2024-01-01 10:00:00", 1), (2, "a", "2024-01-01 10:05:00", 2)],
        [(1, "a", "2024-01-01 10:00:00", 1), (3, "b", "2024-01-02 09:00:00", 3)],
        [(4, "a", "2024-01-01 23:00:00", 4), (3, "b", "2024-01-02 09:00:00", 3)],  # a day late, within the watermark
    ]
    sessions, cp2 = str(tmp_path / "sessions"), str(tmp_path / "cp2")
    for i, rows in enumerate(files):
        feed(spark, source, rows, i)
        stream = jobs.file_stream(spark, str(source), SCHEMA)
        jobs.append_sink(jobs.dedupe_stream(stream, "ts", ["id"]), sink, cp).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [1, 2, 3, 4]
    stream = jobs.file_stream(spark, sink, SCHEMA, files_per_batch=1)
    parts = jobs.session_stream(stream, "ts", ["who"], {"n": F.count(F.lit(1)), "total": F.sum("v")}, span="12 hours")
    jobs.upsert_sink(parts, sessions, cp2, ["who", "window_start"], "window_day", ["n"], output_mode="update").awaitTermination()
    stored = spark.read.parquet(sessions)
    assert stored.count() == 3  # the session of a has a morning and an evening part
    whole = jobs.whole_sessions(stored, ["who"], {"n": F.sum("n"), "total": F.sum("total")})
    assert {r.who: (r.n, r.total) for r in whole.collect()} == {"a": (3, 7), "b": (1, 3)}


def test_restatement_and_replay(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    feed(spark, source, [(1, "x", "2024-01-01 01:00:00", 1), (2, "y", "2024-01-01 02:00:00", 1)], 0)
    for cp in ("cp1", "cp1", "cp2"):  # the last run replays every file into the same table
        stream = jobs.file_stream(spark, str(source), SCHEMA, files_per_batch=1)
        jobs.upsert_sink(stream, sink, str(tmp_path / cp), ["who"], "day", ["v", "id"]).awaitTermination()
        feed(spark, source, [(3, "x", "2024-01-02 01:00:00", 5)], 1)
    got = sorted((r.who, r.v, str(r.day)) for r in spark.read.parquet(sink).collect())
    assert got == [("x", 5, "2024-01-02"), ("y", 1, "2024-01-01")]


def test_sessions_by_gap(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    feed(spark, source, [(1, "a", "2024-01-01 10:00:00", 1), (2, "a", "2024-01-01 10:20:00", 1), (3, "a", "2024-01-01 12:00:00", 1)], 0)
    feed(spark, source, [(9, "z", "2024-02-01 00:00:00", 1)], 1)  # moves the watermark past the sessions
    for _ in range(2):
        stream = jobs.file_stream(spark, str(source), SCHEMA, files_per_batch=1)
        rolled = jobs.gap_session_stream(stream, "ts", ["who"], "30 minutes", {"n": F.count(F.lit(1))}).select("who", "n", F.col("session_window.start").alias("start"))
        jobs.append_sink(rolled, sink, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.who, r.n) for r in spark.read.parquet(sink).collect()) == [("a", 1), ("a", 2)]


def test_rows_behind_the_watermark_are_kept_aside(spark, tmp_path):
    source, late, marks, sink = tmp_path / "in", str(tmp_path / "late"), str(tmp_path / "marks"), str(tmp_path / "out")
    files = [
        [(1, "a", "2024-01-10 00:00:00", 1)],
        [(2, "a", "2024-01-08 00:00:00", 1), (3, "a", "2024-01-01 00:00:00", 1), (4, "a", "2024-01-11 00:00:00", 1)],
        [(5, "a", "2024-01-08 00:00:00", 1)],  # on the watermark
    ]
    for i, rows in enumerate(files):
        feed(spark, source, rows, i)
        stream = jobs.file_stream(spark, str(source), SCHEMA)
        jobs.late_sink(stream, "ts", late, marks, str(tmp_path / "cp")).awaitTermination()
        jobs.append_sink(jobs.dedupe_stream(jobs.file_stream(spark, str(source), SCHEMA), "ts", ["id"]), sink, str(tmp_path / "cp2")).awaitTermination()
    aside = sorted(r.id for r in spark.read.parquet(late).collect())
    assert aside == [3, 5]
    # no row is lost between the two tables, and none is in both
    assert sorted([*aside, *(r.id for r in spark.read.parquet(sink).collect())]) == [1, 2, 3, 4, 5]
    # a replay of all files writes the same rows again
    jobs.late_sink(jobs.file_stream(spark, str(source), SCHEMA, files_per_batch=1), "ts", late, marks, str(tmp_path / "cp3")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(late).collect()) == [3, 5]
