"""Versions of a table: what readers see, what a stopped writer leaves, and which folders an upsert opens."""

import pathlib

import pytest
from pyspark.sql import functions as F

from admere.plans import incremental
from admere.sources.tables import upsert
from admere.sources.versioned import VersionedTable

SPEC = "k long, v long, n long, day string"


def days(spark, rows):
    return spark.createDataFrame(rows, SPEC).withColumn("day", F.to_date("day"))


def shown(df):
    return sorted((r.k, r.v, str(r.day)) for r in df.collect())


def table(spark, path, links=((("k",), None),)):
    return VersionedTable(spark, str(path), "day", links)


FIRST = [(1, 10, 1, "2024-01-01"), (2, 20, 1, "2024-01-02"), (3, 30, 1, None), (4, 40, 1, "2024-01-04"), (None, 50, 1, "2024-01-04")]
OLD = [(1, 10, "2024-01-01"), (2, 20, "2024-01-02"), (3, 30, "None"), (4, 40, "2024-01-04"), (None, 50, "2024-01-04")]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def seen(t, version=None):
    return order((r.k, r.v, str(r.day)) for r in t.read(version).collect())


def test_versions_stay_readable(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.read() is None and t.versions() == []
    t.upsert(days(spark, FIRST), ["k"], ["n"])
    reader = t.read()
    # 1 moves to a new day, whose old partition is left empty; 3 leaves the partition without a day
    t.upsert(days(spark, [(1, 11, 2, "2024-01-05"), (3, 31, 2, "2024-01-02"), (9, 90, 1, None)]), ["k"], ["n"])
    want = [(1, 11, "2024-01-05"), (2, 20, "2024-01-02"), (3, 31, "2024-01-02"), (4, 40, "2024-01-04"), (9, 90, "None"), (None, 50, "2024-01-04")]
    assert seen(t) == order(want) and seen(t, 1) == order(OLD) and order(shown_none(reader)) == order(OLD)
    assert t.versions() == [1, 2] and t.read().schema == days(spark, []).schema
    t.append(days(spark, [(7, 70, 1, "2024-01-02")]))
    assert seen(t) == order([*want, (7, 70, "2024-01-02")])
    t.upsert(days(spark, [(7, 71, 2, "2024-01-02")]), ["k"], ["n"])  # its partition now has two folders
    assert seen(t) == order([*want, (7, 71, "2024-01-02")])
    t.vacuum(keep=1)
    assert t.versions() == [4] and seen(t) == order([*want, (7, 71, "2024-01-02")])
    loads = {load for _, load in t.manifest()["folders"]}
    assert {p.name for p in (tmp_path / "t/data").iterdir()} == {f"__load={x}" for x in loads} == {p.name for p in (tmp_path / "t/index").iterdir()}
    t.replace(days(spark, []))
    assert seen(t) == [] and t.read().schema == days(spark, []).schema


def shown_none(df):
    return [(r.k, r.v, str(r.day)) for r in df.collect()]


@pytest.mark.parametrize("step", ["_write", "_publish"])
def test_a_writer_stopped_at_any_step_leaves_a_whole_version(spark, tmp_path, monkeypatch, step):
    t = table(spark, tmp_path / "t")
    t.upsert(days(spark, FIRST), ["k"], ["n"])
    batch = days(spark, [(1, 11, 2, "2024-01-02"), (4, 41, 2, None)])
    real = getattr(VersionedTable, step)

    def stop(self, *args):
        if step == "_write":  # files are there, the index and the version are not
            args[0].write.partitionBy("day").parquet(f"{self.path}/data/__load=lost")
        raise RuntimeError("lost")

    monkeypatch.setattr(VersionedTable, step, stop)
    with pytest.raises(RuntimeError):
        t.upsert(batch, ["k"], ["n"])
    assert seen(t) == order(OLD) and t.versions() == [1]
    monkeypatch.setattr(VersionedTable, step, real)
    for _ in range(2):  # a finished batch changes nothing when it comes again
        t.upsert(batch, ["k"], ["n"])
        assert seen(t) == order([(1, 11, "2024-01-02"), (2, 20, "2024-01-02"), (3, 30, "None"), (4, 41, "None"), (None, 50, "2024-01-04")])
    t.vacuum(keep=1)
    assert not (tmp_path / "t/data/__load=lost").exists()


def test_two_writers_of_one_version(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.replace(days(spark, FIRST))
    before, schema = t.manifest(), days(spark, []).schema
    t.append(days(spark, [(5, 5, 1, "2024-01-01")]))
    load, folders = t._write(days(spark, [(6, 6, 1, "2024-01-01")]))
    with pytest.raises(Exception, match="(?i)exist"):
        t._publish(before, schema, before["folders"] + folders, {load: []})
    assert len(seen(t)) == 6 and t.versions() == [1, 2]


def unreadable(t, *folders):
    """Spoil the data files of partitions, so that a job that opens one fails."""
    for folder, load in t.manifest()["folders"]:
        if folder in folders:
            for file in (pathlib.Path(t.path) / f"data/__load={load}/{folder}").glob("*.parquet"):
                file.write_bytes(b"spoilt")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def test_an_upsert_opens_only_partitions_that_may_hold_its_keys(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(days(spark, FIRST), ["k"], ["n"])
    unreadable(t, "day=2024-01-04", "day=__HIVE_DEFAULT_PARTITION__")
    t.upsert(days(spark, [(1, 11, 2, "2024-01-02"), (8, 80, 1, "2024-01-03")]), ["k"], ["n"])
    assert t.touched(days(spark, [(4, 0, 0, "2024-01-02")]), [(["k"], None)]) == {d for d in _dates("2024-01-02", "2024-01-04")}
    rows = t.read(only=_dates("2024-01-02", "2024-01-03", "2024-01-01"))
    assert shown(rows) == [(1, 11, "2024-01-02"), (2, 20, "2024-01-02"), (8, 80, "2024-01-03")]


def _dates(*texts):
    import datetime

    return [datetime.date.fromisoformat(t) for t in texts]


def test_a_load_without_the_link_is_searched(spark, tmp_path):
    table(spark, tmp_path / "t", links=()).replace(days(spark, FIRST))
    t = table(spark, tmp_path / "t")
    t.upsert(days(spark, [(1, 11, 2, "2024-01-02")]), ["k"], ["n"])
    assert (1, 11, "2024-01-02") in seen(t) and len(seen(t)) == 5


def test_conditions_and_wider_types(spark, tmp_path):
    open_rows = (["v"], "n = 1")
    t = table(spark, tmp_path / "t", [open_rows])
    t.replace(days(spark, [(1, 10, 1, "2024-01-01"), (2, 10, 2, "2024-01-02"), (3, 11, 1, "2024-01-03")]))
    batch = days(spark, [(9, 10, 5, "2024-02-01")]).withColumn("v", F.col("v").cast("int"))
    assert {str(d) for d in t.touched(batch, [open_rows])} == {"2024-01-01", "2024-02-01"}


def test_the_writer_of_plain_tables_takes_versioned_ones(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for rows in (FIRST, [(1, 11, 2, "2024-01-02")]):
        upsert(days(spark, rows), t, ["k"], "day", ["n"])
    assert (1, 11, "2024-01-02") in seen(t) and t.versions() == [1, 2]
    with pytest.raises(ValueError):
        upsert(days(spark, FIRST), t, ["k"], "v", ["n"])


def test_a_daily_load_opens_no_partition_without_its_sessions(spark, tmp_path):
    import deliveries
    from admere.plans import staging
    from admere.plans.build import Build

    deliveries.deliver(tmp_path / "landing")
    build = Build(spark, str(tmp_path / "landing"), str(tmp_path / "tables"), ["staff.example"])
    raw = build.raw["ga4_events"]
    t = incremental.event_table(spark, str(tmp_path / "events"))
    incremental.load_events(raw.filter(F.col("dt") <= F.lit("2026-03-04").cast("date")), t)
    # a day long past, with a session of its own
    old = t.read().limit(1).withColumn("event_date", F.lit("2026-01-01").cast("date"))
    for name in ("event_fingerprint", "user_pseudo_id", "transaction_id"):
        old = old.withColumn(name, F.lit("long ago"))
    t.append(old.withColumn("ga_session_id", F.lit(-1).cast(dict(old.dtypes)["ga_session_id"])).withColumn("is_provisional", F.lit(False)))
    unreadable(t, "event_date=2026-01-01")
    incremental.load_events(raw, t)
    fresh = t.read().filter(F.col("event_date") > "2026-01-01").select(*staging.EVENT_COLUMNS)
    want = staging.ga4_events(raw, build.zone).select(*staging.EVENT_COLUMNS)
    kept = [d for d, _ in t.manifest()["folders"] if d != "event_date=2026-01-01"]
    days_left = t.read(only=[None, *_dates(*[d.split("=")[1] for d in kept if "HIVE" not in d])])
    assert sorted(map(repr, days_left.select(*staging.EVENT_COLUMNS).collect())) == sorted(map(repr, want.collect()))
    assert "event_date=2026-01-01" in [d for d, _ in t.manifest()["folders"]] and fresh.columns
