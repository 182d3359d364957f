"""Daily loads of sessions, orders and facts against full refreshes, and which partitions they open."""

import datetime

import pytest
from pyspark.sql import functions as F

import deliveries
from admere.plans import conformed, propagate
from admere.plans.build import Build
from admere.sources import versioned
from admere.sources.versioned import VersionedTable
from test_versioned import days, unreadable

TABLES = ("int_sessions", "int_orders_attributed", "fct_sessions", "fct_orders")
#: What an attributed order has from its session.
SHARED = set(conformed.ATTRIBUTED_FROM) - {"customer_key", "transaction_id", "source_file_name"} | {"exact_transaction_match"}


def shown(tables, name):
    columns = sorted(tables[name].columns)
    return sorted(map(repr, tables[name].select(*columns).collect()))


def until(spark, landing, day, root):
    """A build that sees the deliveries up to a day."""
    build = Build(spark, str(landing), str(root), ["staff.example"])
    build.raw = {name: rows.filter(F.col("dt") <= F.lit(day).cast("date")) for name, rows in build.raw.items()}
    return build


def more(root):
    """Days that change old sessions: an order of an earlier visitor, a click and an ad delivered late, events without ids."""
    put, event = deliveries.put, deliveries.event
    deliveries.put_events(root, "2026-03-11", [
        event("20260311", "2026-03-11 08:00:00", "purchase", "v3", 6, tx="o8", value={"double_value": 70.0}),
        event("20260311", "2026-03-11 09:00:00", "page_view", None, None),
        event("20260311", "2026-03-11 09:05:00", "page_view", "v4", 1, "https://shop.example/?gclid=g-late"),
        event("20260311", "2026-03-11 09:06:00", "page_view", "v5", 1, "https://shop.example/?utm_source=Facebook&utm_content=m9"),
    ])
    deliveries.put_events(root, "2026-03-12", [
        event("20260312", "2026-03-12 09:00:00", "page_view", None, None),
        event("20260312", "2026-03-12 09:30:00", "page_view", "v1", 9),
    ])
    put(root, "crm/dt=2026-03-12/orders.csv", deliveries.ORDERS + "o8,c4,2026-03-11 08:00:01,ZAR,70,0,70.00,completed,1,2026-03-12 01:00:00\n")
    put(root, "crm/dt=2026-03-12/customers.csv", deliveries.CUSTOMERS + "ghost,gus@mail.example,Gus,G,0831119999,Durban,2026-03-06 07:00:00,false,true\n")
    put(root, "google_ads/dt=2026-03-12/click_view.csv", deliveries.CLICKS + "2026-03-11,g-late,G7,grp,a7,Durban\n")
    put(root, "meta_ads/dt=2026-03-12/insights.jsonl", deliveries.insight("2026-03-11", "2026-03-12 06:00:00", "1.00", "0", ad="m9") + "\n")


def test_a_stopped_and_repeated_daily_run_equals_a_full_refresh(spark, tmp_path, monkeypatch):
    """And it opens no partition that it does not touch."""
    landing = tmp_path / "landing"
    deliveries.deliver(landing)
    more(landing)

    def daily(day):
        build = until(spark, landing, day, tmp_path / "daily")
        build.silver(full_refresh=False, last_day="2026-03-12")
        propagate.facts(build.versioned)
        return build

    first = daily("2026-03-10")
    # On 03-04 only v2 came, and nothing delivered later is about v2 or the person behind.
    for name in ("int_session_rollup", "int_sessions", "fct_sessions"):
        assert "session_date=2026-03-04" in [f for f, _ in first.versioned[name].manifest()["folders"]]
        unreadable(first.versioned[name], "session_date=2026-03-04")
    real = VersionedTable._publish

    def stop(self, *args):
        if self.path.endswith("int_orders_attributed"):  # sessions are there, their orders are not
            raise RuntimeError("lost")
        return real(self, *args)

    monkeypatch.setattr(VersionedTable, "_publish", stop)
    with pytest.raises(RuntimeError):
        daily("2026-03-12")
    monkeypatch.setattr(VersionedTable, "_publish", real)
    tables = daily("2026-03-12").versioned
    whole = until(spark, landing, "2026-03-12", tmp_path / "whole")
    whole.silver(last_day="2026-03-12")
    propagate.facts(whole.versioned, full=True)
    for name in TABLES:
        folders = {f for f, _ in tables[name].manifest()["folders"]} - {"session_date=2026-03-04"}
        assert not any("HIVE" in f for f in folders)
        only = [datetime.date.fromisoformat(f.split("=")[1]) for f in folders]
        kept = whole.versioned[name].read()
        if tables[name].partition == "session_date":
            kept = kept.filter("session_date <> '2026-03-04'")
        assert shown({name: tables[name].read(only=only)}, name) == shown({name: kept}, name)
    s = {(r.user_pseudo_id, r.ga_session_id): r for r in whole.load("int_sessions").collect()}
    assert s["v4", 1].campaign_id == "G7" and s["v5", 1].campaign_id == "M1"  # the click and the ad came a day after
    assert s["v3", 4].customer_id == "c4" and (None, None) in s


def test_changes_lookups_and_exchange(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "day", [(("k",), None)])
    t.replace(days(spark, [(1, 10, 1, "2024-01-01"), (2, 20, 1, "2024-01-02"), (None, 30, 1, "2024-01-03"), (4, 40, 1, None), (5, 50, 1, "2024-01-05")]))
    keys = lambda *values: spark.createDataFrame([(v,) for v in values], "k long")
    unreadable(t, "day=2024-01-05")
    assert {(r.k, r.v) for r in t.lookup(keys(1, None, 7), ["k"]).collect()} == {(1, 10), (None, 30)}
    assert t.holding(keys(4), ["k"]) == {None} and t.holding(keys(), ["k"]) == set()
    t.exchange(keys(1, None, 4), days(spark, [(1, 11, 1, "2024-01-02"), (4, 40, 1, None), (8, 80, 1, "2024-01-05")]), ["k"], {"source": 3})
    assert t.notes() == {"source": 3}
    differ = {(r.k, r.v, r.added) for r in t.changes(1).collect()}
    assert differ == {(1, 10, False), (1, 11, True), (None, 30, False), (8, 80, True)}  # 4 was written again as it was
    assert {(r.k, r.added) for r in t.changes(1, ["k"]).collect()} == {(None, False), (8, True)}
    t.exchange(keys(), days(spark, []), ["k"])
    assert t.notes() == {"source": 3} and t.changes(2).count() == 0
    t.vacuum(keep=1)
    assert t.changes(1) is None


def test_uncovered_days(spark):
    from admere.plans.monitoring import uncovered_days

    spec = "ad string, day string, dt string"
    dated = lambda rows: spark.createDataFrame(rows, spec).withColumn("day", F.to_date("day")).withColumn("dt", F.to_date("dt"))
    rows = dated([
        ("a", "2024-01-01", "2024-01-20"), ("a", "2024-01-04", "2024-01-20"), ("a", "2024-01-04", "2024-01-20"), ("a", "2024-01-16", "2024-01-20"),
        ("b", "2024-01-02", "2024-01-03"), (None, "2024-01-01", None), (None, "2024-01-09", None), ("a", None, None),
    ])
    got = [str(r.day) for r in uncovered_days(rows, "ad", "day").orderBy("day").collect()]
    assert got == ["2024-01-02", "2024-01-03", *[f"2024-01-{d:02}" for d in range(5, 14)]]  # 14 and 15 may still come
    assert uncovered_days(dated([]), "ad", "day").count() == 0


def test_partitions_of_one_version_are_taken_whole(spark, tmp_path):
    """Rows of a partition that only the newer version has are neither shuffled for a comparison nor looked up by key."""
    t = VersionedTable(spark, str(tmp_path / "t"), "day", [(("k",), None)])
    t.replace(days(spark, [(1, 10, 1, "2024-01-01"), (2, 20, 1, "2024-01-02")]))
    t.exchange(spark.createDataFrame([(1,)], "k long"), days(spark, [(1, 11, 1, "2024-01-01"), (3, 30, 1, "2024-01-03"), (3, 30, 1, "2024-01-03")]), ["k"])
    found = t.difference(1)
    assert [f for f, _ in found.fresh] == ["day=2024-01-03"]
    assert sorted((r.k, r.v, r.added) for r in found.compared.collect()) == [(1, 10, False), (1, 11, True)]
    assert [(r.k, r.v, r.added) for r in found.whole.collect()] == [(3, 30, True)] * 2
    assert "Exchange" not in found.whole._jdf.queryExecution().executedPlan().toString()
    assert {r.k for r in t.changes(1).collect()} == {1, 3}
    # Without the partition, rows of different days can be equal, so all are compared.
    assert t.difference(1, ["k"]).whole is None and not t.difference(1, ["k"]).fresh
    unreadable(t, "day=2024-01-03")
    keys = spark.createDataFrame([(1,), (3,)], "k long")
    assert [r.v for r in t.lookup(keys, ["k"], besides=found.fresh).collect()] == [11]


def test_settled_rows_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    """A fact takes the rows of new partitions from where they lie; only those of compared ones are dealt out by partition."""
    source, target = (VersionedTable(spark, str(tmp_path / name), "day", [(("k",), None)]) for name in ("source", "target"))
    t = {"source": source, "target": target}
    source.replace(days(spark, [(1, 10, 1, "2024-01-01"), (2, 20, 1, "2024-01-02")]))
    propagate.fact(t, "target", "source", ["k"], lambda rows: rows)
    source.replace(days(spark, [(1, 11, 1, "2024-01-01"), (3, 30, 1, "2024-01-03"), (2, 21, 1, "2024-01-04"), (None, 40, 1, None)]))
    written = []
    real = VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, *rows: written.append(rows) or real(self, *rows))
    propagate.fact(t, "target", "source", ["k"], lambda rows: rows)
    (rows, settled), = written
    assert sorted(r.v for r in rows.collect()) == [11] and sorted(r.v for r in settled.collect()) == [21, 30, 40]
    assert "Exchange" not in settled._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, target.read().collect())) == sorted(map(repr, source.read().collect()))


def test_many_keys_find_their_partitions_by_a_share_of_the_hashes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned, "BROADCAST_ROWS", 50)
    searched = []
    real = VersionedTable._search

    def search(self, batch, keys, condition, manifest, among, *args):
        searched.append((sorted(f for f, _ in among), args[-1]))
        return real(self, batch, keys, condition, manifest, among, *args)

    monkeypatch.setattr(VersionedTable, "_search", search)
    t = VersionedTable(spark, str(tmp_path / "t"), "day", [(("k",), None)])
    many = [(k, 0, 1, f"2024-01-0{1 + k % 2}") for k in range(1000)]
    t.replace(days(spark, [*many, (5000, 0, 1, "2024-01-03"), (None, 0, 1, "2024-01-04"), (7000, 0, 1, "2024-01-05")]))
    wanted = spark.createDataFrame([(k,) for k in (*range(1000), 5000, None)], "k long")
    assert t.holding(wanted, ["k"]) == {datetime.date(2024, 1, d) for d in (1, 2, 3, 4)}
    all_of = [f"day=2024-01-0{d}" for d in range(1, 6)]
    share, rest, null = searched
    assert share == (all_of, True) and not rest[1] and null == (all_of, True)
    assert not {"day=2024-01-01", "day=2024-01-02"} & set(rest[0])


def test_orders_of_a_second_run_equal_a_full_attribution(spark, tmp_path, monkeypatch):
    """Orders without a person, moved, refunded and new ones, by keys few and many."""
    order = ("order_id", "customer_id", "customer_key", "order_timestamp_utc", "revenue", "status", "is_test_order")
    session = ("session_key", "user_pseudo_id", "customer_key", "transaction_id", "session_start_utc", "campaign_id")

    def table(rows, names, columns, date, at):
        made = spark.createDataFrame(rows, ", ".join(f"{n} {'boolean' if n == 'is_test_order' else 'string'}" for n in names))
        made = made.withColumn(at, F.col(at).cast("timestamp")).withColumn(date, F.col(at).cast("date"))
        return made.select("*", *[F.lit(None).cast("string").alias(c) for c in columns if c not in made.columns])

    orders = lambda rows: table(rows, order, [c for c in conformed.ORDER_COLUMNS if c not in ("session_source_file_name", *SHARED)], "order_date", "order_timestamp_utc")
    visits = lambda rows: table(rows, session, conformed.SESSION_COLUMNS, "session_date", "session_start_utc")
    old = [
        ("o1", "c1", "k1", "2024-01-01 10:00:00", "5", "completed", False), ("o2", "c2", None, "2024-01-01 11:00:00", "5", "completed", False),
        ("o3", "c3", "k3", "2024-01-02 10:00:00", "5", "completed", False), ("o4", "c1", "k1", "2024-01-02 12:00:00", "5", "completed", False),
        ("o5", "c5", "k5", "2024-01-02 12:00:00", "5", "completed", False), ("o6", "c6", "k6", "2024-01-02 13:00:00", "5", "completed", True),
    ]
    new = [
        *old[:2], ("o3", "c3", "k3", "2024-01-02 10:00:00", "5", "refunded", False), old[3], ("o5", "c5", "k5", "2024-01-03 12:00:00", "5", "completed", False),
        ("o6", "c6", "k6", "2024-01-02 13:00:00", "5", "completed", False), ("o7", "c1", "k1", "2024-01-03 10:00:00", "5", "completed", False),
        ("o8", "c8", None, "2024-01-04 10:00:00", "5", "completed", False), ("o9", "c9", "k9", "2024-01-04 10:00:00", "5", "completed", True),
    ]
    seen = [("s1", "u1", "k1", None, "2024-01-01 09:00:00", "M1"), ("s2", "u2", None, "o2", "2024-01-01 10:59:00", "M2"), ("s3", "u3", "k3", "o3", "2024-01-02 09:00:00", "M3")]
    later = [
        ("s1", "u1", "k1", None, "2024-01-01 09:00:00", "G1"), *seen[1:], ("s4", "u1", "k1", "o1", "2024-01-03 09:59:00", "M4"),
        ("s5", "u5", "k5", None, "2024-01-03 11:00:00", "M5"), ("s6", "u6", None, "o8", "2024-01-04 09:00:00", "M6"), ("s7", "u7", "k9", "o9", "2024-01-04 09:00:00", "M7"),
    ]
    for most in (0, 1_000_000):
        monkeypatch.setattr(versioned, "BROADCAST_ROWS", most)
        t = propagate.tables(spark, str(tmp_path / f"daily{most}"))
        for people, sessions in ((old, seen), (new, later)):
            t["int_order_people"].replace(orders(people))
            t["int_sessions"].replace(visits(sessions))
            propagate.orders_attributed(t)
            propagate.fact(t, "fct_orders", "int_orders_attributed", ["order_id"], lambda rows: rows)
        whole = conformed.attribute(orders(new).filter("not is_test_order"), visits(later))
        shape = lambda rows: sorted(map(repr, rows.select(*sorted(conformed.ORDER_COLUMNS)).collect()))
        assert shape(t["int_orders_attributed"].read()) == shape(whole) == shape(t["fct_orders"].read())
        campaigns = {r.order_id: r.campaign_id for r in whole.collect()}
        assert campaigns == {"o1": "M4", "o2": "M2", "o3": "M3", "o4": None, "o5": "M5", "o6": None, "o7": "M4", "o8": "M6"}
