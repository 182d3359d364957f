"""Operators against brute force, with one key owning a third of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from admere.functions import clean, creative, nested, values
from admere.operators import checks, identity, lookup, matching, spread, versions
from admere.sources import tables


def test_best_session_against_brute_force(spark):
    rnd = random.Random(5)
    base = 1_700_000_000_000_000
    person = lambda: 1 if rnd.random() < 0.4 else rnd.randint(2, 9)
    at = lambda: base + rnd.randrange(0, 5 * 86_400) * 1_000_000 + rnd.choice([0, 1, 300_000, 700_000])
    orders = [(i, person(), at()) for i in range(150)]
    sessions = []
    for i in range(300):
        who, when = (rnd.choice(orders)[1:] if rnd.random() < 0.5 else (person(), at()))
        when += rnd.choice([0, 400_000, 900_000, -400_000, 3_600_000_000, -86_400_000_000, 3_600_000_001, 5_000_000, 5_400_000])
        sessions.append((1000 + i, who, when, rnd.choice(orders)[0] if rnd.random() < 0.1 else None))
    want, counts = {}, {}
    for o, who, t in orders:
        named = [s for s in sessions if s[3] == o]
        near = [s for s in sessions if s[1] == who and t - 86_400_000_000 <= s[2] <= t + 3_600_000_000]
        both = {s[0]: s for s in named + near}
        counts[o] = len(both)
        if both:
            best = max(both.values(), key=lambda s: (s[3] == o, -(abs(t - s[2]) // 1_000_000), s[2], s[0]))
            want[o] = (best[0], best[3] == o)
    o = spark.createDataFrame(orders, "oid long, who long, us long").withColumn("ots", F.timestamp_micros("us"))
    s = spark.createDataFrame(sessions, "sid long, who long, us long, link long").withColumn("sts", F.timestamp_micros("us"))
    names = dict(order_id="oid", order_at="ots", session_id="sid", session_at="sts", person="who", link="link")
    got = {r.oid: (r.sid, r.exact_transaction_match) for r in matching.best_session(o, s, **names).collect()}
    assert got == want
    assert {r.oid: r.n_candidates for r in matching.candidate_counts(o, s, **names).collect()} == counts


def test_orders_are_matched_without_sorting_them_by_order(spark, monkeypatch):
    """Three points an order and a grouping of rich rows by order made the spill grow faster than the input."""
    at = lambda c: F.timestamp_micros(F.col(c) * 60_000_000)
    orders = spark.range(1000).select(F.col("id").alias("oid"), at("id").alias("ots"), F.concat(F.lit("p"), F.col("id") % 10).alias("who"))
    sessions = orders.filter("who < 'p2'").select(F.col("oid").alias("sid"), F.col("ots").alias("sts"), "who", F.lit(None).cast("long").alias("link"))
    written, keep = [], matching.stable
    monkeypatch.setattr(matching, "stable", lambda df: written.append(keep(df)) or written[-1])
    names = dict(order_id="oid", order_at="ots", session_id="sid", session_at="sts", person="who")
    best = matching.best_session(orders, sessions, **names, link="link")
    assert best.count() == 200 and best.filter("oid <> sid").count() == 0
    # Sessions and one point of each order of the two people seen, in both steps.
    assert [df.count() for df in written if "place" in df.columns] == [400, 400]
    # Nothing of the first step is sorted for an aggregate over its points.
    narrow = matching.interval_matches(orders, sessions, **names, before=60, after=60, counted=False)
    assert narrow.count() == 200
    assert all("n_matches" not in df.columns for df in written)


def test_forward_fill_over_chunks(spark):
    rnd = random.Random(1)
    rows = [(k, d, rnd.choice([None, None, d])) for k in ("hot", "b") for d in range(400)]
    df = spark.createDataFrame(rows, "k string, n int, v int").withColumn("day", F.expr("date_add(date'2024-01-01', n)"))
    got = {(r.k, r.n): r.v for r in spread.forward_fill(df, "day", ["v"], ["k"]).collect()}
    for k in ("hot", "b"):
        last = None
        for kk, n, v in rows:
            if kk == k:
                last = v if v is not None else last
                assert got[k, n] == last


@pytest.mark.parametrize("n", [0, 1, 2, 100, 101])
def test_ntile_equals_the_window_function(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 3).alias("v"))
    order = [F.col("v").desc(), F.col("id").asc()]
    want = {r.id: r.t for r in df.withColumn("t", F.ntile(3).over(Window.orderBy(*order))).collect()}
    assert {r.id: r.t for r in spread.ntile(df, 3, order, "t").collect()} == want


def test_components_against_union_find(spark):
    rnd = random.Random(3)
    edges = [(f"n{rnd.randint(0, 120):03d}", f"n{rnd.randint(0, 120):03d}") for _ in range(90)]
    edges += [(f"chain{i:03d}", f"chain{i + 1:03d}") for i in range(40)] + [("hub", f"leaf{i}") for i in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in identity.connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_bridge_and_chain_identity(spark):
    rows = [("1", "a", "p"), ("2", None, "p"), ("3", "b", "p"), ("4", "b", "q"), ("5", None, "q"), ("6", "z", None), ("7", None, None)]
    df = spark.createDataFrame(rows, "customer_id string, email_hash string, phone_hash string")
    one_hop = {r.customer_id: (r.identity_hash, r.identity_method) for r in identity.bridge_identity(df).collect()}
    assert one_hop["3"] == ("a", "email") and one_hop["2"] == ("a", "phone_to_email_bridge") and one_hop["5"][0] == "b" and one_hop["7"][0] is None
    chain = {r.customer_id: r.component for r in identity.people(df).collect()}
    assert len({chain[k] for k in "12345"}) == 1 and chain["7"] == "c|7" and chain["6"] != chain["1"]


def test_group_values_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 7)], "k string, v int")
    got = sorted((str(r.k), r.v, r.top, r.n) for r in spread.with_group_values(df, ["k"], {"top": F.max("v"), "n": F.count(F.lit(1))}).collect())
    assert got == [("None", 5, 7, 2), ("None", 7, 7, 2), ("a", 1, 2, 2), ("a", 2, 2, 2)]


def test_left_lookup_spreads_null_keys(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"))
    dim = spark.range(0, 3000, 6).select(F.col("id").alias("key"), F.lit("hit").alias("x"))
    joined = lookup.left_lookup(df, dim.hint("merge"), {"k": "key"})
    assert joined.columns == ["id", "k", "x"] and joined.count() == 3000
    assert joined.filter("x = 'hit'").count() == 500 and joined.filter("k is null and x is not null").count() == 0
    plan = joined._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "__salt" in plan


def test_latest_picks_and_ties(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, None), (1, 3, "y"), (2, None, None)], "k int, o int, v string")
    got = {r.k: (r.l, r.i, r.e) for r in df.groupBy("k").agg(
        versions.latest_by("v", "o").alias("l"), versions.latest_by("v", "o", ignore_nulls=True).alias("i"), versions.earliest_by("v", "o", ignore_nulls=True).alias("e")).collect()}
    assert got == {1: (None, "y", "x"), 2: (None, None, None)}


def test_cleaning(spark):
    df = spark.createDataFrame([("0027825550142", "yes"), ("+27 82 555 0142", "TRUE"), ("0825550142", "false"), ("825550142", None), ("n/a", "1")], "p string, b string")
    got = [tuple(r) for r in df.select(clean.phone_key("p"), clean.safe_cast("b", "boolean")).collect()]
    assert got == [("+27825550142", None), ("+27825550142", True), ("+27825550142", False), ("+27825550142", None), (None, None)]
    one = spark.range(1)
    url = F.lit("https://x/?UTM_Source=News%20x&gclid=#top")
    assert tuple(one.select(clean.url_parameter(url, "utm_source"), clean.url_parameter(url, "gclid"), clean.surrogate_key(F.lit("a"), F.lit(None))).first()) == ("News%20x", None, None)
    assert one.select(values.greatest_or_null(F.lit(1), F.lit(None).cast("int"))).first()[0] is None
    assert one.select(values.ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_replies(spark):
    replies = ['{"tone":"urgent","discount_pct":10,"cta":"shop_now","product":"Tent"}', '```json\n{"tone":"PLAYFUL","cta":"dance","product":" "}\n```', "sorry", None]
    df = spark.createDataFrame([(i, "Built for wind, 5% off: Karoo fleece. Learn more", r, "" if r else "quota") for i, r in enumerate(replies)], "i int, copy_text string, model_response string, model_status string")
    got = [(r.tone, r.discount_pct, r.cta, r["product"], r.extraction_method) for r in creative.features(df).orderBy("i").collect()]
    rules = ("informative", 5, "learn_more", "Karoo fleece", "deterministic_fallback")
    assert got == [("urgent", 10, "shop_now", "Tent", "model"), ("playful", 5, "learn_more", "Karoo fleece", "deterministic_fallback"), rules, rules]
    asked = creative.enrich(df.select("i", "copy_text"), lambda prompts: (["{}"] * len(prompts), [""] * len(prompts)))
    assert asked.filter("model_response = '{}' and prompt like '%Karoo%'").count() == 4


def test_zip_arrays_pads_with_null(spark):
    df = spark.sql("select 1 as id, array('a','b','c') as x, array(1,2) as y")
    assert [(r.position, r.x, r.y) for r in nested.zip_arrays(df, {"x": "x", "y": "y"}, ["id"]).collect()] == [(0, "a", 1), (1, "b", 2), (2, "c", None)]


def test_constraints(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "a", None), (2, "b", -1)], "k int, s string, v int")
    report = {r.constraint_name: r.violations for r in checks.constraint_report(df, ["k"], ["s"], {"positive": F.col("v") > 0}).collect()}
    assert report == {"unique:k": 1, "not_null:s": 1, "condition:positive": 1}
    assert checks.assert_empty(df.filter("k > 9"), "none")
    with pytest.raises(checks.BrokenConstraint):
        checks.assert_empty(df, "some")


def test_upsert_moves_a_row_and_drops_the_empty_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "k int, v int, n int, day string").withColumn("day", F.to_date("day"))
    tables.upsert(make([(1, 10, 1, "2024-01-01"), (2, 20, 1, "2024-01-02"), (3, 30, 1, "2024-01-03")]), path, ["k"], "day", ["n"])
    batch = make([(1, 11, 2, "2024-01-02"), (3, 29, 0, "2024-01-03"), (4, 40, 1, "2024-01-04")])
    for _ in range(2):  # the second run changes nothing
        tables.upsert(batch, path, ["k"], "day", ["n"])
        got = sorted((r.k, r.v, str(r.day)) for r in spark.read.parquet(path).collect())
        assert got == [(1, 11, "2024-01-02"), (2, 20, "2024-01-02"), (3, 30, "2024-01-03"), (4, 40, "2024-01-04")]
    assert not tables.table_exists(spark, f"{path}/day=2024-01-01")


def _days(spark, rows):
    return spark.createDataFrame(rows, "k int, v int, n int, day string").withColumn("day", F.to_date("day"))


def _stored(spark, path):
    return sorted((r.k, r.v, str(r.day)) for r in spark.read.parquet(path).collect())


def test_upsert_keeps_rows_without_a_partition_value(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(_days(spark, [(1, 10, 1, None), (2, 20, 1, "2024-01-01")]), path, ["k"], "day", ["n"])
    tables.upsert(_days(spark, [(3, 30, 1, None)]), path, ["k"], "day", ["n"])
    assert _stored(spark, path) == [(1, 10, "None"), (2, 20, "2024-01-01"), (3, 30, "None")]
    # both rows without a value move away, and their folder goes
    tables.upsert(_days(spark, [(1, 11, 2, "2024-01-01"), (3, 31, 2, "2024-01-02")]), path, ["k"], "day", ["n"])
    assert _stored(spark, path) == [(1, 11, "2024-01-01"), (2, 20, "2024-01-01"), (3, 31, "2024-01-02")]


def test_an_upsert_stopped_before_its_removals_is_repaired_by_a_rerun(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(_days(spark, [(1, 10, 1, "2024-01-01"), (2, 20, 1, "2024-01-02")]), path, ["k"], "day", ["n"])
    batch = _days(spark, [(1, 11, 2, "2024-01-02")])

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "remove_folder", stop)
    with pytest.raises(KeyboardInterrupt):
        tables.upsert(batch, path, ["k"], "day", ["n"])
    monkeypatch.undo()
    assert len(_stored(spark, path)) == 3
    tables.upsert(batch, path, ["k"], "day", ["n"])
    assert _stored(spark, path) == [(1, 11, "2024-01-02"), (2, 20, "2024-01-02")]


def test_upsert_by_partition_does_not_search_the_target(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(_days(spark, [(1, 10, 1, "2024-01-01"), (2, 20, 1, "2024-01-02")]), path, ["k", "day"], "day", ["n"])
    seen = []
    monkeypatch.setattr(tables, "stable", lambda df, keep=tables.stable: seen.append(df) or keep(df))
    tables.upsert(_days(spark, [(1, 11, 2, "2024-01-02")]), path, ["k", "day"], "day", ["n"])
    assert _stored(spark, path) == [(1, 10, "2024-01-01"), (1, 11, "2024-01-02"), (2, 20, "2024-01-02")]
    text = seen[-1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day#" in text or "PartitionFilters: [isnotnull(day#" in text


def test_labels_have_numbers_of_their_own(spark):
    from admere.plans import value

    names = list(value.TEXT_INPUTS)
    rows = [[f"l{i}" if c == names[0] else None for c in names] for i in range(3000)]
    features = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    codes = value.label_codes(features)
    assert sorted(r.code for r in codes.filter(F.col("input") == names[0]).collect()) == [float(i + 1) for i in range(3000)]
    other = spark.createDataFrame([["l7", *[None] * (len(names) - 1)], ["new", *[None] * (len(names) - 1)]], features.schema)
    found = {r[names[0]]: r[f"code_{names[0]}"] for r in value.with_codes(other, codes).collect()}
    assert found["new"] == 0 and found["l7"] > 0 and value.with_codes(other, codes).filter(F.col(f"code_{names[1]}") == 1).count() == 2


def test_the_median_error_is_that_of_all_rows(spark):
    from admere.plans import value

    df = spark.range(250_001).select((F.col("id") * 48_271 % 250_001).cast("double").alias("y"), F.lit(0.0).alias("p"))
    assert value.regression_metrics(df, "y", "p").first().median_absolute_error == 125_000.0


def test_global_dense_rank(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 5.0), (4, None), (5, None)], "k int, v double")
    assert {r.k: r.r for r in spread.global_dense_rank(df, "v", "r").collect()} == {2: 1, 1: 2, 3: 2, 4: 3, 5: 3}


def test_null_keys_of_rows_with_maps(spark):
    df = spark.createDataFrame([(None, {"a": 1}), (1, {"b": 2})], "k int, m map<string,int>")
    dim = spark.createDataFrame([(1, "x")], "k int, name string")
    assert sorted((r.k, r.name) for r in lookup.left_lookup(df, dim, ["k"]).collect() if r.k) == [(1, "x")]
