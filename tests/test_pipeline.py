"""The whole pipeline on hand-written deliveries."""

import datetime

import pytest
from pyspark.sql import functions as F

import deliveries
from admere.plans import monitoring, reports, staging, value
from admere.plans.build import Build
from admere.plans.incremental import load_events, load_meta_ads


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    deliveries.deliver(root)
    return root


@pytest.fixture(scope="module")
def build(spark, landing, tmp_path_factory):
    b = Build(spark, str(landing), str(tmp_path_factory.mktemp("tables")), ["staff.example"])
    b.silver(last_day="2026-03-12")
    b.star()
    return b


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_customers(build):
    c = by(build.tables["stg_crm_customers"], "customer_id")
    assert set(c) == {"c1", "c2", "c3", "c4", "qa"}
    assert c["c1"]["phone_hash"] == c["c2"]["phone_hash"] and c["c2"]["email_hash"] is None
    assert [c[k]["city_standard"] for k in ("c1", "c2", "c3")] == ["Cape Town", "Cape Town", "Johannesburg"]
    assert c["c3"]["marketing_opt_in"] is True and c["qa"]["is_internal_customer"] is True
    assert not {"email", "phone", "first_name"} & set(build.tables["stg_crm_customers"].columns)


def test_orders(build):
    o = by(build.tables["stg_crm_orders"], "order_id")
    assert len(o) == 7 and o["o2"]["status"] == "refunded" and o["o3"]["is_test_order"]
    assert o["o5"]["order_date"] == datetime.date(2026, 3, 10)  # 22:30 UTC is the next day there
    items = by(build.tables["stg_crm_order_items"], "sku")
    assert items["k2"]["product_name"] is None and items["k3"]["unit_price"] is None and len(items) == 3


def test_ads_follow_the_header_of_their_file(build):
    g = by(build.tables["stg_google_ads_performance"], "performance_date")
    old, new = g[datetime.date(2026, 3, 2)], g[datetime.date(2026, 3, 9)]
    assert (old["all_conversions"], float(old["conversions"]), float(old["cost_zar"])) == (None, 2.0, 2.5)
    assert (float(new["all_conversions"]), float(new["conversions"]), float(new["conversions_value_zar"])) == (9.0, 3.0, 1200.0)
    campaign = by(build.tables["dim_campaign"], "campaign_id")["G1"]
    assert campaign["current_campaign_name"] == "Brand new" and campaign["campaign_name_history"] == ["Brand", "Brand new"]


def test_insights_restated_converted_and_quarantined(build):
    m = {(r.ad_id, str(r.insight_date)): r for r in build.tables["stg_meta_ads"].collect()}
    assert float(m["m1", "2026-03-02"].purchases) == 3 and float(m["m1", "2026-03-02"].spend_zar) == pytest.approx(10.5 * 18.5)
    weekend = m["m2", "2026-03-07"]
    assert float(weekend.usd_zar_rate) == 19.0 and float(weekend.purchase_value_usd) == 0
    # The cut line and the empty one.
    assert build.tables["quarantine_meta_ads"].count() == 2


def test_weather_and_copy(build):
    w = {(r.city_standard, str(r.weather_date)): r for r in build.tables["stg_weather"].collect()}
    assert w["Durban", "2026-03-03"].precipitation_mm == 4.5  # restated; the first array was one short
    assert w["Durban", "2026-03-02"].precipitation_mm == 0.0 and len(w) == 4
    f = by(build.tables["int_creative_features"], "ad_id")
    assert (f["a1"]["tone"], f["a1"]["discount_pct"], f["a1"]["cta"], f["a1"]["product"]) == ("urgent", 30, "shop_now", "Karoo fleece")
    assert (f["m1"]["tone"], f["m1"]["cta"], f["m1"]["product"]) == ("aspirational", "get_offer", None)


def test_events(build):
    e = build.tables["stg_ga4_events"].collect()
    bought = [r for r in e if r.transaction_id == "o1"]
    assert [str(r.event_timestamp_utc) for r in bought] == ["2026-03-02 10:00:01"]  # the late original
    assert all(r.session_gclid == "g-1" for r in e if (r.user_pseudo_id, r.ga_session_id) == ("v1", 1))
    assert all(r.session_term == "boots" for r in e if r.user_pseudo_id == "v2" and r.ga_session_id == 2)
    assert next(r for r in e if r.user_pseudo_id == "v3").report_date_local == datetime.date(2026, 3, 3)
    assert next(r for r in e if r.transaction_id == "o2").ga4_reported_value == 28000.0
    assert len(e) == len({r.event_fingerprint for r in e}) == 10


def test_people_sessions_and_attribution(build):
    i = by(build.tables["int_customer_identity"], "customer_id")
    assert i["c1"]["customer_key"] == i["c2"]["customer_key"] and i["c2"]["identity_method"] == "phone_to_email_bridge"
    assert i["ghost"]["is_placeholder"] and i["ghost"]["identity_method"] == "late_arriving_placeholder"
    s = {(r.user_pseudo_id, r.ga_session_id): r for r in build.tables["int_sessions"].collect()}
    assert ("staff", 7) not in s
    assert (s["v1", 1].campaign_id, s["v1", 1].attributed_platform, s["v1", 1].attribution_method) == ("G1", "google", "click_id")
    assert (s["v2", 2].campaign_id, s["v2", 2].attributed_platform) == ("M1", "meta")
    assert s["v1", 9].customer_key == i["c1"]["customer_key"]  # the visitor's latest identity
    o = by(build.tables["int_orders_attributed"], "order_id")
    assert set(o) == {"o1", "o2", "o4", "o5", "o6", "o7"}
    assert o["o1"]["exact_transaction_match"] is True and o["o1"]["campaign_id"] == "G1"
    assert o["o5"]["exact_transaction_match"] is False and o["o5"]["ga_session_id"] == 9  # same person, 30 minutes before
    assert o["o4"]["attribution_method"] == "unattributed" and o["o4"]["session_key"] is None


def test_checks_pass_and_gold(spark, build):
    assert build.check(blocking=False) == ["DQ04 late customers resolved"]  # the customer that never came
    build.gold(trained_until="2026-03-05", scored_at="2026-03-13 00:00:00")
    t = build.tables
    f = {r.acquisition_campaign_id: r for r in t["mart_customer_features"].collect()}
    ann = f["G1"]
    assert (ann.orders_7d, float(ann.completed_revenue_7d), float(ann.future_value_90d)) == (1, 500.0, 900.0)
    assert t["ml_customer_pltv"].filter("predicted_future_value_90d < 0").count() == 0
    v = {(str(r.week_start_date), r.campaign_id): r for r in t["mart_campaign_value"].collect()}
    week = v["2026-03-02", "G1"]
    assert (float(week.spend_zar), float(week.real_revenue_zar), float(week.actual_roas), week.new_customers) == (2.5, 500.0, 200.0, 1)
    assert v["2026-03-02", "M1"].real_orders == 1 and float(v["2026-03-02", "M1"].actual_roas) == 0.0  # refunded
    drivers = t["mart_campaign_drivers"].collect()
    assert drivers and all(r.city_standard in ("Cape Town", "Durban") for r in drivers)
    story = [r.campaign_id for r in build.story().collect()]
    assert story[0] == "G1"
    failed = lambda df: {r.check_name for r in df.collect() if r.status == "FAIL"}
    assert failed(reports.star_report(t)) == set()
    assert failed(reports.customer_report(t)) == set()
    assert failed(reports.ads_report(t, "2026-03-05")) == set()
    assert failed(reports.event_report(t)) == set()
    assert failed(reports.conformed_report(t, {"ids": 6, "people": 4, "late": 1, "orders": 6, "copies": 2})) == {"Model JSON parsed", "Creative features valid"}
    cutoff = F.lit("2026-03-05").cast("date")
    assert failed(reports.feature_report(t["mart_customer_features"], t["dim_customer"], t["fct_orders"], cutoff)) == set()
    last = t["dim_date"].agg(F.max("calendar_date").alias("last_day"))
    model = value.train(t["mart_customer_features"])
    card = reports.score_report(t["ml_customer_pltv"], t["mart_customer_features"], last, t["ml_customer_pltv_evaluation"], model.training_info(spark), model.feature_info(spark))
    assert failed(card) <= {"Evaluation metrics valid", "All value segments populated", "Value segment ordering valid"}  # two scored people
    assert failed(reports.mart_report(t, t["ml_customer_pltv"], ("M1", "G1"))) == {"First campaign wins platform return"}
    assert failed(reports.reconciliation_report(t, monitoring.violations(t))) == set()


def test_monitoring(spark, build, tmp_path):
    first = by(build.monitor("2026-03-13 06:00:00").filter("run_date = '2026-03-13'"), "dq_code")
    counts = {k: v["detected_count"] for k, v in first.items()}
    assert counts == {
        "DQ01": 4, "DQ02": 1, "DQ03": 1, "DQ04": 2, "DQ05": 2, "DQ06": 1, "DQ07": 2, "DQ08": 1, "DQ09": 3, "DQ10": 1, "DQ11": 3, "DQ12": 1,
    }
    manifest = spark.createDataFrame(
        [("DQ01", "x", "2026-03-02", "4 rows"), ("DQ08", "1 sessions", "2026-03-02", ""), ("DQ12", "c2", "2026-03-02", ""), ("DQ12", "c9", "2026-03-02", ""),
         ("DQ02", "o1", "2026-03-04", ""), ("DQ02", "event_date=2026-03-02", "2026-03-04", "")],
        "issue_code string, record_key string, file_dt string, detail string",
    ).withColumn("file_dt", F.to_date("file_dt"))
    card = by(build.monitor("2026-03-14 06:00:00", manifest), "dq_code")
    assert {k: v["status"] for k, v in card.items()} == {"DQ01": "MATCHED", "DQ08": "MATCHED", "DQ02": "MATCHED", "DQ12": "MISMATCH"}
    again = build.load("ops_dq_results").filter("run_date = '2026-03-14'").collect()
    manifest.write.parquet(str(tmp_path / "truth"))
    truth = spark.read.parquet(str(tmp_path / "truth"))
    tables = build.tables["ops_dq_results"], build.tables["ops_dq_scorecard"]
    leaky = build.findings().join(truth.select(F.col("issue_code").alias("dq_code")), "dq_code", "left_semi")
    assert {r.check_name: r.status for r in reports.monitoring_report(*tables, leaky, truth).collect()}["Truth isolated to scorecard"] == "FAIL"
    report = {r.check_name: r.status for r in reports.monitoring_report(*tables, build.findings(), truth).collect()}
    assert report == {"All 12 DQ codes monitored": "PASS", "All detected counts non-negative": "PASS", "All planted DQ codes matched": "FAIL", "Truth isolated to scorecard": "PASS"}
    assert len(again) == 12 and all(r.affected_rows_this_run == 0 and r.previous_detected_count == r.detected_count for r in again)


def test_daily_loads_equal_full_refresh(spark, build, tmp_path):
    raw = build.raw
    path, ads = str(tmp_path / "events"), str(tmp_path / "ads")
    for day in ("2026-03-02", "2026-03-03", "2026-03-04", "2026-03-10", "2026-03-10"):
        until = F.col("dt") <= F.lit(day).cast("date")
        load_events(raw["ga4_events"].filter(until), path)
        load_meta_ads(raw["meta_ads_insights_raw"].filter(until), build.tables["stg_fx_rates"], ads)
    columns = staging.EVENT_COLUMNS
    shown = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert shown(spark.read.parquet(path)) == shown(build.tables["stg_ga4_events"])
    money = ["ad_id", "insight_date", "purchases", "spend_zar", "dt"]
    pick = lambda df: sorted(map(repr, df.select(*money).collect()))
    assert pick(spark.read.parquet(ads)) == pick(build.tables["stg_meta_ads"])


def test_late_files_and_late_rates_reach_the_ad_table(spark, build, tmp_path):
    raw, rates, ads = build.raw["meta_ads_insights_raw"], build.tables["stg_fx_rates"], str(tmp_path / "ads")
    days = sorted(r.dt for r in raw.select("dt").distinct().collect())
    early = F.col("dt") == F.lit(days[0])
    load_meta_ads(raw.filter(~early), rates.limit(0), ads)
    assert spark.read.parquet(ads).filter("spend_zar IS NOT NULL").count() == 0
    # the oldest files come last, and the rates with them
    load_meta_ads(raw, rates, ads)
    money = ["ad_id", "insight_date", "purchases", "spend_zar", "dt"]
    pick = lambda df: sorted(map(repr, df.select(*money).collect()))
    assert pick(spark.read.parquet(ads)) == pick(build.tables["stg_meta_ads"])


def test_an_incremental_build_from_nothing(spark, build, landing, tmp_path):
    other = Build(spark, str(landing), str(tmp_path / "tables"), ["staff.example"])
    other.silver(full_refresh=False, last_day="2026-03-12")
    for name in ("stg_ga4_events", "stg_meta_ads", "int_sessions", "int_orders_attributed"):
        columns = sorted(build.tables[name].columns)
        shown = lambda t: sorted(map(repr, t[name].select(*columns).collect()))  # noqa: E731, B023
        assert shown(other.tables) == shown(build.tables)
