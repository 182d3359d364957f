"""Named PASS/FAIL checks per layer: ``check_name, observed, expected, status``.

Every table is read once per report: its figures are one aggregate, the checks are
expressions over the one row of all figures. Counts of a known run can be passed as
``expected``; otherwise a populated table is enough.

Fixed values: the names of the checks are those that readers of the reports know.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admere.functions.creative import CALLS, TONES
from admere.functions.values import when_amount, within
from admere.operators.checks import FORBIDDEN_COLUMNS, checks, one_row, ratio_outliers
from admere.operators.spread import with_scalars
from admere.plans.monitoring import layer_metrics
from admere.plans.value import FEATURE_DAYS, LABEL, LABEL_DAYS
from admere.sources.schemas import CITIES


def rows() -> Column:
    return F.count(F.lit(1))


def excess(*key: str) -> Column:
    """Rows minus distinct keys."""
    return rows() - F.count_distinct(F.struct(*key) if len(key) > 1 else F.col(key[0]))


def no_lineage() -> Column:
    return F.count_if(F.col("dt").isNull() | F.col("source_file_name").isNull())


def figures(df: DataFrame, **metrics: Column) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in metrics.items()])


def forbidden(*tables: DataFrame) -> Column:
    """Columns of the tables whose names must not leave the raw layer."""
    return F.lit(sum(c in FORBIDDEN_COLUMNS for t in tables for c in t.columns))


def none(c: Column | str, expected: str = "0") -> tuple[Column, str, Column]:
    c = F.col(c) if isinstance(c, str) else c
    return c, expected, c == 0


def some(c: str, count: int | None = None) -> tuple[Column, str, Column]:
    """Any rows, or exactly ``count`` of them."""
    return (F.col(c), "> 0", F.col(c) > 0) if count is None else (F.col(c), f"{count:,}", F.col(c) == count)


def pair(a: str, b: str, tolerance: float = 0.0, expected: str = "equal", relative: float = 0.0) -> tuple[Column, str, Column]:
    """Two figures that agree; ``relative`` allows for the order in which doubles are added."""
    both = F.concat_ws("/", F.col(a).cast("string"), F.col(b).cast("string"))
    gap = F.abs(F.coalesce(a, F.lit(0)).cast("double") - F.coalesce(b, F.lit(0)).cast("double"))
    return both, expected, gap <= F.lit(tolerance) + F.lit(relative) * F.abs(F.coalesce(a, F.lit(0)).cast("double"))


def total(*names: str) -> Column:
    added = F.col(names[0])
    for n in names[1:]:
        added = added + F.col(n)
    return added


def customer_report(t: dict[str, DataFrame]) -> DataFrame:
    """Customers, orders, order lines, clicks and rates."""
    c = t["stg_crm_customers"]
    m = one_row(
        figures(
            c, customers=rows(), dup_customers=excess("customer_id"), nobody=F.count_if(F.col("email_hash").isNull() & F.col("phone_hash").isNull()),
            bad_city=F.count_if(F.col("city_standard").isNull() | ~F.col("city_standard").isin(*CITIES)), staff=F.count_if("is_internal_customer"), l1=no_lineage(),
        ),
        figures(t["stg_crm_orders"], orders=rows(), dup_orders=excess("order_id"), tests=F.count_if("is_test_order"), l2=no_lineage()),
        figures(t["stg_crm_order_items"], dup_items=excess("order_id", "sku"), l3=no_lineage()),
        figures(t["stg_google_clicks"], dup_clicks=excess("gclid"), l4=no_lineage()),
        figures(
            t["stg_fx_rates"], fx_days=rows(), fx_span=F.datediff(F.max("rate_date"), F.min("rate_date")) + 1, fx_gaps=F.count_if(F.col("rate").isNull()), l5=no_lineage()
        ),
    )
    return checks(m, {
        "Customers loaded": some("customers"),
        "Customer IDs unique": none("dup_customers"),
        "Every customer has an identity hash": none("nobody"),
        "Cities standardised": none("bad_city", "0 invalid"),
        "Internal customer detected": some("staff"),
        "No raw PII columns in silver": none(forbidden(c)),
        "Orders loaded": some("orders"),
        "Latest order version unique": none("dup_orders"),
        "QA orders detected": some("tests"),
        "Order item keys unique": none("dup_items"),
        "Google click IDs unique": none("dup_clicks"),
        "FX date spine complete": pair("fx_days", "fx_span", expected="rows = calendar days"),
        "No missing FX rates": none("fx_gaps"),
        "Source lineage retained": none(total("l1", "l2", "l3", "l4", "l5"), "0 missing"),
    })


def ads_report(t: dict[str, DataFrame], header_changed: str) -> DataFrame:
    """Ad performance, insights, copy and weather. ``header_changed`` is the first day of the wider header."""
    new = F.col("performance_date") >= F.lit(header_changed).cast("date")
    path = F.concat(F.lit("/ad_"), F.col("ad_id"), F.lit("/copy.txt"))
    unnamed = F.col("ad_id").isNull() | ~F.col("source_file_name").endswith(path)
    no_weather = ~F.col("city_standard").isin(*CITIES) | F.col("temperature_max_c").isNull() | F.col("temperature_min_c").isNull() | F.col("precipitation_mm").isNull()
    bad = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) < 0))
    m = one_row(
        figures(
            t["stg_google_ads_performance"], google=rows(), dup_google=excess("performance_date", "ad_id"), bad_cost=bad("cost_zar"),
            shifted=F.count_if(~new & F.col("all_conversions").isNotNull()), missing=F.count_if(new & F.col("all_conversions").isNull()), l1=no_lineage(),
        ),
        figures(t["stg_meta_ads"], meta=rows(), dup_meta=excess("ad_id", "insight_date"), bad_spend=bad("spend_zar"), l2=no_lineage()),
        figures(t["quarantine_meta_ads"], cut=rows(), l3=no_lineage()),
        figures(t["stg_creatives"], copies=rows(), dup_copies=excess("ad_id"), unnamed=F.count_if(unnamed), l4=no_lineage()),
        figures(t["stg_weather"], weather=rows(), dup_weather=excess("city_standard", "weather_date"), bad_weather=F.count_if(no_weather), l5=no_lineage()),
    )
    return checks(m, {
        "Google performance loaded": some("google"),
        "Google performance keys unique": none("dup_google"),
        "Google cost converted": none("bad_cost", "0 invalid"),
        "Old Google schema handled": none("shifted", "0 shifted rows"),
        "New Google schema handled": none("missing", "0 missing"),
        "Meta insights loaded": some("meta"),
        "Latest Meta pull unique": none("dup_meta"),
        "Meta spend converted": none("bad_spend", "0 invalid"),
        "Broken Meta lines quarantined": some("cut"),
        "Creatives loaded": some("copies"),
        "Creative ad IDs unique": none("dup_copies"),
        "Creative IDs derived from lineage": none("unnamed", "0 invalid"),
        "Weather loaded": some("weather"),
        "Weather city-date keys unique": none("dup_weather"),
        "Weather arrays zipped": none("bad_weather", "0 invalid"),
        "Source lineage retained": none(total("l1", "l2", "l3", "l4", "l5"), "0 missing"),
    })


def event_report(t: dict[str, DataFrame]) -> DataFrame:
    """Web events: keys, dates, flags, session values and odd purchase values."""
    e = t["stg_ga4_events"]
    bought = F.col("event_name") == "purchase"
    sessions = e.groupBy("user_pseudo_id", "ga_session_id").agg(
        F.bool_or("is_internal_traffic").alias("staff"),
        F.coalesce(F.max("session_gclid"), F.max("session_fbclid")).isNotNull().alias("paid"),
        ((F.min("session_gclid") != F.max("session_gclid")) | (F.min("session_fbclid") != F.max("session_fbclid"))).alias("mixed"),
    )
    valued = e.filter(bought).join(t["stg_crm_orders"].select("order_id", "revenue"), F.col("transaction_id") == F.col("order_id"))
    newest = with_scalars(e, e.agg(F.max("event_date").alias("newest")))
    recent = F.col("event_date") >= F.date_sub("newest", 1)
    m = one_row(
        figures(
            newest, events=rows(), dup_events=excess("event_fingerprint"),
            dup_purchases=F.count_if(bought) - F.count_distinct(F.when(bought, F.col("transaction_id"))),
            off_dates=F.count_if(F.col("report_date_local") != F.col("event_date")), no_session=F.count_if(F.col("ga_session_id").isNull()),
            late=F.count_if("arrived_late"), bad_flags=F.count_if(F.col("is_provisional") != recent), lineage=no_lineage(),
        ),
        figures(sessions, staff=F.count_if("staff"), paid=F.count_if("paid"), mixed=F.count_if("mixed")),
        figures(ratio_outliers(valued, "ga4_reported_value", "revenue"), odd=rows()),
    )
    return checks(m, {
        "GA4 events loaded": some("events"),
        "Event fingerprints unique": none("dup_events"),
        "Purchase transaction IDs unique": none("dup_purchases"),
        "UTC to local report dates agree": none("off_dates"),
        "GA4 session IDs extracted": none("no_session", "0 missing"),
        "Late GA4 events detected": some("late"),
        "Internal sessions detected": some("staff"),
        "Paid click IDs extracted": some("paid"),
        "Click IDs carried consistently": none("mixed", "0 inconsistent"),
        "Latest two days provisional": none("bad_flags", "0 invalid"),
        "GA4 value anomalies detected": some("odd"),
        "No authoritative GA4 revenue column": none(F.lit(sum(c in ("revenue", "purchase_revenue") for c in e.columns))),
        "Source lineage retained": none("lineage", "0 missing"),
    })


METHODS = ("click_id", "utm", "unattributed")


def conformed_report(t: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """People, sessions, attributed orders and ad features."""
    want = (expected or {}).get
    i, s, o, c = (t[n] for n in ("int_customer_identity", "int_sessions", "int_orders_attributed", "int_creative_features"))
    odd_method = F.count_if(~F.col("attribution_method").isin(*METHODS))
    clicked = F.count_if(F.col("attribution_method") == "click_id")
    invalid = ~F.col("tone").isin(*TONES) | ~F.col("cta").isin(*CALLS) | ~F.col("discount_pct").between(0, 100) | F.col("product").isNull()
    m = one_row(
        figures(
            i, ids=rows(), people=F.count_distinct(F.when(~F.col("is_internal_customer"), F.col("customer_key"))), late=F.count_if("is_placeholder"),
            dup_ids=excess("customer_id"), no_key=F.count_if(F.col("customer_key").isNull()), l1=no_lineage(),
        ),
        figures(
            s, sessions=rows(), dup_sessions=excess("session_key"), staff=F.count_if("is_internal_session"), linked=F.count_if(F.col("customer_key").isNotNull()),
            clicked=clicked, bad_sessions=odd_method, l2=no_lineage(),
        ),
        figures(
            o, orders=rows(), dup_orders=excess("order_id"), tests=F.count_if("is_test_order"), no_person=F.count_if(F.col("customer_key").isNull()),
            clicked_orders=clicked, bad_orders=odd_method, l3=no_lineage(),
        ),
        figures(
            c, copies=rows(), dup_copies=excess("ad_id"), errors=F.count_if(F.col("model_status") != ""), fallbacks=F.count_if(F.col("extraction_method") != "model"),
            bad_copies=F.count_if(invalid), l4=no_lineage(),
        ),
    )
    return checks(m, {
        "All customer IDs mapped": some("ids", want("ids")),
        "Distinct people conformed": some("people", want("people")),
        "Late customer placeholders created": some("late", want("late")),
        "Customer IDs unique": none("dup_ids"),
        "Every customer has customer_key": none("no_key"),
        "Sessions loaded": some("sessions", want("sessions")),
        "Sessions unique": none("dup_sessions"),
        "Internal sessions excluded": none("staff"),
        "Sessions linked to identities": some("linked", want("linked")),
        "Click-attributed sessions present": some("clicked", want("clicked")),
        "Session attribution valid": none("bad_sessions"),
        "Genuine orders loaded": some("orders", want("orders")),
        "Attributed orders unique": none("dup_orders"),
        "QA orders excluded": none("tests"),
        "Orders linked to customer keys": none("no_person", "0 missing"),
        "Click-attributed orders present": some("clicked_orders", want("clicked_orders")),
        "Order attribution valid": none("bad_orders"),
        "Creative features loaded": some("copies", want("copies")),
        "Creative ad IDs unique": none("dup_copies"),
        "Model calls successful": none("errors", "0 errors"),
        "Model JSON parsed": none("fallbacks", "0 fallbacks"),
        "Creative features valid": none("bad_copies", "0 invalid"),
        "No raw PII in conformed models": none(forbidden(i, s, o)),
        "Source lineage retained": none(total("l1", "l2", "l3", "l4"), "0 missing"),
    })


def star_report(t: dict[str, DataFrame]) -> DataFrame:
    """Dimensions and facts, and their agreement with the layer below."""
    spend = F.col("spend_zar")
    m = one_row(
        figures(t["dim_date"], dates=rows(), dup_dates=excess("calendar_date")),
        figures(t["dim_customer"], customers=rows(), dup_customers=excess("customer_key"), internal=F.count_if("is_internal_customer"), l1=no_lineage()),
        figures(t["dim_campaign"], dup_campaigns=excess("platform", "campaign_id"), renamed=F.count_if(F.size("campaign_name_history") > 1), l2=no_lineage()),
        figures(t["dim_ad"], dup_ads=excess("platform", "ad_id"), l3=no_lineage()),
        figures(t["fct_sessions"], gold_sessions=rows(), dup_sessions=excess("session_key"), l4=no_lineage()),
        figures(t["int_sessions"], silver_sessions=rows()),
        figures(t["fct_orders"], tests=F.count_if("is_test_order"), dup_orders=excess("order_id"), l5=no_lineage()),
        figures(t["fct_ad_spend_daily"], dup_spend=excess("spend_date", "platform", "ad_id"), bad_spend=F.count_if(spend.isNull() | (spend < 0)), l6=no_lineage()),
        layer_metrics(t),
    )
    return checks(m, {
        "Date dimension populated": some("dates"),
        "Date keys unique": none("dup_dates"),
        "Customer dimension populated": some("customers"),
        "Customer keys unique": none("dup_customers"),
        "Internal customers excluded": none("internal"),
        "Campaign keys unique": none("dup_campaigns"),
        "Campaign rename history retained": some("renamed"),
        "Ad keys unique": none("dup_ads"),
        "Session totals reconcile": pair("gold_sessions", "silver_sessions"),
        "Session keys unique": none("dup_sessions"),
        "Order totals reconcile": pair("gold_orders", "silver_orders"),
        "Order keys unique": none("dup_orders"),
        "QA orders excluded": none("tests"),
        "Completed revenue reconciles": pair("gold_revenue", "silver_revenue"),
        "Ad spend grain unique": none("dup_spend"),
        "Ad spend valid": none("bad_spend"),
        "Source lineage retained": none(total("l1", "l2", "l3", "l4", "l5", "l6")),
    })


def feature_report(features: DataFrame, customers: DataFrame, orders: DataFrame, trained_until: Column) -> DataFrame:
    """Feature mart: grain, windows recomputed from the facts, cohort and columns."""
    bad = F.col("orders_7d") < 1
    for c in ("completed_orders_7d", "completed_revenue_7d", "sessions_7d", LABEL):
        bad = bad | (F.col(c) < 0)
    trainable = F.col("is_training_eligible")
    people = customers.filter(F.col("first_order_date").isNotNull()).select("customer_key", "first_order_date")
    dated = orders.select("customer_key", "order_date", "completed_revenue").join(people, "customer_key")
    early = within("order_date", "first_order_date", 0, FEATURE_DAYS)
    later = within("order_date", "first_order_date", FEATURE_DAYS + 1, FEATURE_DAYS + LABEL_DAYS)
    m = one_row(
        figures(
            features, features=rows(), dup=excess("customer_key"), training=F.count_if(trainable), scoring=F.count_if(~trainable), bad=F.count_if(bad),
            off_cutoff=F.count_if(trainable != (F.col("acquisition_date") <= trained_until)), revenue=F.sum("completed_revenue_7d"), label=F.sum(LABEL), lineage=no_lineage(),
        ),
        figures(customers, acquired=F.count("first_order_date")),
        figures(dated, want_revenue=F.sum(when_amount(early, "completed_revenue")), want_label=F.sum(when_amount(later, "completed_revenue"))),
    )
    return checks(m, {
        "Feature rows match acquired customers": pair("features", "acquired"),
        "Customer feature keys unique": none("dup"),
        "Feature metrics valid": none("bad", "0 invalid"),
        "Feature revenue window reconciles": pair("revenue", "want_revenue"),
        "90-day label window reconciles": pair("label", "want_label"),
        "Training cohort present": some("training"),
        "Scoring-only cohort present": some("scoring"),
        "Training cutoff enforced": none("off_cutoff", "0 invalid"),
        "No raw PII columns": none(forbidden(features)),
        "Source lineage retained": none("lineage", "0 missing"),
    })


def score_report(scores: DataFrame, features: DataFrame, last_day: DataFrame, evaluation: DataFrame, info: DataFrame, inputs: DataFrame) -> DataFrame:
    """Model, evaluation and scores."""
    p, segment = F.col("predicted_future_value_90d"), F.col("value_segment")
    of = lambda name: F.when(segment == name, p)
    ripe = with_scalars(features, last_day.select("last_day")).filter(F.col("acquisition_date") <= F.date_sub("last_day", FEATURE_DAYS))
    bad = F.col("r2_score").isNull() | F.col("mean_absolute_error").isNull() | (F.col("mean_absolute_error") < 0) | (F.col("mean_squared_error") < 0)
    m = one_row(
        figures(
            scores, scored=rows(), dup=excess("customer_key"), negative=F.count_if(p < 0), segments=F.count_distinct(segment), lineage=no_lineage(),
            min_high=F.min(of("high")), max_steady=F.max(of("steady")), min_steady=F.min(of("steady")), max_low=F.max(of("low")),
        ),
        figures(ripe, eligible=rows()),
        figures(evaluation, evaluations=rows(), bad_evaluations=F.count_if(bad)),
        figures(info, trees=rows(), evaluated=F.count("eval_loss")),
        figures(inputs, leaks=F.count_if(F.col("input") == LABEL)),
    )
    ordered = (F.col("min_high") >= F.col("max_steady")) & (F.col("min_steady") >= F.col("max_low"))
    return checks(m, {
        "Model training info available": some("trees"),
        "Model training evaluated holdout loss": some("evaluated"),
        "Evaluation metrics persisted": some("evaluations", 1),
        "Evaluation metrics valid": none("bad_evaluations", "0 invalid"),
        "Eligible customers scored": pair("scored", "eligible"),
        "Prediction keys unique": none("dup"),
        "Predicted values non-negative": none("negative"),
        "All value segments populated": some("segments", 3),
        "Value segment ordering valid": (F.concat_ws(" ", "min_high", "max_steady", "min_steady", "max_low"), "high >= steady >= low", ordered),
        "Target excluded from model features": none("leaks"),
        "No raw PII in predictions": none(forbidden(scores)),
        "Prediction lineage retained": none("lineage", "0 missing"),
    })


def mart_report(t: dict[str, DataFrame], scores: DataFrame, story: tuple[str, str] | None = None) -> DataFrame:
    """Final marts. ``story`` names two campaigns: the first must win on claims, the second on value."""
    grain = ("week_start_date", "platform", "campaign_id")
    v, w, d = t["mart_customer_value"], t["mart_campaign_value"], t["mart_campaign_drivers"]
    double = lambda c: F.col(c).cast("double")
    promised = double("first_order_revenue_zar") + F.col("predicted_value_90d")
    off = F.abs(F.col("value_adjusted_roas") - F.try_divide(promised, double("spend_zar"))) > 1e-6
    negative = lambda *cs: F.least(*[double(c) for c in cs]) < 0
    bad_week = ~F.col("one_time_buyer_share").between(0, 1) | negative("spend_zar", "claimed_revenue_zar", "real_revenue_zar", "predicted_value_90d")
    bad_driver = ~F.col("city_standard").isin(*CITIES) | (F.col("avg_temperature_max_c") < F.col("avg_temperature_min_c"))
    bad_driver = bad_driver | negative("attributed_sessions", "real_orders", "real_revenue_zar", "allocated_spend_zar", "total_precipitation_mm")
    by_paid = lambda platform, campaign: F.col(platform).isin("google", "meta") & F.col(campaign).isNotNull()
    metrics = [
        figures(
            v, values=rows(), dup_values=excess("customer_key"), negative=F.count_if(F.col("predicted_value_90d") < 0), l1=no_lineage(),
            no_creative=F.count_if(F.col("acquisition_ad_id").isNotNull() & F.col("acquisition_creative_tone").isNull()),
            customer_value=F.sum(F.when(by_paid("acquisition_platform", "acquisition_campaign_id"), F.col("predicted_value_90d"))),
        ),
        figures(scores, scored=rows()),
        figures(
            w, weeks=rows(), dup_weeks=excess(*grain), bad_weeks=F.count_if(bad_week), bad_roas=F.count_if((F.col("spend_zar") > 0) & off), l2=no_lineage(),
            mart_spend=F.sum("spend_zar"), mart_claimed=F.sum("claimed_revenue_zar"), mart_revenue=F.sum("real_revenue_zar"), campaign_value=F.sum("predicted_value_90d"),
        ),
        figures(
            d, drivers=rows(), dup_drivers=excess(*grain, "city_standard"), bad_drivers=F.count_if(bad_driver), l3=no_lineage(),
            no_copy=F.count_if((F.col("allocated_spend_zar") > 0) & (F.col("dominant_tone").isNull() | F.col("dominant_cta").isNull())),
        ),
        figures(t["fct_ad_spend_daily"], fact_spend=F.sum("spend_zar"), fact_claimed=F.sum("claimed_revenue_zar")),
        figures(t["fct_orders"], fact_revenue=F.sum(F.when(by_paid("attributed_platform", "campaign_id"), F.col("completed_revenue")))),
    ]
    rules = {
        "Customer value mart populated": some("values"),
        "Customer value matches scored customers": pair("values", "scored"),
        "Customer value keys unique": none("dup_values"),
        "Customer predictions valid": none("negative", "0 invalid"),
        "Acquisition creative features retained": none("no_creative", "0 missing"),
        "Campaign value mart populated": some("weeks"),
        "Campaign value grain unique": none("dup_weeks"),
        "Campaign value metrics valid": none("bad_weeks", "0 invalid"),
        "Value-adjusted return formula valid": none("bad_roas", "0 invalid"),
        "Campaign spend reconciles": pair("mart_spend", "fact_spend"),
        "Campaign claimed revenue reconciles": pair("mart_claimed", "fact_claimed"),
        "Attributed CRM revenue reconciles": pair("mart_revenue", "fact_revenue"),
        "Predicted campaign value reconciles": pair("campaign_value", "customer_value", 1e-6, relative=1e-9),
        "Campaign drivers populated": some("drivers"),
        "Campaign driver grain unique": none("dup_drivers"),
        "Campaign driver metrics valid": none("bad_drivers", "0 invalid"),
        "Campaign creative drivers retained": none("no_copy", "0 missing"),
        "Mart lineage retained": none(total("l1", "l2", "l3"), "0 missing"),
        "No raw PII in final marts": none(forbidden(v, w, d)),
    }
    if story:
        sums = lambda campaign, c: F.sum(F.when(F.col("campaign_id") == campaign, double(c)))
        claimed = lambda campaign: F.try_divide(sums(campaign, "claimed_revenue_zar"), sums(campaign, "spend_zar"))
        valued = lambda campaign: F.try_divide(sums(campaign, "first_order_revenue_zar") + sums(campaign, "predicted_value_90d"), sums(campaign, "spend_zar"))
        first, second = story
        metrics.append(figures(w, claim_1=claimed(first), claim_2=claimed(second), value_1=valued(first), value_2=valued(second)))
        rules |= {
            "First campaign wins platform return": (F.concat_ws("/", "claim_1", "claim_2"), "first > second", F.col("claim_1") > F.col("claim_2")),
            "Second campaign wins value-adjusted return": (F.concat_ws("/", "value_2", "value_1"), "second > first", F.col("value_2") > F.col("value_1")),
        }
    return checks(one_row(*metrics), rules)


def reconciliation_report(t: dict[str, DataFrame], rules: dict[str, DataFrame]) -> DataFrame:
    """Every issue code has a blocking rule, and the layers agree."""
    codes = {name.split(" ")[0] for name in rules if name.startswith("DQ")}
    m = layer_metrics(t).withColumn("codes", F.lit(len(codes)))
    return checks(m, {
        "All DQ codes have blocking assertions": some("codes", 12),
        "Gold order count reconciles": pair("silver_orders", "gold_orders"),
        "Gold revenue reconciles": pair("silver_revenue", "gold_revenue", 0.01),
        "Gold spend reconciles": pair("silver_spend", "gold_spend", 0.01),
    })


def monitoring_report(snapshots: DataFrame, card: DataFrame, findings: DataFrame, truth: DataFrame) -> DataFrame:
    """Latest snapshot complete, counts sane, every code matched, truth read by the scorecard only.

    ``findings`` is the detectors' frame before it is written, ``truth`` the manifest:
    no file of the manifest may be an input of the detectors.
    """
    newest = with_scalars(snapshots, snapshots.agg(F.max("recorded_at").alias("newest")))
    leaked = len(set(findings.inputFiles()) & set(truth.inputFiles()))
    m = one_row(
        figures(
            newest, codes=F.count_if(F.col("recorded_at") == F.col("newest")), bad=F.count_if((F.col("detected_count") < 0) | (F.col("affected_rows_this_run") < 0)),
        ),
        figures(card, planted=rows(), unmatched=F.count_if(F.col("status") != "MATCHED")),
    ).withColumn("leaked", F.lit(leaked))
    return checks(m, {
        "All 12 DQ codes monitored": some("codes", 12),
        "All detected counts non-negative": none("bad", "0 invalid"),
        "All planted DQ codes matched": (F.col("unmatched"), "0 mismatches", (F.col("planted") == 12) & (F.col("unmatched") == 0)),
        "Truth isolated to scorecard": none("leaked", "0 truth files read"),
    })
