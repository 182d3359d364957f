"""Twelve issue detectors on delivered data, and the rules clean tables must keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admere.functions import nested
from admere.functions.clean import blank_to_null, email_domain, email_key, safe_cast
from admere.operators.checks import one_row, ratio_outliers, unique_violations
from admere.operators.spread import date_spine, with_group_values, with_scalars
from admere.operators.versions import duplicate_excess, latest_version
from admere.plans.staging import typed_orders
from admere.session import stable
from admere.sources.schemas import CITIES, DELIVERED_TEXT

# Code -> (source, what is counted).
UNITS = {
    "DQ01": ("crm_orders", "duplicated rows"),
    "DQ02": ("ga4_events", "purchase orders"),
    "DQ03": ("crm_orders", "orders"),
    "DQ04": ("crm_customers", "customers"),
    "DQ05": ("meta_ads_insights_raw", "truncated lines"),
    "DQ06": ("ga4_events", "orders"),
    "DQ07": ("crm_and_ga4", "orders + QA account"),
    "DQ08": ("ga4_events", "sessions"),
    "DQ09": ("crm_customers", "customers"),
    "DQ10": ("google_ads_performance_raw", "campaigns"),
    "DQ11": ("fx_rates", "days"),
    "DQ12": ("crm_customers", "customers"),
}


def monitored_events(raw: DataFrame) -> DataFrame:
    """The few event fields the detectors need."""
    look = lambda key, slot: nested.kv_lookup("event_params", key, slot)
    return raw.select(
        F.try_to_timestamp("event_date", F.lit("yyyyMMdd")).cast("date").alias("event_date"),
        "event_timestamp", "event_name", "user_pseudo_id", "dt",
        look("ga_session_id", "int_value").alias("ga_session_id"),
        F.coalesce("ecommerce.transaction_id", look("transaction_id", "string_value")).alias("transaction_id"),
        F.coalesce("ecommerce.purchase_revenue", nested.kv_number("event_params", "value")).alias("ga4_reported_value"),
        (F.lower(look("traffic_type", "string_value")) == "internal").alias("is_internal"),
    )


def _findings(row: DataFrame, found: dict[str, tuple[str, str]]) -> DataFrame:
    """Detector rows from a one-row relation: code -> (count column, newest-delivery column)."""
    entries = [
        F.struct(
            F.lit(code).alias("dq_code"), F.lit(UNITS[code][0]).alias("source_name"), F.lit(UNITS[code][1]).alias("detection_unit"),
            F.coalesce(F.col(count).cast("bigint"), F.lit(0).cast("bigint")).alias("detected_count"), F.col(newest).alias("source_max_dt"),
        )
        for code, (count, newest) in found.items()
    ]
    return row.select(F.inline(F.array(*entries)))


def order_findings(raw: DataFrame) -> DataFrame:
    """DQ01 rows exported twice; DQ03 orders with more than one version."""
    excess = duplicate_excess(raw, ["dt", "source_file_name"], DELIVERED_TEXT["crm_orders"])
    versions = (
        typed_orders(raw).filter(F.col("order_id").isNotNull())
        .groupBy("order_id").agg(F.min("updated_at_utc").alias("lo"), F.max("updated_at_utc").alias("hi"), F.max("dt").alias("dt"))
        .filter(F.col("lo") != F.col("hi"))
    )
    row = one_row(
        excess.agg(F.sum("duplicate_rows").alias("copies"), F.max("dt").alias("copies_dt")),
        versions.agg(F.count(F.lit(1)).alias("changed"), F.max("dt").alias("changed_dt")),
    )
    return _findings(row, {"DQ01": ("copies", "copies_dt"), "DQ03": ("changed", "changed_dt")})


def event_findings(events: DataFrame, orders: DataFrame) -> DataFrame:
    """DQ02 late or re-sent purchases; DQ06 values out of proportion; DQ08 staff sessions."""
    same_event = ["user_pseudo_id", "event_timestamp", "event_name", "ga_session_id"]
    # Purchases and staff events are few; written first, so that the parameters of all events are searched once.
    few = stable(events.filter((F.col("event_name") == "purchase") | F.col("is_internal")))
    bought = few.filter(F.col("event_name") == "purchase")
    # Copies of an event agree in all key fields, so counting among purchases is enough.
    copies = bought.groupBy(*same_event, "transaction_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("event_date") != F.col("dt")).alias("late")
    )
    # Copies of one event may carry different orders, so they are added up per event.
    totals = with_group_values(copies, same_event, {"total": F.sum("n")})
    flagged = totals.filter(F.col("transaction_id").isNotNull() & (F.coalesce("late", F.lit(False)) | (F.col("total") > 1)))
    latest = latest_version(
        typed_orders(orders).filter(F.col("order_id").isNotNull()), ["order_id"], ["updated_at_utc", "dt", "source_file_name"]
    ).select("order_id", "revenue")
    matched = bought.join(latest, F.col("transaction_id") == F.col("order_id"))
    session = F.struct("user_pseudo_id", "ga_session_id")
    row = one_row(
        events.agg(F.max("dt").alias("newest")),
        few.agg(F.count_distinct(F.when(F.col("is_internal"), session)).alias("staff")),
        flagged.agg(F.count_distinct("transaction_id").alias("resent")),
        ratio_outliers(matched, "ga4_reported_value", "revenue").agg(F.count_distinct("transaction_id").alias("odd"), F.max("dt").alias("odd_dt")),
    )
    return _findings(row, {"DQ02": ("resent", "newest"), "DQ06": ("odd", "odd_dt"), "DQ08": ("staff", "newest")})


def customer_findings(customers: DataFrame, orders: DataFrame, domains: DataFrame) -> DataFrame:
    """DQ04 customers delivered after their order; DQ07 QA keys; DQ09 city spellings; DQ12 blank e-mails."""
    c = customers.select(blank_to_null("customer_id").alias("customer_id"), email_key("email").alias("email_text"), F.col("city"), "dt")
    per_customer = c.groupBy("customer_id").agg(
        F.min("dt").alias("first_customer_dt"), F.max("dt").alias("dt"),
        F.bool_or(~F.col("city").isin(*CITIES)).alias("odd_city"), F.bool_or(F.col("email_text").isNull()).alias("no_email"),
    )
    o = orders.select(blank_to_null("order_id").alias("order_id"), blank_to_null("customer_id").alias("customer_id"), safe_cast("revenue", "decimal(18,4)").alias("revenue"), "dt")
    ordered = o.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.min("dt").alias("first_order_dt"))
    late = ordered.join(per_customer.select("customer_id", "first_customer_dt"), "customer_id", "left").filter(
        F.col("first_customer_dt").isNull() | (F.col("first_customer_dt") > F.col("first_order_dt"))
    )
    internal = c.join(domains, email_domain("email_text") == F.col("email_domain"), "left_semi").select("customer_id").distinct()
    theirs = o.join(internal, "customer_id", "left_semi").select("order_id")
    cheap = o.filter(F.col("revenue") <= 1).select("order_id")
    keys = internal.select(F.col("customer_id").alias("record_key")).union(theirs).union(cheap).distinct()
    has_id = F.col("customer_id").isNotNull()
    row = one_row(
        late.agg(F.count(F.lit(1)).alias("late"), F.max("first_order_dt").alias("late_dt")),
        keys.agg(F.count(F.lit(1)).alias("qa")),
        o.agg(F.max("dt").alias("orders_dt")),
        per_customer.agg(F.count_if(has_id & F.col("odd_city")).alias("odd"), F.count_if(has_id & F.col("no_email")).alias("blank"), F.max("dt").alias("customers_dt")),
    )
    return _findings(row, {"DQ04": ("late", "late_dt"), "DQ07": ("qa", "orders_dt"), "DQ09": ("odd", "customers_dt"), "DQ12": ("blank", "customers_dt")})


def feed_findings(insights: DataFrame, google: DataFrame, google_raw: DataFrame, rates: DataFrame) -> DataFrame:
    """DQ05 unreadable lines; DQ10 renamed campaigns; DQ11 days without a published rate."""
    names = google.filter(F.col("campaign_id").isNotNull()).groupBy("campaign_id").agg(F.min("campaign_name").alias("lo"), F.max("campaign_name").alias("hi"))
    published = rates.filter(safe_cast("rate", "decimal(18,6)").isNotNull()).select(safe_cast("rate_date", "date").alias("rate_date")).distinct()
    calendar = date_spine(rates.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi")), "lo", "hi")
    gaps = calendar.join(published, F.col("calendar_date") == F.col("rate_date"), "left")
    row = one_row(
        insights.agg(F.count_if(~nested.valid_json("raw_line")).alias("cut"), F.max("dt").alias("cut_dt")),
        names.agg(F.count_if(F.col("lo") != F.col("hi")).alias("renamed")),
        google_raw.agg(F.max("dt").alias("google_dt")),
        gaps.agg(F.count_if(F.col("rate_date").isNull()).alias("gap"), F.max("calendar_date").alias("gap_dt")),
    )
    return _findings(row, {"DQ05": ("cut", "cut_dt"), "DQ10": ("renamed", "google_dt"), "DQ11": ("gap", "gap_dt")})


def detectors(landing: dict[str, DataFrame], google: DataFrame, domains: DataFrame) -> DataFrame:
    """All twelve findings, one row per code. Reads delivered data only, never the truth."""
    return (
        order_findings(landing["crm_orders"])
        .unionByName(event_findings(monitored_events(landing["ga4_events"]), landing["crm_orders"]))
        .unionByName(customer_findings(landing["crm_customers"], landing["crm_orders"], domains))
        .unionByName(feed_findings(landing["meta_ads_insights_raw"], google, landing["google_ads_performance_raw"], landing["fx_rates"]))
    )


def violations(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows that break a rule on the clean tables, by rule; every one must be empty."""
    orders, events = t["fct_orders"], t["stg_ga4_events"]
    purchases = events.filter((F.col("event_name") == "purchase") & F.col("transaction_id").isNotNull())
    last_order = orders.agg(F.date_sub(F.max("order_date"), 2).alias("__old"))
    late = orders.join(t["int_customer_identity"].filter("is_placeholder").select("customer_id"), "customer_id", "left_semi")
    internal = t["dim_customer"].filter("is_internal_customer").select("customer_key")
    phones = t["int_customer_identity"].filter(F.col("phone_hash").isNotNull())
    campaigns = t["dim_campaign"]
    return {
        "DQ01 orders deduplicated": unique_violations(t["stg_crm_orders"], ["order_id"]),
        "DQ02 events deduplicated": unique_violations(events, ["event_fingerprint"]),
        "DQ02 purchases deduplicated": unique_violations(purchases, ["transaction_id"]),
        "DQ03 refunds carry no revenue": orders.filter((F.col("status") == "refunded") & (F.col("completed_revenue") != 0)),
        "DQ04 late customers resolved": with_scalars(late, last_order).filter(F.col("order_date") < F.col("__old")),
        "DQ05 quarantine holds bad lines only": t["quarantine_meta_ads"].filter(nested.valid_json("raw_line")),
        "DQ06 CRM revenue is authoritative": revenue_gap(t["int_orders_attributed"], orders),
        "DQ07 test orders excluded": orders.filter("is_test_order").select("order_id").union(
            orders.join(internal, "customer_key", "left_semi").select("order_id")
        ),
        "DQ08 staff sessions excluded": t["fct_sessions"].filter("is_internal_session"),
        "DQ09 cities standardised": t["stg_crm_customers"].filter(
            F.col("city_standard").isNull() | ~F.col("city_standard").isin(*CITIES)
        ),
        "DQ10 campaign ids conformed": campaigns.groupBy("platform", "campaign_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("current_campaign_name").isNull()).alias("unnamed")
        ).filter((F.col("n") != 1) | (F.col("unnamed") > 0)),
        "DQ11 rates complete": t["stg_fx_rates"].filter(F.col("rate").isNull() | (F.col("rate") <= 0)),
        "DQ11 spend converted": t["stg_meta_ads"].filter(F.col("spend_zar").isNull()),
        "DQ12 customers have a person": t["int_customer_identity"].filter(F.col("customer_key").isNull()),
        "DQ12 a phone is one person": phones.groupBy("phone_hash").agg(
            F.min("customer_key").alias("lo"), F.max("customer_key").alias("hi")
        ).filter(F.col("lo") != F.col("hi")),
        "layers reconcile": layer_gap(t),
    }


def _completed(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.sum(F.when(F.col("status") == "completed", F.col("revenue")).otherwise(0)).alias(name))


def revenue_gap(attributed: DataFrame, facts: DataFrame, tolerance: float = 0.01) -> DataFrame:
    both = one_row(_completed(attributed, "silver_revenue"), facts.agg(F.sum("completed_revenue").alias("gold_revenue")))
    return both.filter(F.abs(F.col("silver_revenue") - F.col("gold_revenue")) > tolerance)


def layer_metrics(t: dict[str, DataFrame]) -> DataFrame:
    """Counts and sums of both layers in one row, one scan per table."""
    completed = F.sum(F.when(F.col("status") == "completed", F.col("revenue")).otherwise(0))
    return one_row(
        t["int_orders_attributed"].agg(F.count(F.lit(1)).alias("silver_orders"), completed.alias("silver_revenue")),
        t["fct_orders"].agg(F.count(F.lit(1)).alias("gold_orders"), F.sum("completed_revenue").alias("gold_revenue")),
        t["stg_google_ads_performance"].agg(F.sum("cost_zar").alias("__google")),
        t["stg_meta_ads"].agg(F.sum("spend_zar").alias("__meta")),
        t["fct_ad_spend_daily"].agg(F.sum("spend_zar").alias("gold_spend")),
    ).withColumn("silver_spend", F.col("__google") + F.col("__meta")).drop("__google", "__meta")


def layer_gap(t: dict[str, DataFrame], tolerance: float = 0.01) -> DataFrame:
    m = layer_metrics(t)
    apart = lambda a, b: F.abs(F.col(a) - F.col(b)) > tolerance
    return m.filter(
        (F.col("silver_orders") != F.col("gold_orders")) | apart("silver_revenue", "gold_revenue") | apart("silver_spend", "gold_spend")
    )


def uncovered_days(rows: DataFrame, key: str, day: str, settled: int = 7, delivered: str = "dt") -> DataFrame:
    """Days between the first and the last one of a key that have no row.

    Pulls send ``settled`` days again, so a day that old counts as lost, a newer one may still come. Only
    neighbouring days are compared, so the calendar is spelt out for gaps alone. Rows without key or day do not count.
    """
    dated = rows.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day).distinct()
    before = F.lag(day).over(Window.partitionBy(key).orderBy(day))
    gaps = dated.withColumn("__before", before).filter(F.datediff(day, "__before") > 1)
    lost = gaps.select(key, F.explode(F.sequence(F.date_add("__before", 1), F.date_sub(day, 1))).alias(day))
    newest = rows.agg(F.max(delivered).alias("__newest"))
    return with_scalars(lost, newest).filter(F.col(day) <= F.date_sub("__newest", settled)).drop("__newest")
