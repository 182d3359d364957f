"""Star schema: date, customer, campaign and ad dimensions; order, session and spend facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.functions.values import DEFAULT_ZONE, calendar_columns, date_key, local_date, when_amount
from admere.operators.spread import date_spine, one_bounds
from admere.operators.versions import distinct_history, latest_by

SPEND = "decimal(29,9)"


def dim_date(dated: list[tuple[DataFrame, str]]) -> DataFrame:
    """Every day between the first and last date of the given (table, column) pairs."""
    days = date_spine(one_bounds(dated), "first_day", "last_day")
    return days.select("calendar_date", *[c.alias(n) for n, c in calendar_columns("calendar_date").items()])


def dim_customer(identity: DataFrame, orders: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """One row per person outside the company, with order dates and count."""
    ordered = orders.groupBy("customer_key").agg(
        F.min("order_timestamp_utc").alias("first_order_timestamp_utc"),
        F.max("order_timestamp_utc").alias("latest_order_timestamp_utc"),
        F.count(F.lit(1)).alias("lifetime_order_count"),
    )
    person = identity.groupBy("customer_key").agg(
        latest_by("city_standard", "created_at_utc", "customer_id", ignore_nulls=True).alias("city_standard"),
        F.min("created_at_utc").alias("first_created_at_utc"),
        F.min("created_date").alias("first_created_date"),
        F.bool_or(F.coalesce("is_guest", F.lit(False))).alias("has_guest_identity"),
        F.bool_or(F.coalesce("marketing_opt_in", F.lit(False))).alias("marketing_opt_in"),
        F.bool_and("is_placeholder").alias("is_placeholder"),
        F.bool_or("is_internal_customer").alias("is_internal_customer"),
        F.max("dt").alias("dt"),
        latest_by("source_file_name", "dt", "source_file_name").alias("source_file_name"),
    )
    # Distinct pairs come first, so copies of a customer never meet in one task.
    ids = distinct_history(identity, ["customer_key"], "customer_id", "customer_ids").withColumnRenamed("customer_key", "__key")
    first = "first_order_timestamp_utc"
    return (
        person.filter(~F.col("is_internal_customer"))
        .join(ids, F.col("customer_key").eqNullSafe(F.col("__key")), "left")
        .join(ordered, "customer_key", "left")
        .select(
            "customer_key",
            F.coalesce("customer_ids", F.array().cast("array<string>")).alias("customer_ids"),
            F.coalesce(F.size("customer_ids"), F.lit(0)).cast("bigint").alias("identity_count"),
            *person.columns[1:],
            first,
            local_date(first, zone).alias("first_order_date"),
            "latest_order_timestamp_utc",
            F.coalesce("lifetime_order_count", F.lit(0).cast("bigint")).alias("lifetime_order_count"),
        )
    )


def _current(df: DataFrame, platform: str, key: str, date: str, version: str, columns: dict[str, str]) -> DataFrame:
    """Current value of each column per key, with first and last day seen."""
    return df.groupBy(key).agg(
        F.lit(platform).alias("platform"),
        *[latest_by(old, date, version).alias(new) for old, new in columns.items()],
        F.min(date).alias("first_seen_date"),
        F.max(date).alias("last_seen_date"),
        F.max("dt").alias("dt"),
        latest_by("source_file_name", date, version, "source_file_name").alias("source_file_name"),
    )


def dim_campaign(google: DataFrame, meta: DataFrame) -> DataFrame:
    """Current name and name history per campaign; an id survives a rename."""
    parts = []
    for df, platform, date, version in ((google, "google", "performance_date", "dt"), (meta, "meta", "insight_date", "pulled_at_utc")):
        current = _current(df, platform, "campaign_id", date, version, {"campaign_name": "current_campaign_name"})
        history = distinct_history(df.filter(F.col("campaign_name").isNotNull()), ["campaign_id"], "campaign_name", "campaign_name_history")
        parts.append(current.join(history, "campaign_id", "left"))
    return parts[0].unionByName(parts[1]).select(
        "platform", "campaign_id", "current_campaign_name",
        F.coalesce("campaign_name_history", F.array().cast("array<string>")).alias("campaign_name_history"),
        "first_seen_date", "last_seen_date", "dt", "source_file_name",
    )


def dim_ad(google: DataFrame, meta: DataFrame, features: DataFrame) -> DataFrame:
    """Current campaign and group of each ad with the features of its copy."""
    from_google = _current(
        google, "google", "ad_id", "performance_date", "dt",
        {"campaign_id": "campaign_id", "ad_group_id": "ad_group_id", "ad_group_name": "ad_group_name"},
    )
    from_meta = _current(
        meta, "meta", "ad_id", "insight_date", "pulled_at_utc",
        {"campaign_id": "campaign_id", "adset_id": "ad_group_id", "adset_name": "ad_group_name", "ad_name": "ad_name"},
    )
    ads = from_google.unionByName(from_meta, allowMissingColumns=True)
    copy = features.select(
        "ad_id", "copy_text", "tone", "discount_pct", "cta", "product", F.col("extraction_method").alias("creative_extraction_method")
    )
    return ads.join(copy, "ad_id", "left").select(
        "platform", "ad_id", "campaign_id", "ad_group_id", "ad_group_name", "ad_name", "first_seen_date", "last_seen_date",
        "dt", "source_file_name", "copy_text", "tone", "discount_pct", "cta", "product", "creative_extraction_method",
    )


def fct_orders(attributed: DataFrame) -> DataFrame:
    status = F.col("status")
    return attributed.select(
        date_key("order_date").alias("date_key"),
        "*",
        when_amount(status == "completed", "revenue").alias("completed_revenue"),
        when_amount(status == "refunded", "revenue").alias("refunded_order_value"),
    )


def fct_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(date_key("session_date").alias("date_key"), "*")


def fct_ad_spend_daily(google: DataFrame, meta: DataFrame) -> DataFrame:
    """Spend and platform claims of both platforms per ad and day."""
    left = google.select(
        F.col("performance_date").alias("spend_date"),
        F.lit("google").alias("platform"), "campaign_id", "ad_id", "impressions", "clicks",
        F.col("cost_zar").cast(SPEND).alias("spend_zar"),
        F.col("conversions").alias("claimed_conversions"),
        F.col("conversions_value_zar").cast(SPEND).alias("claimed_revenue_zar"),
        F.col("all_conversions").alias("platform_all_conversions"),
        "dt", "source_file_name",
    )
    right = meta.select(
        F.col("insight_date").alias("spend_date"),
        F.lit("meta").alias("platform"), "campaign_id", "ad_id", "impressions", "clicks",
        F.col("spend_zar").cast(SPEND).alias("spend_zar"),
        F.col("purchases").alias("claimed_conversions"),
        F.col("purchase_value_zar").cast(SPEND).alias("claimed_revenue_zar"),
        "dt", "source_file_name",
    )
    both = left.unionByName(right, allowMissingColumns=True)
    return both.select("spend_date", date_key("spend_date").alias("date_key"), *[c for c in both.columns if c != "spend_date"])
