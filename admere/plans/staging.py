"""Delivered tables to typed, deduplicated, pseudonymised ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.functions import nested
from admere.functions.clean import (
    MONEY,
    blank_to_null,
    category_key,
    email_domain,
    email_key,
    event_fingerprint,
    file_stem,
    path_id,
    phone_key,
    pseudonym,
    safe_cast,
    surrogate_key,
    url_parameter,
)
from admere.functions.values import DEFAULT_ZONE, compact_date, convert, local_date, micros_to_money, micros_to_timestamp
from admere.operators.lookup import left_lookup
from admere.operators.sessions import CARRIED, carry_session_values
from admere.operators.spread import date_spine, forward_fill, with_scalars
from admere.operators.versions import drop_exact_copies, latest_version, two_stage_dedupe
from admere.session import stable
from admere.sources.schemas import WEATHER_FILE_CITIES

LINEAGE = ("dt", "source_file_name")
PURCHASE_ACTION = "offsite_conversion.fb_pixel_purchase"


def crm_customers(raw: DataFrame, cities: DataFrame, domains: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Latest record per customer with a standard city and hashed e-mail and phone."""
    typed = raw.select(
        blank_to_null("customer_id").alias("customer_id"),
        email_key("email").alias("email_text"),
        phone_key("phone").alias("phone_text"),
        category_key("city").alias("city_raw_normalized"),
        safe_cast("created_at", "timestamp").alias("created_at_utc"),
        safe_cast("is_guest", "boolean").alias("is_guest"),
        safe_cast("marketing_opt_in", "boolean").alias("marketing_opt_in"),
        *LINEAGE,
    )
    latest = latest_version(typed, ["customer_id"], ["dt", "created_at_utc", "source_file_name"])
    placed = latest.join(cities, "city_raw_normalized", "left").withColumn("email_domain", email_domain("email_text"))
    internal = domains.select("email_domain", F.lit(True).alias("is_internal"))
    known = placed.join(internal, "email_domain", "left")
    return known.select(
        "customer_id",
        pseudonym("email_text").alias("email_hash"),
        pseudonym("phone_text").alias("phone_hash"),
        "city_standard",
        "created_at_utc",
        local_date("created_at_utc", zone).alias("created_date"),
        "is_guest",
        "marketing_opt_in",
        F.coalesce("is_internal", F.lit(False)).alias("is_internal_customer"),
        *LINEAGE,
    )


ORDER_FIELDS = (
    "order_id", "customer_id", "order_timestamp_utc", "currency", "subtotal", "discount", "revenue", "status", "item_count", "updated_at_utc",
)


def typed_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        blank_to_null("order_id").alias("order_id"),
        blank_to_null("customer_id").alias("customer_id"),
        safe_cast("order_ts", "timestamp").alias("order_timestamp_utc"),
        blank_to_null("currency").alias("currency"),
        safe_cast("subtotal", MONEY).alias("subtotal"),
        safe_cast("discount", MONEY).alias("discount"),
        safe_cast("revenue", MONEY).alias("revenue"),
        F.lower(blank_to_null("status")).alias("status"),
        safe_cast("item_count", "bigint").alias("item_count"),
        safe_cast("updated_at", "timestamp").alias("updated_at_utc"),
        *LINEAGE,
    )


def crm_orders(raw: DataFrame, customers: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Latest version per order; QA orders are flagged, not dropped."""
    distinct = drop_exact_copies(typed_orders(raw), ORDER_FIELDS, LINEAGE)
    latest = latest_version(distinct, ["order_id"], ["updated_at_utc", *LINEAGE])
    # Only flagged customers tell; written first, so that Spark joins a table of known size and leaves the orders where they are.
    flags = stable(customers.filter("is_internal_customer").select("customer_id", F.lit(True).alias("__internal")))
    test_order = F.coalesce("__internal", F.lit(False)) | (F.col("revenue") <= 1)
    flagged = left_lookup(latest, flags, ["customer_id"])
    return flagged.select(
        *ORDER_FIELDS[:3],
        local_date("order_timestamp_utc", zone).alias("order_date"),
        *ORDER_FIELDS[3:],
        test_order.alias("is_test_order"),
        *LINEAGE,
    )


def crm_order_items(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        *[blank_to_null(c).alias(c) for c in ("order_id", "sku", "product_name")],
        safe_cast("unit_price", MONEY).alias("unit_price"),
        safe_cast("quantity", "bigint").alias("quantity"),
        *LINEAGE,
    )
    return latest_version(typed, ["order_id", "sku"], LINEAGE)


def google_clicks(raw: DataFrame) -> DataFrame:
    names = {
        "click_view_gclid": "gclid",
        "campaign_id": "campaign_id",
        "ad_group_id": "ad_group_id",
        "ad_group_ad_ad_id": "ad_id",
        "click_view_area_of_interest_city": "area_of_interest_city",
    }
    typed = raw.select(
        safe_cast("segments_date", "date").alias("click_date"),
        *[blank_to_null(old).alias(new) for old, new in names.items()],
        *LINEAGE,
    )
    return latest_version(typed, ["gclid"], LINEAGE)


def by_header(raw: DataFrame, first_column: str, columns: list[str], line: str = "raw_line") -> DataFrame:
    """Fields of raw comma lines, found by the header of their own file.

    A column a file lacks is NULL. The header of a file is one row, so it joins on
    the file; a plain split is used, quotes have no meaning.
    """
    is_header = F.col(line).startswith(f"{first_column},")
    headers = raw.filter(is_header).select(*LINEAGE, F.split(line, ",").alias("__header"))
    # A header repeated inside its file gives the same positions.
    # Written first, so that Spark joins a table of known, small size and leaves the lines where they are.
    headers = stable(headers.groupBy(*LINEAGE).agg(F.max("__header").alias("__header")))
    data = raw.filter(~is_header & (F.trim(line) != "")).select(*LINEAGE, F.split(line, ",").alias("__fields"))
    joined = data.join(headers, list(LINEAGE))
    position = lambda c: F.nullif(F.array_position("__header", c), F.lit(0)).cast("int") - 1
    return joined.select(*[F.get("__fields", position(c)).alias(c) for c in columns], *LINEAGE)


def google_ads_performance(raw: DataFrame) -> DataFrame:
    """One row per ad and day, whatever the column order of the file."""
    texts = {
        "customer_id": "account_id",
        "campaign_id": "campaign_id",
        "campaign_name": "campaign_name",
        "ad_group_id": "ad_group_id",
        "ad_group_name": "ad_group_name",
        "ad_group_ad_ad_id": "ad_id",
    }
    counts = {"metrics_impressions": "impressions", "metrics_clicks": "clicks"}
    amounts = {
        "metrics_all_conversions": "all_conversions",
        "metrics_conversions": "conversions",
        "metrics_conversions_value": "conversions_value_zar",
    }
    fields = by_header(raw, "segments_date", ["segments_date", *texts, *counts, "metrics_cost_micros", *amounts])
    typed = fields.select(
        safe_cast("segments_date", "date").alias("performance_date"),
        *[blank_to_null(old).alias(new) for old, new in texts.items()],
        *[safe_cast(old, "bigint").alias(new) for old, new in counts.items()],
        *[safe_cast(old, MONEY).alias(new) for old, new in amounts.items()],
        *LINEAGE,
        micros_to_money(safe_cast("metrics_cost_micros", "decimal(20,0)")).alias("cost_zar"),
    )
    return latest_version(typed, ["performance_date", "ad_id"], LINEAGE)


def meta_ads(raw: DataFrame, rates: DataFrame) -> DataFrame:
    """Latest valid pull per ad and day, spend converted by the rate of the day."""
    good, _ = nested.split_json(raw)
    p = F.col("payload")
    texts = ("account_id", "account_currency", "campaign_id", "campaign_name", "adset_id", "adset_name", "ad_id", "ad_name", "attribution_setting")
    typed = good.select(
        *[F.nullif(nested.json_text(p, f"$.{c}"), F.lit("")).alias(c) for c in texts],
        nested.json_number(p, "$.date_start", "date").alias("insight_date"),
        nested.json_number(p, "$.date_stop", "date").alias("insight_date_stop"),
        nested.json_number(p, "$.impressions", "bigint").alias("impressions"),
        nested.json_number(p, "$.clicks", "bigint").alias("clicks"),
        nested.json_number(p, "$.spend", MONEY).alias("spend_usd"),
        nested.action_value(p, "actions", PURCHASE_ACTION).alias("purchases"),
        nested.action_value(p, "action_values", PURCHASE_ACTION).alias("purchase_value_usd"),
        nested.json_number(p, "$._pulled_at", "timestamp").alias("pulled_at_utc"),
        *LINEAGE,
    )
    latest = latest_version(typed, ["ad_id", "insight_date"], ["pulled_at_utc", *LINEAGE])
    daily = rates.select(F.col("rate_date").alias("insight_date"), F.col("rate").alias("usd_zar_rate"))
    priced = latest.join(daily, "insight_date", "left")
    return priced.select(
        *latest.columns,
        "usd_zar_rate",
        convert("spend_usd", "usd_zar_rate").alias("spend_zar"),
        convert("purchase_value_usd", "usd_zar_rate").alias("purchase_value_zar"),
    )


def quarantine_meta_ads(raw: DataFrame) -> DataFrame:
    """Lines that are no JSON, kept with their lineage and a reason."""
    _, bad = nested.split_json(raw)
    return bad.select(
        surrogate_key(F.col("dt").cast("string"), "source_file_name", "raw_line").alias("row_fingerprint"),
        "raw_line",
        F.lit("line is not valid JSON").alias("quarantine_reason"),
        *LINEAGE,
    )


def fx_rates(raw: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """One rate per day, the last published one carried forward.

    The calendar runs over the delivery days. ``first`` and ``last`` set it
    otherwise, so a run that ends on a day without rows still has a rate.
    """
    typed = raw.select(
        safe_cast("rate_date", "date").alias("rate_date"),
        blank_to_null("base_currency").alias("base_currency"),
        blank_to_null("quote_currency").alias("quote_currency"),
        safe_cast("rate", "decimal(18,6)").alias("rate"),
        F.col("dt").alias("rate_source_dt"),
        "source_file_name",
    )
    published = latest_version(typed, ["rate_date"], ["rate_source_dt", "source_file_name"])
    bounds = typed.agg(F.min("rate_source_dt").alias("lo"), F.max("rate_source_dt").alias("hi"))
    if first is not None:
        bounds = bounds.withColumn("lo", F.lit(first).cast("date"))
    if last is not None:
        bounds = bounds.withColumn("hi", F.lit(last).cast("date"))
    days = date_spine(bounds, "lo", "hi", "rate_date").join(published, "rate_date", "left")
    filled = forward_fill(days, "rate_date", ["base_currency", "quote_currency", "rate", "rate_source_dt", "source_file_name"])
    return filled.select(
        "rate_date", "base_currency", "quote_currency", "rate", "rate_source_dt", F.col("rate_date").alias("dt"), "source_file_name"
    )


def weather(raw: DataFrame) -> DataFrame:
    """One row per city and day from documents of parallel arrays."""
    stem = file_stem("source_file_name", "json")
    city = F.lit(None).cast("string")
    for file_name, name in WEATHER_FILE_CITIES.items():
        city = F.when(stem == file_name, name).otherwise(city)
    zipped = nested.zip_arrays(
        raw,
        {
            "day": "daily.time",
            "temperature_max_c": "daily.temperature_2m_max",
            "temperature_min_c": "daily.temperature_2m_min",
            "precipitation_mm": "daily.precipitation_sum",
        },
        [city.alias("city_standard"), "latitude", "longitude", "elevation", "timezone", *LINEAGE],
    )
    typed = zipped.select(
        "city_standard", safe_cast("day", "date").alias("weather_date"),
        "temperature_max_c", "temperature_min_c", "precipitation_mm", "latitude", "longitude", "elevation", "timezone", *LINEAGE,
    )
    return latest_version(typed, ["city_standard", "weather_date"], LINEAGE)


def creatives(raw: DataFrame) -> DataFrame:
    """One line of copy per ad; the ad is named by the folder of the file."""
    typed = raw.filter(F.trim("raw_line") != "").select(
        path_id("source_file_name").alias("ad_id"), F.col("raw_line").alias("copy_text"), *LINEAGE
    )
    # A file of several lines gives the greatest one, so reruns agree.
    return latest_version(typed, ["ad_id"], [*LINEAGE, "copy_text"])


EVENT_PARAMETERS = {
    "ga_session_id": "int_value",
    "ga_session_number": "int_value",
    "page_location": "string_value",
    "page_referrer": "string_value",
    "page_title": "string_value",
    "engagement_time_msec": "int_value",
    "currency": "string_value",
}

#: Event-level attribution column -> (field delivered with the event, URL parameter).
EVENT_TAGS = {
    "gclid": ("gclid", "gclid"),
    "dclid": ("dclid", "dclid"),
    "srsltid": ("srsltid", "srsltid"),
    "fbclid": (None, "fbclid"),
    "campaign_id": ("manual_campaign_id", "utm_id"),
    "campaign_name": ("manual_campaign_name", "utm_campaign"),
    "source": ("manual_source", "utm_source"),
    "medium": ("manual_medium", "utm_medium"),
    "term": ("manual_term", "utm_term"),
    "content": ("manual_content", "utm_content"),
}


def _parameter(key: str, slot: str):
    return nested.kv_lookup("event_params", key, slot)


def flat_events(raw: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Nested web events to one flat, typed row each, before any group work."""
    flat = raw.select(
        compact_date("event_date").alias("event_date"),
        micros_to_timestamp("event_timestamp").alias("event_timestamp_utc"),
        "event_name",
        "user_pseudo_id",
        F.col("device.category").alias("device_category"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("geo.country").alias("country"),
        F.col("geo.city").alias("city"),
        F.col("ecommerce.total_item_quantity").alias("total_item_quantity"),
        "items",
        *LINEAGE,
        F.coalesce("ecommerce.transaction_id", _parameter("transaction_id", "string_value")).alias("transaction_id"),
        nested.kv_number("event_params", "value").alias("ga4_reported_value"),
        F.coalesce(F.lower(_parameter("traffic_type", "string_value")) == "internal", F.lit(False)).alias("is_internal_traffic"),
        *[_parameter(key, slot).alias(key) for key, slot in EVENT_PARAMETERS.items()],
    )
    return flat.select(
        "*",
        event_fingerprint("user_pseudo_id", "event_timestamp_utc", "event_name", "ga_session_id").alias("event_fingerprint"),
        local_date("event_timestamp_utc", zone).alias("report_date_local"),
        (F.col("event_date") != F.col("dt")).alias("arrived_late"),
    )


def event_tags(raw: DataFrame) -> DataFrame:
    """Session key, click ids and campaign tags of each event: delivered fields first, then the page address."""
    places = raw.select(
        "user_pseudo_id",
        _parameter("ga_session_id", "int_value").alias("ga_session_id"),
        _parameter("page_location", "string_value").alias("page_location"),
        "collected_traffic_source",
    )
    tags = [
        url_parameter("page_location", parameter, f"collected_traffic_source.{field}" if field else None).alias(f"event_{name}")
        for name, (field, parameter) in EVENT_TAGS.items()
    ]
    # As a generator each pattern runs once per row; as a plain projection a filter
    # on the tags would be pushed below it and run them all again.
    return places.select("user_pseudo_id", "ga_session_id", F.inline(F.array(F.struct(*tags))))


TAG_COLUMNS = {f"event_{name}": f"session_{name}" for name in EVENT_TAGS}

EVENT_COLUMNS = (
    "event_fingerprint", "event_date", "event_timestamp_utc", "report_date_local", "event_name", "user_pseudo_id",
    "ga_session_id", "ga_session_number", "page_location", "page_referrer", "page_title", "engagement_time_msec",
    "device_category", "operating_system", "country", "city", *CARRIED, "transaction_id", "ga4_reported_value",
    "currency", "total_item_quantity", "items", "is_internal_traffic", "is_provisional", "arrived_late", "dt", "source_file_name",
)


def mark_provisional(events: DataFrame, days: int = 2, source: DataFrame | None = None) -> DataFrame:
    """Flag the last ``days`` event dates of ``source`` (default: the events).

    The newest date is one aggregate, used as a scalar, not a global window.
    """
    newest = (events if source is None else source).agg(F.max("event_date").alias("__newest"))
    flagged = with_scalars(events.drop("is_provisional"), newest)
    return flagged.withColumn("is_provisional", F.col("event_date") >= F.date_sub("__newest", days - 1)).drop("__newest")


def dedupe_events(events: DataFrame) -> DataFrame:
    """Drop re-sent events, then repeated purchases of one order."""
    return two_stage_dedupe(
        events,
        "event_fingerprint",
        LINEAGE,
        F.col("event_name") == "purchase",
        "transaction_id",
        [F.col("event_timestamp_utc").asc(), F.col("dt").desc(), F.col("source_file_name").desc(), F.col("event_fingerprint").asc()],
    )


def settle_events(rows: DataFrame, tags: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Final events: deduplicated, then given the values and flags that look at all rows.

    Session values and the newest date include rows the dedupe drops. Joining them
    on afterwards lets the dropped rows skip the join.
    """
    carried = carry_session_values(dedupe_events(rows), columns, source=tags)
    return mark_provisional(carried, source=rows).select(*EVENT_COLUMNS)


def ga4_events(raw: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Clean web events with session-wide click ids and campaign tags."""
    return settle_events(flat_events(raw, zone), event_tags(raw), TAG_COLUMNS)
