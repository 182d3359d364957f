"""Session roll-up, session identity and campaign resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admere.functions.clean import surrogate_key
from admere.operators.lookup import left_lookup
from admere.operators.spread import with_group_values
from admere.operators.versions import earliest_by, latest_by

SESSION = ("user_pseudo_id", "ga_session_id")

#: Session-wide attribute -> name it has on the session row.
CARRIED = {
    "session_gclid": "gclid",
    "session_dclid": "dclid",
    "session_srsltid": "srsltid",
    "session_fbclid": "fbclid",
    "session_campaign_id": "utm_campaign_id",
    "session_campaign_name": "utm_campaign_name",
    "session_source": "utm_source",
    "session_medium": "utm_medium",
    "session_term": "utm_term",
    "session_content": "utm_content",
}


def carry_session_values(
    events: DataFrame, columns: dict[str, str], keys: tuple[str, ...] = SESSION, source: DataFrame | None = None
) -> DataFrame:
    """Give every event the greatest value its session holds, per column pair ``event -> session``.

    ``source`` holds the rows to look in (default: the events). Only its rows with
    any value are aggregated, in practice the landing pages.
    """
    source = events if source is None else source
    telling = source.filter(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull())
    return with_group_values(events, keys, {new: F.max(old) for old, new in columns.items()}, telling)


def roll_up(events: DataFrame, keys: tuple[str, ...] = SESSION) -> DataFrame:
    """One row per session from its cleaned events."""
    at = "event_timestamp_utc"
    first = {"city": "city", "device_category": "device_category", "operating_system": "operating_system", "transaction_id": "transaction_id"}
    return events.groupBy(*keys).agg(
        F.min(at).alias("session_start_utc"),
        F.max(at).alias("session_end_utc"),
        F.min("event_date").alias("session_date"),
        *[earliest_by(c, at, c, ignore_nulls=True).alias(name) for c, name in first.items()],
        *[F.max(c).alias(name) for c, name in CARRIED.items()],
        F.bool_or("is_internal_traffic").alias("is_internal_session"),
        F.bool_or("is_provisional").alias("is_provisional"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.coalesce("engagement_time_msec", F.lit(0))).alias("engagement_time_msec"),
        F.max("dt").alias("dt"),
        latest_by("source_file_name", "dt", at, "source_file_name").alias("source_file_name"),
    )


def attribution_method(click_ids: list[str], tags: list[str]) -> Column:
    """``click_id`` if any click id is present, else ``utm`` if any tag is, else ``unattributed``."""
    return (
        F.when(F.coalesce(*click_ids).isNotNull(), "click_id")
        .when(F.coalesce(*tags).isNotNull(), "utm")
        .otherwise("unattributed")
    )


def attributed_platform(google: list[str], meta: list[str], source: str) -> Column:
    """Platform whose own id is present; otherwise the lower-cased source tag."""
    return (
        F.when(F.coalesce(*google).isNotNull(), "google")
        .when(F.coalesce(*meta).isNotNull(), "meta")
        .otherwise(F.lower(source))
    )


def session_orders(events: DataFrame, keys: tuple[str, ...] = SESSION) -> DataFrame:
    """Sessions that name an order, with the first one named; reads only events that name one."""
    named = events.filter(F.col("transaction_id").isNotNull())
    return named.groupBy(*keys).agg(earliest_by("transaction_id", "event_timestamp_utc", "transaction_id").alias("transaction_id"))


def session_people(sessions: DataFrame, named: DataFrame, order_customers: DataFrame, keys: tuple[str, ...] = SESSION) -> DataFrame:
    """Add the customer behind each session.

    Direct: the session names an order. Otherwise the visitor's identity from the
    latest session that did. ``named`` lists the sessions that name an order,
    ``order_customers`` is unique per ``order_id``.
    """
    visitor, session = keys
    person = F.struct("customer_id", "customer_key")
    direct = left_lookup(sessions, order_customers.select("order_id", person.alias("__direct")), {"transaction_id": "order_id"})
    known = (
        named.join(order_customers, F.col("transaction_id") == F.col("order_id"))
        .groupBy(F.col(visitor).alias("__visitor"))
        .agg(latest_by(person, session).alias("__known"))
    )
    joined = direct.join(known, F.col(visitor) == F.col("__visitor"), "left")
    who = F.coalesce("__direct", "__known")
    return joined.select(
        *sessions.columns, who["customer_id"].alias("customer_id"), who["customer_key"].alias("customer_key")
    )


def session_campaigns(sessions: DataFrame, clicks: DataFrame, ads: DataFrame) -> DataFrame:
    """Add campaign, ad, method and platform: click table, then current ad, then tags.

    A campaign name tag is not mapped to an id, so a session with nothing but
    names keeps a NULL campaign.
    """
    click = clicks.select("gclid", F.struct("gclid", "campaign_id", "ad_id").alias("__click"))
    ad = ads.select("ad_id", F.struct("campaign_id", "ad_id").alias("__ad"))
    joined = left_lookup(left_lookup(sessions, click, ["gclid"]), ad, {"utm_content": "ad_id"})
    named = (
        joined.withColumn("__click_id", F.col("__click.gclid"))
        .withColumn("__ad_id", F.col("__ad.ad_id"))
        .withColumn("campaign_id", F.coalesce("__click.campaign_id", "__ad.campaign_id", "utm_campaign_id"))
        .withColumn("ad_id", F.coalesce("__click.ad_id", "__ad.ad_id", "utm_content"))
    )
    return (
        named.withColumn(
            "attribution_method",
            attribution_method(
                ["gclid", "dclid", "fbclid", "srsltid"], ["utm_source", "utm_medium", "utm_campaign_name", "utm_content"]
            ),
        )
        .withColumn("attributed_platform", attributed_platform(["gclid", "dclid", "__click_id"], ["fbclid", "__ad_id"], "utm_source"))
        .drop("__click", "__ad", "__click_id", "__ad_id")
    )


def session_key(keys: tuple[str, ...] = SESSION) -> Column:
    return surrogate_key(*keys)
