"""People, sessions, attributed orders and ad features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.functions import creative
from admere.operators.identity import bridge_identity, late_placeholders, person_key
from admere.operators.matching import best_session
from admere.operators.sessions import roll_up, session_campaigns, session_key, session_orders, session_people
from admere.operators.versions import latest_by
from admere.session import stable

IDENTITY_COLUMNS = (
    "customer_id", "customer_key", "email_hash", "phone_hash", "identity_method", "city_standard", "created_at_utc",
    "created_date", "is_guest", "marketing_opt_in", "is_internal_customer", "is_placeholder", "dt", "source_file_name",
)


def customer_identity(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customer id to person key, with placeholders for customers not delivered yet."""
    known = bridge_identity(customers).withColumn("is_placeholder", F.lit(False))
    late = late_placeholders(
        orders.filter(~F.col("is_test_order")), customers, "customer_id", ("dt", "updated_at_utc", "source_file_name")
    ).select(
        "*",
        F.concat(F.lit("late_customer|"), "customer_id").alias("identity_hash"),
        F.lit("late_arriving_placeholder").alias("identity_method"),
        F.lit(False).alias("is_internal_customer"),
        F.lit(True).alias("is_placeholder"),
    )
    both = known.unionByName(late, allowMissingColumns=True)
    return both.withColumn("customer_key", person_key()).select(*IDENTITY_COLUMNS)


SESSION_COLUMNS = (
    "session_key", "user_pseudo_id", "ga_session_id", "session_start_utc", "session_end_utc", "session_date", "city",
    "device_category", "operating_system", "customer_id", "customer_key", "gclid", "dclid", "srsltid", "fbclid",
    "utm_source", "utm_medium", "utm_campaign_id", "utm_campaign_name", "utm_term", "utm_content", "campaign_id",
    "ad_id", "attribution_method", "attributed_platform", "transaction_id", "is_internal_session", "is_provisional",
    "event_count", "engagement_time_msec", "dt", "source_file_name",
)


def sessions(events: DataFrame, orders: DataFrame, identity: DataFrame, clicks: DataFrame, meta: DataFrame) -> DataFrame:
    """One row per outside web session with its person and campaign."""
    # Most orders are named by no event; those that are are written out, as two joins read them.
    ids = events.filter(F.col("transaction_id").isNotNull()).select(F.col("transaction_id").alias("order_id")).distinct()
    named = orders.select("order_id", "customer_id").join(ids, "order_id", "left_semi")
    order_people = stable(named.join(identity.select("customer_id", "customer_key"), "customer_id"))
    return place_sessions(roll_up(events), session_orders(events), order_people, clicks, current_ads(meta))


def current_ads(meta: DataFrame) -> DataFrame:
    """Campaign each ad belongs to now."""
    return meta.groupBy("ad_id").agg(latest_by("campaign_id", "insight_date", "pulled_at_utc").alias("campaign_id"))


def place_sessions(rolled: DataFrame, named: DataFrame, order_people: DataFrame, clicks: DataFrame, ads: DataFrame) -> DataFrame:
    """Person and campaign of rolled-up sessions; ``named`` lists all sessions of their visitors that name an order."""
    placed = session_campaigns(session_people(rolled, named, order_people), clicks, ads)
    return placed.withColumn("session_key", session_key()).filter(~F.col("is_internal_session")).select(*SESSION_COLUMNS)


ORDER_COLUMNS = (
    "order_id", "customer_id", "customer_key", "order_timestamp_utc", "order_date", "currency", "subtotal", "discount",
    "revenue", "status", "item_count", "updated_at_utc", "is_test_order", "session_key", "user_pseudo_id",
    "ga_session_id", "session_start_utc", "session_end_utc", "campaign_id", "ad_id", "attributed_platform",
    "attribution_method", "gclid", "fbclid", "utm_source", "utm_medium", "utm_campaign_name", "utm_content",
    "exact_transaction_match", "dt", "source_file_name", "session_source_file_name",
)
_FROM_SESSION = (
    "user_pseudo_id", "ga_session_id", "session_start_utc", "session_end_utc", "campaign_id", "ad_id",
    "attributed_platform", "attribution_method", "gclid", "fbclid", "utm_source", "utm_medium", "utm_campaign_name", "utm_content",
)

#: What attribution reads of a session.
ATTRIBUTED_FROM = ("session_key", "customer_key", "transaction_id", *_FROM_SESSION, "source_file_name")


def orders_attributed(orders: DataFrame, identity: DataFrame, sessions: DataFrame) -> DataFrame:
    """Genuine orders with their best session; orders without one are ``unattributed``.

    A session that names another order ranks like one that names none.
    """
    genuine = orders.filter(~F.col("is_test_order"))
    people = identity.select("customer_id", "customer_key")
    chosen = chosen_sessions(genuine.join(people, "customer_id"), sessions)
    # The long key joins last, so whole orders carry it through no other shuffle.
    return with_session(genuine, chosen).join(people, "customer_id").select(*ORDER_COLUMNS)


def attribute(genuine: DataFrame, sessions: DataFrame) -> DataFrame:
    """Orders that carry their ``customer_key``, with the best of these sessions."""
    return with_session(genuine, chosen_sessions(genuine, sessions)).select(*ORDER_COLUMNS)


def chosen_sessions(genuine: DataFrame, sessions: DataFrame) -> DataFrame:
    """What an order takes from its best session; orders without one are absent."""
    best = best_session(
        genuine, sessions, "order_id", "order_timestamp_utc", "session_key", "session_start_utc", "customer_key", "transaction_id"
    ).drop("distance_s")
    return best.join(
        sessions.select("session_key", *_FROM_SESSION, F.col("source_file_name").alias("session_source_file_name")), "session_key"
    )


def with_session(orders: DataFrame, chosen: DataFrame) -> DataFrame:
    joined = orders.join(chosen, "order_id", "left")
    return joined.withColumn("attribution_method", F.coalesce("attribution_method", F.lit("unattributed")))


def creative_features(creatives: DataFrame, answer: Callable | None = None) -> DataFrame:
    """Tone, discount, call to action and product of each ad's copy."""
    found = creative.features(creative.enrich(creatives, answer))
    return found.select(
        "ad_id", "copy_text", "tone", "discount_pct", "cta", "product", "extraction_method",
        F.coalesce("model_status", F.lit("")).alias("model_status"), "model_response", "dt", "source_file_name",
    )
