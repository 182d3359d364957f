"""Customer value, weekly campaign value, drivers by city and the ranked story."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.functions.values import greatest_or_null, ratio, week_start
from admere.operators.spread import add_partials, global_dense_rank, share_of_group, with_scalars
from admere.operators.versions import latest_by, top_per_key
from admere.plans.value import LABEL, SESSION_COUNTS
from admere.session import stable
from admere.sources.schemas import CITIES

PLATFORMS = ("google", "meta")
GRAIN = ("week_start_date", "platform", "campaign_id")
MONEY_SUM = "decimal(38,9)"


def mart_customer_value(scores: DataFrame, features: DataFrame, customers: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One scored customer with acquisition, early behaviour and predicted value."""
    s = scores.select(
        "customer_key", "value_segment", "scored_at_utc",
        F.col("predicted_future_value_90d").alias("predicted_value_90d"),
        F.col("dt").alias("__s_dt"), F.col("source_file_name").alias("__s_file"),
    )
    d = customers.select("customer_key", "lifetime_order_count", F.col("dt").alias("__d_dt"))
    c = campaigns.select(
        F.col("platform").alias("acquisition_platform"), F.col("campaign_id").alias("acquisition_campaign_id"),
        F.col("current_campaign_name").alias("acquisition_campaign_name"),
    )
    joined = s.join(features, "customer_key").join(d, "customer_key").join(c, ["acquisition_platform", "acquisition_campaign_id"], "left")
    return joined.select(
        "customer_key", "acquisition_date", "city_standard", "acquisition_platform", "acquisition_campaign_id",
        "acquisition_campaign_name", "acquisition_ad_id", "acquisition_attribution_method", "first_order_value",
        "first_order_completed_revenue", "first_order_item_count", "first_order_discount", "acquisition_creative_tone",
        "acquisition_creative_discount_pct", "acquisition_creative_cta", "acquisition_creative_product", "orders_7d",
        "completed_orders_7d", "refunded_orders_7d", "completed_revenue_7d", "avg_completed_order_value_7d", "discount_7d",
        "items_7d", *SESSION_COUNTS, "first_device_category", "predicted_value_90d", "value_segment",
        F.col(LABEL).alias("observed_future_value_90d"), "lifetime_order_count",
        (F.col("lifetime_order_count") == 1).alias("is_one_time_buyer"), "scored_at_utc",
        greatest_or_null("__s_dt", "dt", "__d_dt").alias("dt"), F.col("__s_file").alias("source_file_name"),
    )


def paid(orders: DataFrame) -> DataFrame:
    """Rows a paid campaign of either platform brought in."""
    return orders.filter(F.col("attributed_platform").isin(*PLATFORMS) & F.col("campaign_id").isNotNull())


def weekly_spend(spend: DataFrame) -> DataFrame:
    return spend.groupBy(week_start("spend_date").alias("week_start_date"), "platform", "campaign_id").agg(
        F.sum("spend_zar").alias("spend_zar"),
        F.sum("claimed_conversions").alias("claimed_conversions"),
        F.sum("claimed_revenue_zar").alias("claimed_revenue_zar"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.max("dt").alias("dt"),
        latest_by("source_file_name", "spend_date", "dt", "source_file_name").alias("source_file_name"),
    )


def _grain(week_of: str, platform: str = "attributed_platform"):
    return week_start(week_of).alias("week_start_date"), F.col(platform).alias("platform"), F.col("campaign_id")


def weekly_orders(orders: DataFrame) -> DataFrame:
    return paid(orders).groupBy(*_grain("order_date")).agg(
        F.count(F.lit(1)).alias("real_orders"),
        F.count_if(F.col("status") == "completed").alias("completed_orders"),
        F.sum("completed_revenue").alias("real_revenue_zar"),
    )


def first_orders(orders: DataFrame) -> DataFrame:
    """Each customer's first order."""
    return top_per_key(orders, ["customer_key"], [F.col("order_timestamp_utc").asc(), F.col("order_id").asc()])


def weekly_new_customers(orders: DataFrame, customers: DataFrame, values: DataFrame) -> DataFrame:
    firsts = paid(first_orders(orders.select("customer_key", "order_id", "order_timestamp_utc", "order_date", "attributed_platform", "campaign_id", "completed_revenue")))
    known = firsts.join(customers.select("customer_key", "lifetime_order_count"), "customer_key").join(
        values.select("customer_key", "predicted_value_90d"), "customer_key", "left"
    )
    return known.groupBy(*_grain("order_date")).agg(
        F.count(F.lit(1)).alias("new_customers"),
        F.count_if(F.col("lifetime_order_count") == 1).alias("one_time_buyers"),
        F.sum("completed_revenue").alias("first_order_revenue_zar"),
        F.sum(F.coalesce("predicted_value_90d", F.lit(0.0))).alias("predicted_value_90d"),
    )


def mart_campaign_value(spend: DataFrame, orders: DataFrame, customers: DataFrame, values: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Weekly campaign result: claims, real orders, new customers and three returns on spend."""
    combined = add_partials(
        [weekly_spend(spend), weekly_orders(orders), weekly_new_customers(orders, customers, values)],
        GRAIN,
        {
            "spend_zar": MONEY_SUM, "impressions": "bigint", "clicks": "bigint", "claimed_conversions": MONEY_SUM,
            "claimed_revenue_zar": MONEY_SUM, "real_orders": "bigint", "completed_orders": "bigint",
            "real_revenue_zar": MONEY_SUM, "new_customers": "bigint", "one_time_buyers": "bigint",
            "first_order_revenue_zar": MONEY_SUM, "predicted_value_90d": "double",
        },
        {"dt": "date", "source_file_name": "string"},
    )
    names = campaigns.select("platform", "campaign_id", F.col("current_campaign_name").alias("campaign_name"))
    named = combined.join(names, ["platform", "campaign_id"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    promised = F.coalesce("first_order_revenue_zar", F.lit(0)).cast("double") + F.coalesce("predicted_value_90d", F.lit(0.0))
    return named.select(
        *GRAIN, "campaign_name", zero("spend_zar"), zero("impressions"), zero("clicks"), zero("claimed_conversions"),
        zero("claimed_revenue_zar"), zero("real_orders"), zero("completed_orders"), zero("real_revenue_zar"),
        zero("new_customers"), zero("first_order_revenue_zar"), zero("predicted_value_90d"),
        F.coalesce(F.try_divide(F.col("one_time_buyers").cast("double"), F.col("new_customers")), F.lit(0.0)).alias("one_time_buyer_share"),
        ratio("claimed_revenue_zar", "spend_zar").alias("platform_roas"),
        ratio("real_revenue_zar", "spend_zar").alias("actual_roas"),
        F.try_divide(promised, F.col("spend_zar").cast("double")).alias("value_adjusted_roas"),
        F.coalesce("dt", F.date_add("week_start_date", 6)).alias("dt"),
        F.coalesce("source_file_name", F.lit("derived:fct_orders")).alias("source_file_name"),
    )


def weather_weekly(weather: DataFrame) -> DataFrame:
    return weather.groupBy(week_start("weather_date").alias("week_start_date"), "city_standard").agg(
        F.avg("temperature_max_c").alias("avg_temperature_max_c"),
        F.avg("temperature_min_c").alias("avg_temperature_min_c"),
        F.sum("precipitation_mm").alias("total_precipitation_mm"),
        F.max("dt").alias("weather_dt"),
    )


def dominant_creative(spend: DataFrame, ads: DataFrame) -> DataFrame:
    """Tone and call to action with the most spend per campaign and week.

    The discount is the plain mean over ad-days, not weighted by spend.
    """
    joined = spend.join(ads.select("platform", "ad_id", "tone", "cta", "discount_pct"), ["platform", "ad_id"], "left")
    totals = joined.groupBy(week_start("spend_date").alias("week_start_date"), "platform", "campaign_id", "tone", "cta").agg(
        F.avg("discount_pct").alias("creative_discount_pct"), F.sum("spend_zar").alias("__spend")
    )
    top = top_per_key(totals, GRAIN, [F.col("__spend").desc(), F.col("tone").asc(), F.col("cta").asc()])
    return top.select(*GRAIN, F.col("tone").alias("dominant_tone"), F.col("cta").alias("dominant_cta"), "creative_discount_pct")


def city_results(sessions: DataFrame, orders: DataFrame, customers: DataFrame, cities: tuple[str, ...] = CITIES) -> DataFrame:
    """Sessions, orders and new customers per campaign-week and city, with the city's share of sessions."""
    keys = [*GRAIN, "city_standard"]
    by_session = paid(sessions).filter(F.col("city").isin(*cities)).groupBy(*_grain("session_date"), F.col("city").alias("city_standard")).agg(
        F.count(F.lit(1)).alias("attributed_sessions")
    )
    people = customers.select("customer_key", "city_standard", "first_order_date").filter(F.col("city_standard").isin(*cities))
    by_order = paid(orders).join(people, "customer_key").groupBy(*_grain("order_date"), "city_standard").agg(
        F.count(F.lit(1)).alias("real_orders"),
        F.sum("completed_revenue").alias("real_revenue_zar"),
        F.count_distinct(F.when(F.col("order_date") == F.col("first_order_date"), F.col("customer_key"))).alias("new_customers"),
    )
    both = add_partials(
        [by_session, by_order], keys,
        {"attributed_sessions": "bigint", "real_orders": "bigint", "real_revenue_zar": MONEY_SUM, "new_customers": "bigint"},
    )
    return share_of_group(both, GRAIN, "attributed_sessions", "city_session_share")


def mart_campaign_drivers(
    sessions: DataFrame, orders: DataFrame, customers: DataFrame, weather: DataFrame, spend: DataFrame, ads: DataFrame, campaign_value: DataFrame
) -> DataFrame:
    """Campaign-week by city: results, spend allocated by session share, weather and dominant copy."""
    cv = campaign_value.select(
        *GRAIN, "campaign_name", "spend_zar", "claimed_conversions", "claimed_revenue_zar", F.col("dt").alias("__cv_dt"), "source_file_name"
    )
    joined = (
        city_results(sessions, orders, customers)
        .join(cv, list(GRAIN))
        .join(weather_weekly(weather), ["week_start_date", "city_standard"])
        .join(dominant_creative(spend, ads), list(GRAIN), "left")
    )
    share = F.col("city_session_share")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    allocated = lambda c: F.coalesce(F.col(c).cast("double") * share, F.lit(0.0))
    return joined.select(
        *GRAIN, "campaign_name", "city_standard", zero("attributed_sessions"), zero("real_orders"), zero("real_revenue_zar"),
        zero("new_customers"),
        allocated("spend_zar").alias("allocated_spend_zar"),
        allocated("claimed_conversions").alias("allocated_claimed_conversions"),
        allocated("claimed_revenue_zar").alias("allocated_claimed_revenue_zar"),
        F.try_divide(F.coalesce(F.col("real_revenue_zar").cast("double"), F.lit(0.0)), F.col("spend_zar").cast("double") * share).alias("city_actual_roas"),
        "avg_temperature_max_c", "avg_temperature_min_c", "total_precipitation_mm",
        "dominant_tone", "dominant_cta", "creative_discount_pct",
        greatest_or_null("__cv_dt", "weather_dt").alias("dt"), "source_file_name",
    )


def campaign_story(campaign_value: DataFrame) -> DataFrame:
    """Campaigns ranked by claimed and by value-adjusted return on spend."""
    sums = campaign_value.groupBy("platform", "campaign_id").agg(
        F.max("campaign_name").alias("campaign_name"),
        *[F.sum(c).alias(c) for c in ("spend_zar", "claimed_revenue_zar", "real_revenue_zar", "first_order_revenue_zar", "predicted_value_90d")],
    )
    promised = F.col("first_order_revenue_zar").cast("double") + F.col("predicted_value_90d")
    rated = (
        sums.withColumn("platform_roas", ratio("claimed_revenue_zar", "spend_zar"))
        .withColumn("actual_roas", ratio("real_revenue_zar", "spend_zar"))
        .withColumn("value_adjusted_roas", F.try_divide(promised, F.col("spend_zar").cast("double")))
    )
    rated = stable(rated)
    ranked = global_dense_rank(global_dense_rank(rated, "platform_roas", "platform_roas_rank"), "value_adjusted_roas", "value_adjusted_roas_rank")
    return ranked.orderBy("value_adjusted_roas_rank", "campaign_name")


def truth_scoreboard(orders: DataFrame, people: DataFrame, spend: DataFrame, claims: DataFrame, ads: DataFrame) -> DataFrame:
    """Campaign scoreboard from ground truth, with the mean later value of each customer type.

    Types are valued on the mature cohort: completed revenue of days 8 to 97 per
    customer, customers without any counting as zero.
    """
    cohort = people_value(orders, people)
    by_type = cohort.groupBy("value_type").agg(F.avg("later_value").alias("type_value"))
    paid_orders = orders.filter(F.col("campaign_key").isNotNull() & (F.col("campaign_key") != "") & (F.col("status") == "completed"))
    typed = paid_orders.join(people.select("person_id", "value_type"), "person_id").join(by_type, "value_type", "left")
    first = F.col("is_first_order")
    real = typed.groupBy("campaign_key").agg(
        F.sum("revenue").alias("real_revenue"),
        F.count_if(first).alias("new_customers"),
        F.sum(F.when(first, F.col("revenue") + F.coalesce("type_value", F.lit(0.0)))).alias("value"),
        F.count_if(first & (F.col("value_type") == "one_and_done")).alias("one_time"),
    )
    spent = spend.groupBy("campaign_key").agg(F.sum("spend_zar").alias("spend"))
    claimed = claims.join(ads.select("ad_id", "campaign_key"), "ad_id").groupBy("campaign_key").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("revenue").alias("claimed_revenue")
    )
    measures = {"spend": "double", "real_revenue": "double", "new_customers": "bigint", "value": "double", "one_time": "bigint", "claims": "bigint", "claimed_revenue": "double"}
    board = add_partials([spent, real, claimed], ["campaign_key"], measures).filter(F.col("spend").isNotNull())
    zero = lambda c, t="double": F.coalesce(c, F.lit(0).cast(t))
    return board.select(
        "campaign_key", "spend",
        zero("new_customers", "bigint").alias("new_customers"),
        zero("claims", "bigint").alias("claims"),
        F.try_divide(zero("claimed_revenue"), F.col("spend")).alias("platform"),
        F.try_divide(zero("real_revenue"), F.col("spend")).alias("actual"),
        F.try_divide(zero("value"), F.col("spend")).alias("value"),
        (100.0 * zero("one_time", "bigint") / F.greatest(zero("new_customers", "bigint"), F.lit(1))).alias("one_time_pct"),
    )


def people_value(orders: DataFrame, people: DataFrame) -> DataFrame:
    """Completed revenue of days 8-97 for every person of the mature cohort."""
    last = orders.agg(F.max(F.to_date("order_ts")).alias("last_day"))
    dated = orders.filter(F.col("status") == "completed").join(people.select("person_id", "acquired_date"), "person_id")
    age = F.datediff(F.to_date("order_ts"), F.col("acquired_date"))
    later = dated.filter((age > 7) & (age <= 97)).groupBy("person_id").agg(F.sum("revenue").alias("later_value"))
    ripe = with_scalars(people, last).filter(F.col("acquired_date") <= F.date_sub("last_day", 97))
    return ripe.join(later, "person_id", "left").select(
        "person_id", "value_type", F.coalesce("later_value", F.lit(0.0)).alias("later_value")
    )
