"""Joins, aggregates, windows, set operations, the value model and the flagship marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.functions import values
from admere.operators import lookup, spread, versions
from admere.operators.spread import with_scalars
from admere.plans import marts, reports, value
from admere.proofs.models import Chain
from admere.proofs.registry import CTES, Tables, proof

@proof("l_orderkey:i l_linenumber:i o_custkey:i l_quantity:n2", "SELECT l_orderkey, l_linenumber, o_custkey, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def inner_join(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@proof("o_orderkey:i segment", "SELECT o_orderkey, c_mktsegment AS segment FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END")
def left_lookup(t: Tables) -> DataFrame:
    # A fifth of the orders has no key; those rows spread over all tasks.
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("customer"))
    return lookup.left_lookup(o, t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment")), {"customer": "c_custkey"})


@proof("user_id:i event_id:i seen:i", "SELECT e.user_id, event_id, n AS seen FROM events e LEFT JOIN (SELECT user_id, event_type, count(*) AS n FROM events WHERE value > 50 GROUP BY 1, 2) v ON v.user_id = e.user_id AND v.event_type = e.event_type")
def left_composite(t: Tables) -> DataFrame:
    big = t.events.filter("value > 50").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("seen"))
    return t.events.join(big, ["user_id", "event_type"], "left")


@proof("c_custkey:i", "SELECT c_custkey FROM customer WHERE NOT EXISTS (FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_join(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.filter("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@proof("o_orderkey:i", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def semi_join(t: Tables) -> DataFrame:
    return t.orders.join(t.customer.filter("c_acctbal < 0"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@proof("o_orderkey:i days_before_end:i", "SELECT o_orderkey, datediff('day', CAST(o_orderdate AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS days_before_end FROM orders")
def scalar_cross(t: Tables) -> DataFrame:
    o = t.orders.withColumn("day", F.to_date("o_orderdate"))
    last = o.agg(F.max("day").alias("last_day"))
    return spread.with_scalars(o, last).withColumn("days_before_end", F.datediff("last_day", "day"))


@proof(
    "nation:i customers:i suppliers:i sold:n2 bought:n2",
    """SELECT n_nationkey AS nation, c.n AS customers, s.n AS suppliers, sold, bought FROM nation
       LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey
       LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey
       LEFT JOIN (SELECT s_nationkey AS k, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sold FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1) x ON x.k = n_nationkey
       LEFT JOIN (SELECT c_nationkey AS k, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS bought FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1) y ON y.k = n_nationkey
       WHERE c.n IS NOT NULL OR s.n IS NOT NULL OR sold IS NOT NULL OR bought IS NOT NULL""",
)
def key_spine(t: Tables) -> DataFrame:
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)"))
    s, c = F.col("s_nationkey").alias("nation"), F.col("c_nationkey").alias("nation")
    sold = t.lineitem.groupBy("l_suppkey").agg(money("l_extendedprice").alias("sold")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    bought = t.orders.groupBy("o_custkey").agg(money("o_totalprice").alias("bought")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    parts = [
        t.customer.groupBy(c).agg(F.count(F.lit(1)).alias("customers")), t.supplier.groupBy(s).agg(F.count(F.lit(1)).alias("suppliers")),
        sold.select(s, "sold"), bought.select(c, "bought"),
    ]
    return spread.add_partials(parts, ["nation"], {"customers": "bigint", "suppliers": "bigint", "sold": "decimal(38,2)", "bought": "decimal(38,2)"})


CTES["spend_weeks"] = """SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start_date, p_brand AS campaign_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spend, count(*) AS n, min(l_shipdate) AS first_ship,
    max(l_shipdate) AS last_ship FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2"""


@proof("week_start_date:d campaign_id spend:n2 n:i first_ship:d last_ship:d", "FROM spend_weeks")
def weekly_rollup(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(values.week_start("l_shipdate").alias("week_start_date"), F.col("p_brand").alias("campaign_id")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("spend"), F.count(F.lit(1)).alias("n"), F.to_date(F.min("l_shipdate")).alias("first_ship"), F.to_date(F.max("l_shipdate")).alias("last_ship")
    )


@proof("brand parts:i suppliers:i returned:i", "SELECT p_brand AS brand, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS returned FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def distinct_counts(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(F.col("p_brand").alias("brand")).agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("returned"),
    )


@proof("grains:i", "SELECT count(*) AS grains FROM (SELECT DISTINCT user_id, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS day FROM events)")
def distinct_composite(t: Tables) -> DataFrame:
    # The struct keeps grains whose second part is NULL.
    day = F.when(F.col("event_type") != "error", F.to_date("ts"))
    return t.events.agg(F.count_distinct(F.struct("user_id", day.alias("day"))).alias("grains"))


@proof("o_custkey:i o_orderpriority", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_rows(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@proof("week_start_date:d campaign_id share:n6", "SELECT week_start_date, campaign_id, CAST(spend AS DOUBLE) / CAST(sum(spend) OVER (PARTITION BY week_start_date) AS DOUBLE) AS share FROM spend_weeks")
def share_of_total(t: Tables) -> DataFrame:
    return spread.share_of_group(weekly_rollup(t), ["week_start_date"], "spend", "share")


CTES["city_orders"] = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mon, c_mktsegment AS campaign, r_name AS city, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3"""
CTES["segment_spend"] = "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mon, c_mktsegment AS campaign, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2"


@proof("mon:d campaign city allocated:n6", "SELECT mon, campaign, city, CAST(spend AS DOUBLE) * (n / sum(n) OVER (PARTITION BY mon, campaign)) AS allocated FROM city_orders JOIN segment_spend USING (mon, campaign)")
def spend_allocation(t: Tables) -> DataFrame:
    keys = [F.trunc("o_orderdate", "MONTH").alias("mon"), F.col("c_mktsegment").alias("campaign")]
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    by_nation = placed.groupBy(*keys, "c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend"))
    cities = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("city"))
    by_city = by_nation.join(cities, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("mon", "campaign", "city").agg(F.sum("n").alias("n"))
    total = by_nation.groupBy("mon", "campaign").agg(F.sum("spend").alias("spend"))
    shares = spread.share_of_group(by_city, ["mon", "campaign"], "n", "share")
    return shares.join(total, ["mon", "campaign"]).withColumn("allocated", F.col("spend").cast("double") * F.col("share"))


@proof("week_start_date:d brand p_type spend:n2", """SELECT DISTINCT ON (week_start_date, brand) * FROM (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start_date, p_brand AS brand, p_type, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spend
       FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3) ORDER BY week_start_date, brand, spend DESC, p_type""")
def dominant_item(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    sums = joined.groupBy(values.week_start("l_shipdate").alias("week_start_date"), F.col("p_brand").alias("brand"), "p_type").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("spend"))
    return versions.top_per_key(sums, ["week_start_date", "brand"], [F.col("spend").desc(), F.col("p_type").asc()])


@proof("week_start_date:d city_standard avg_temperature_max_c:n4 avg_temperature_min_c:n4 total_precipitation_mm:n2", "SELECT CAST(date_trunc('week', weather_date) AS DATE) AS week_start_date, city_standard, avg(hi) AS avg_temperature_max_c, avg(lo) AS avg_temperature_min_c, sum(rain) AS total_precipitation_mm FROM z_weather GROUP BY 1, 2")
def weather_weekly(t: Tables) -> DataFrame:
    return marts.weather_weekly(Chain(t)["stg_weather"])


@proof("o_orderkey:i completed:n2 refunded:n2", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS completed, CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END AS refunded FROM orders")
def conditional_measures(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", *[values.when_amount(F.col("o_orderstatus") == s, "o_totalprice").alias(n) for s, n in (("F", "completed"), ("P", "refunded"))])


@proof("user_id:i clicks:n2 views:n2 buys:i", "SELECT user_id, max(value) FILTER (event_type = 'click') AS clicks, max(value) FILTER (event_type = 'view') AS views, max(event_id) FILTER (event_type = 'purchase') AS buys FROM events GROUP BY 1")
def pivot_max(t: Tables) -> DataFrame:
    only = lambda kind, c: F.max(F.when(F.col("event_type") == kind, F.col(c)))
    return t.events.groupBy("user_id").agg(only("click", "value").alias("clicks"), only("view", "value").alias("views"), only("purchase", "event_id").alias("buys"))


@proof("kind id:i amount:n2 note", "SELECT 'order' AS kind, o_orderkey AS id, o_totalprice AS amount, o_orderpriority AS note FROM orders UNION ALL SELECT 'event', event_id, value, NULL FROM events")
def union_aligned(t: Tables) -> DataFrame:
    o = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("note"))
    e = t.events.select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("value").alias("amount"))
    return o.unionByName(e, allowMissingColumns=True)


@proof("id:i", "SELECT o_custkey AS id FROM orders UNION SELECT user_id FROM events")
def union_distinct(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("id")).union(t.events.select("user_id")).distinct()


CTES["promo_orders"] = """
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price, brand FROM orders LEFT JOIN (
        SELECT l_orderkey, arg_max(p_brand, (l_extendedprice, l_linenumber, l_partkey)) AS brand FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) ON l_orderkey = o_orderkey"""
CTES["promo_weeks"] = """
    WITH firsts AS (SELECT DISTINCT ON (o_custkey) * FROM promo_orders ORDER BY o_custkey, order_date, o_orderkey),
    later AS (SELECT f.o_custkey, coalesce(sum(p.price) FILTER (p.o_orderstatus = 'F' AND p.order_date - f.order_date BETWEEN 8 AND 97), 0) AS later, count(*) AS lifetime FROM firsts f JOIN promo_orders p USING (o_custkey) GROUP BY 1),
    s AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, p_brand AS brand, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spend, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS claims,
            sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INT)) AS claimed FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
    o AS (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, brand, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS done, sum(CASE WHEN o_orderstatus = 'F' THEN price ELSE 0 END) AS revenue FROM promo_orders WHERE brand IS NOT NULL GROUP BY 1, 2),
    n AS (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, brand, count(*) AS fresh, count(*) FILTER (lifetime = 1) AS once, sum(CASE WHEN o_orderstatus = 'F' THEN price ELSE 0 END) AS first_revenue, sum(CAST(later AS DOUBLE)) AS later
          FROM firsts JOIN later USING (o_custkey) WHERE brand IS NOT NULL GROUP BY 1, 2),
    spine AS (SELECT week, brand FROM s UNION SELECT week, brand FROM o UNION SELECT week, brand FROM n)
    SELECT week AS week_start_date, brand AS campaign_id, coalesce(spend, 0) AS spend_zar, coalesce(claimed, 0) AS claimed_revenue_zar, coalesce(orders, 0) AS real_orders, coalesce(done, 0) AS completed_orders, coalesce(revenue, 0) AS real_revenue_zar,
        coalesce(fresh, 0) AS new_customers, coalesce(first_revenue, 0) AS first_order_revenue_zar, coalesce(later, 0) AS predicted_value_90d, coalesce(once / nullif(fresh, 0), 0) AS one_time_buyer_share,
        CAST(claimed AS DOUBLE) / nullif(CAST(spend AS DOUBLE), 0) AS platform_roas, CAST(revenue AS DOUBLE) / nullif(CAST(spend AS DOUBLE), 0) AS actual_roas,
        (coalesce(CAST(first_revenue AS DOUBLE), 0) + coalesce(later, 0)) / nullif(CAST(spend AS DOUBLE), 0) AS value_adjusted_roas
    FROM spine LEFT JOIN s USING (week, brand) LEFT JOIN o USING (week, brand) LEFT JOIN n USING (week, brand)"""


def _promo_facts(t: Tables) -> dict[str, DataFrame]:
    """Facts for the marts: brands stand for campaigns, lineitem prices for spend."""
    money = "decimal(18,2)"
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    price = F.col("l_extendedprice").cast(money)
    spend = lines.select(
        F.to_date("l_shipdate").alias("spend_date"), F.lit("google").alias("platform"), F.col("p_brand").alias("campaign_id"), price.alias("spend_zar"),
        F.col("l_quantity").cast("bigint").alias("claimed_conversions"), (price * F.col("l_quantity").cast("int")).alias("claimed_revenue_zar"),
        F.col("l_quantity").cast("bigint").alias("impressions"), F.lit(1).alias("clicks"), F.to_date("l_shipdate").alias("dt"), F.lit("lineitem").alias("source_file_name"),
    )
    brand = lines.groupBy("l_orderkey").agg(versions.latest_by("p_brand", "l_extendedprice", "l_linenumber", "l_partkey").alias("campaign_id"))
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "refunded").otherwise("open")
    orders = t.orders.join(brand, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_key"), F.to_date("o_orderdate").alias("order_date"), F.col("o_orderdate").alias("order_timestamp_utc"),
        F.lit("google").alias("attributed_platform"), "campaign_id", F.lit(None).cast("string").alias("ad_id"), F.lit("utm").alias("attribution_method"), status.alias("status"),
        F.col("o_totalprice").cast(money).alias("revenue"), F.lit(0).alias("discount"), F.lit(1).alias("item_count"), F.lit(None).cast("date").alias("dt"), F.lit("orders").alias("source_file_name"),
    )
    orders = orders.withColumn("completed_revenue", values.when_amount(F.col("status") == "completed", F.col("revenue")))
    people = orders.groupBy("customer_key").agg(F.min("order_date").alias("first_order_date"), F.count(F.lit(1)).alias("lifetime_order_count"))
    acquired = people.select("customer_key", F.col("first_order_date").alias("acquisition_date"))
    windows = value.order_windows(acquired, orders)
    campaigns = t.part.select(F.lit("google").alias("platform"), F.col("p_brand").alias("campaign_id"), F.col("p_brand").alias("current_campaign_name")).distinct()
    return {
        "spend": spend, "orders": orders, "people": people, "windows": windows, "campaigns": campaigns,
        "values": windows.select("customer_key", F.col(value.LABEL).cast("double").alias("predicted_value_90d")),
    }


def _promo_weeks(t: Tables) -> DataFrame:
    f = _promo_facts(t)
    return marts.mart_campaign_value(f["spend"], f["orders"], f["people"], f["values"], f["campaigns"])


@proof(
    "week_start_date:d campaign_id spend_zar:n2 claimed_revenue_zar:n2 real_orders:i completed_orders:i real_revenue_zar:n2 new_customers:i first_order_revenue_zar:n2 predicted_value_90d:n2 one_time_buyer_share:n4 "
    "platform_roas:n9 actual_roas:n9 value_adjusted_roas:n6",
    "FROM promo_weeks",
)
def campaign_value(t: Tables) -> DataFrame:
    """Flagship: weekly spend, orders and new-customer value per campaign in one combined aggregate."""
    return _promo_weeks(t)


@proof(
    "campaign_id spend_zar:n2 real_revenue_zar:n2 predicted_value_90d:n2 platform_roas:n9 actual_roas:n9 value_adjusted_roas:n6 platform_roas_rank:i value_adjusted_roas_rank:i",
    """SELECT *, dense_rank() OVER (ORDER BY platform_roas DESC) AS platform_roas_rank, dense_rank() OVER (ORDER BY value_adjusted_roas DESC) AS value_adjusted_roas_rank FROM (
       SELECT campaign_id, sum(spend_zar) AS spend_zar, sum(real_revenue_zar) AS real_revenue_zar, sum(predicted_value_90d) AS predicted_value_90d, CAST(sum(claimed_revenue_zar) AS DOUBLE) / CAST(sum(spend_zar) AS DOUBLE) AS platform_roas,
           CAST(sum(real_revenue_zar) AS DOUBLE) / CAST(sum(spend_zar) AS DOUBLE) AS actual_roas, (CAST(sum(first_order_revenue_zar) AS DOUBLE) + sum(predicted_value_90d)) / CAST(sum(spend_zar) AS DOUBLE) AS value_adjusted_roas FROM promo_weeks GROUP BY 1)""",
)
def campaign_story(t: Tables) -> DataFrame:
    return marts.campaign_story(_promo_weeks(t))


@proof(
    "customer_key:i orders_7d:i completed_orders_7d:i refunded_orders_7d:i completed_revenue_7d:n2 future_value_90d:n2",
    """SELECT o_custkey AS customer_key, count(*) FILTER (age <= 7) AS orders_7d, count(*) FILTER (age <= 7 AND o_orderstatus = 'F') AS completed_orders_7d, count(*) FILTER (age <= 7 AND o_orderstatus = 'P') AS refunded_orders_7d,
       coalesce(sum(price) FILTER (age <= 7 AND o_orderstatus = 'F'), 0) AS completed_revenue_7d, coalesce(sum(price) FILTER (age BETWEEN 8 AND 97 AND o_orderstatus = 'F'), 0) AS future_value_90d
       FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price, datediff('day', min(o_orderdate) OVER (PARTITION BY o_custkey), o_orderdate) AS age FROM orders) GROUP BY 1""",
)
def windowed_features(t: Tables) -> DataFrame:
    return _promo_facts(t)["windows"]


@proof(
    "customer_key:i acquisition_date:d ripe:b trainable:b",
    """SELECT o_custkey AS customer_key, min(CAST(o_orderdate AS DATE)) AS acquisition_date, min(CAST(o_orderdate AS DATE)) <= (SELECT CAST(max(o_orderdate) AS DATE) - 7 FROM orders) AS ripe,
       min(CAST(o_orderdate AS DATE)) <= (SELECT CAST(max(o_orderdate) AS DATE) - 97 FROM orders) AS trainable FROM orders GROUP BY 1""",
)
def cohort_maturity(t: Tables) -> DataFrame:
    o = t.orders.withColumn("day", F.to_date("o_orderdate"))
    firsts = o.groupBy(F.col("o_custkey").alias("customer_key")).agg(F.min("day").alias("acquisition_date"))
    dated = spread.with_scalars(firsts, o.agg(F.max("day").alias("last_day")))
    first = F.col("acquisition_date")
    return dated.withColumn("ripe", first <= F.date_sub("last_day", value.FEATURE_DAYS)).withColumn("trainable", first <= value.training_cutoff(F.col("last_day")))


@proof("c_custkey:i held:b", "SELECT c_custkey, CAST('0x' || substr(sha256(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20 AS held FROM customer")
def holdout_split(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", value.holdout("c_custkey").alias("held"))


@proof("c_custkey:i spent:n2 value_segment", "SELECT c_custkey, spent, ['high', 'steady', 'low'][ntile(3) OVER (ORDER BY spent DESC, c_custkey)] AS value_segment FROM (SELECT c_custkey, coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS spent FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)")
def ntile_segments(t: Tables) -> DataFrame:
    sums = t.orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"))
    spent = t.customer.join(sums, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", F.coalesce("s", F.lit(0)).alias("spent"))
    return value.segments(spent, "spent", "c_custkey")


@proof("event_id:i place:i", "SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) AS place FROM events")
def global_row_number(t: Tables) -> DataFrame:
    return spread.global_row_number(t.events, [F.col("value").desc(), F.col("event_id").asc()], "place")


@proof(
    "mean_absolute_error:n4 mean_squared_error:n0 mean_squared_log_error:n6 median_absolute_error:n4 r2_score:n6 explained_variance:n6",
    """WITH s AS (SELECT o_totalprice AS y, c_acctbal * 40 AS p FROM orders JOIN customer ON c_custkey = o_custkey)
       SELECT avg(abs(y - p)) AS mean_absolute_error, avg((y - p) ** 2) AS mean_squared_error, avg((ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0))) ** 2) AS mean_squared_log_error, quantile_disc(abs(y - p), 0.5) AS median_absolute_error,
           1 - avg((y - p) ** 2) / var_pop(y) AS r2_score, 1 - var_pop(y - p) / var_pop(y) AS explained_variance FROM s""",
)
def regression_metrics(t: Tables) -> DataFrame:
    scored = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_totalprice").alias("y"), (F.col("c_acctbal") * 40).alias("p"))
    return value.regression_metrics(scored, "y", "p")


def _fitted(t: Tables) -> tuple[value.ValueModel, DataFrame, Chain]:
    c = Chain(t)
    features = c["mart_customer_features"]
    return value.train(features), features, c


@proof("customer_key acquisition_date:d predicted_future_value_90d_raw predicted_future_value_90d value_segment", name="train_predict")
def train_predict(t: Tables) -> DataFrame:
    """Rows only: boosted trees cannot be written in SQL."""
    return train_predict_frame(t)


def train_predict_frame(t: Tables) -> DataFrame:
    model, features, c = _fitted(t)
    last_day = c["dim_date"].agg(F.max("calendar_date").alias("last_day"))
    return value.ml_customer_pltv(model, features, last_day, F.lit("2024-06-01 00:00:00").cast("timestamp"))


#: Customers seen for seven days by the last day of the calendar.
_RIPE = """acquisition_date <= (SELECT greatest((SELECT max(performance_date) FROM z_google), (SELECT max(insight_date) FROM z_meta),
    (SELECT max(session_date) FROM z_sessions), (SELECT max(order_date) FROM z_attributed)) - 7)"""


@proof(
    "customer_key acquisition_date:d clamped:b ordered:b",
    f"SELECT customer_key, acquisition_date, true AS clamped, true AS ordered FROM z_mart_features WHERE {_RIPE}",
)
def scored_customers(t: Tables) -> DataFrame:
    """Who is scored, that no score is below zero, and that no segment outranks a better one."""
    scores = train_predict_frame(t)
    p = F.col("predicted_future_value_90d")
    edges = scores.agg(*[f(F.when(F.col("value_segment") == s, p)).alias(f"{f.__name__}_{s}") for s in ("high", "steady", "low") for f in (F.min, F.max)])
    ordered = (F.col("min_high") >= F.col("max_steady")) & (F.col("min_steady") >= F.col("max_low"))
    return with_scalars(scores, edges).select("customer_key", "acquisition_date", (p == F.greatest("predicted_future_value_90d_raw", F.lit(0.0))).alias("clamped"), ordered.alias("ordered"))


@proof(
    "value_segment n:i",
    f"""SELECT CASE tile WHEN 1 THEN 'high' WHEN 2 THEN 'steady' ELSE 'low' END AS value_segment, count(*) AS n
    FROM (SELECT ntile(3) OVER (ORDER BY customer_key) AS tile FROM z_mart_features WHERE {_RIPE}) GROUP BY 1""",
)
def score_segments(t: Tables) -> DataFrame:
    return train_predict_frame(t).groupBy("value_segment").agg(F.count(F.lit(1)).alias("n"))


def _score_report(t: Tables, spoil: bool) -> DataFrame:
    model, features, c = _fitted(t)
    last_day = c["dim_date"].agg(F.max("calendar_date").alias("last_day"))
    scores, measures = train_predict_frame(t), value.evaluate(model, features)
    info, inputs = model.training_info(t.spark), model.feature_info(t.spark)
    if spoil:
        worse = scores.withColumn("predicted_future_value_90d", F.when(F.col("value_segment") == "high", F.lit(-1.0)).otherwise(F.col("predicted_future_value_90d")))
        scores = worse.union(worse).withColumn("source_file_name", F.lit(None).cast("string")).filter("value_segment <> 'low'").withColumn("email", F.lit("x"))
        measures, info = measures.withColumn("r2_score", F.lit(None).cast("double")), info.limit(0)
        inputs = inputs.union(t.spark.range(1).select(F.lit(value.LABEL), F.lit(0.1)))
    return reports.score_report(scores, features, last_day, measures, info, inputs)


@proof(
    "check_name status",
    f"""WITH n AS (SELECT count(*) AS k FROM z_mart_features WHERE {_RIPE})
    SELECT unnest(['Model training info available', 'Model training evaluated holdout loss', 'Evaluation metrics persisted', 'Evaluation metrics valid', 'Prediction keys unique', 'Predicted values non-negative',
        'Value segment ordering valid', 'Target excluded from model features', 'No raw PII in predictions', 'Prediction lineage retained']) AS check_name, 'PASS' AS status
    UNION ALL SELECT 'Eligible customers scored', CASE WHEN k > 0 THEN 'PASS' ELSE 'FAIL' END FROM n UNION ALL SELECT 'All value segments populated', CASE WHEN k >= 3 THEN 'PASS' ELSE 'FAIL' END FROM n""",
)
def score_report(t: Tables) -> DataFrame:
    return _score_report(t, spoil=False)


@proof(
    "check_name status",
    """SELECT unnest(['Model training info available', 'Model training evaluated holdout loss', 'Evaluation metrics valid', 'Eligible customers scored', 'Prediction keys unique', 'Predicted values non-negative',
        'All value segments populated', 'Value segment ordering valid', 'Target excluded from model features', 'No raw PII in predictions', 'Prediction lineage retained']) AS check_name, 'FAIL' AS status
    FROM (SELECT count(*) AS k FROM z_mart_features) WHERE k > 0 UNION ALL SELECT 'Evaluation metrics persisted', 'PASS'""",
)
def score_report_of_spoilt_scores(t: Tables) -> DataFrame:
    """Every check of the scores can fail: the same report on scores with one fault for each."""
    return _score_report(t, spoil=True)


@proof("mean_absolute_error mean_squared_error mean_squared_log_error median_absolute_error r2_score explained_variance", name="ml_customer_pltv_evaluation")
def model_evaluation(t: Tables) -> DataFrame:
    model, features, _ = _fitted(t)
    return value.evaluate(model, features)


@proof("campaign_key spend:n2 new_customers:i claims:i platform:n4 actual:n4 value:n2 one_time_pct:n2", """
    WITH people AS (SELECT c_custkey AS person_id, CASE WHEN c_acctbal > 7000 THEN 'vip' WHEN c_acctbal > 3000 THEN 'steady' ELSE 'one_and_done' END AS value_type, min(CAST(o_orderdate AS DATE)) AS acquired FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
    o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderpriority AS campaign, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 AS is_first FROM orders),
    cohort AS (SELECT p.person_id, value_type, coalesce(sum(price) FILTER (o_orderstatus = 'F' AND day - acquired BETWEEN 8 AND 97), 0) AS later FROM people p JOIN o ON o_custkey = person_id WHERE acquired <= (SELECT max(day) - 97 FROM o) GROUP BY 1, 2),
    worth AS (SELECT value_type, avg(CAST(later AS DOUBLE)) AS v FROM cohort GROUP BY 1),
    got AS (SELECT campaign, sum(price) AS revenue, count(*) FILTER (is_first) AS fresh, sum(CAST(price AS DOUBLE) + coalesce(v, 0)) FILTER (is_first) AS val, count(*) FILTER (is_first AND p.value_type = 'one_and_done') AS once
        FROM o JOIN people p ON p.person_id = o_custkey LEFT JOIN worth w ON w.value_type = p.value_type WHERE o_orderstatus = 'F' GROUP BY 1),
    spent AS (SELECT o_orderpriority AS campaign, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spend, count(*) AS claims, sum(CAST(l_quantity AS BIGINT)) AS claimed FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT campaign AS campaign_key, spend, fresh AS new_customers, claims, claimed / CAST(spend AS DOUBLE) AS platform, CAST(revenue AS DOUBLE) / CAST(spend AS DOUBLE) AS actual, coalesce(val, 0) / CAST(spend AS DOUBLE) AS value, 100.0 * once / greatest(fresh, 1) AS one_time_pct
    FROM spent JOIN got USING (campaign)""")
def truth_scoreboard(t: Tables) -> DataFrame:
    kind = F.when(F.col("c_acctbal") > 7000, "vip").when(F.col("c_acctbal") > 3000, "steady").otherwise("one_and_done")
    first = t.orders.groupBy("o_custkey").agg(F.min_by(F.struct("o_orderdate", "o_orderkey"), F.struct("o_orderdate", "o_orderkey")).alias("f"))
    people = t.customer.join(first, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_custkey").alias("person_id"), kind.alias("value_type"), F.to_date("f.o_orderdate").alias("acquired_date"))
    firsts = first.select(F.col("f.o_orderkey").alias("first_key"), F.lit(True).alias("is_first"))
    money = lambda c: F.col(c).cast("decimal(18,2)")
    orders = t.orders.join(firsts, F.col("o_orderkey") == F.col("first_key"), "left").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderdate").alias("order_ts"), money("o_totalprice").alias("revenue"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("other").alias("status"),
        F.coalesce("is_first", F.lit(False)).alias("is_first_order"), F.col("o_orderpriority").alias("campaign_key"),
    )
    sold = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    spend = sold.select(F.col("o_orderpriority").alias("campaign_key"), money("l_extendedprice").alias("spend_zar"))
    claims = sold.select(F.col("o_orderpriority").alias("ad_id"), F.col("l_quantity").cast("bigint").alias("revenue"))
    ads = t.orders.select(F.col("o_orderpriority").alias("ad_id"), F.col("o_orderpriority").alias("campaign_key")).distinct()
    return marts.truth_scoreboard(orders, people, spend, claims, ads)
