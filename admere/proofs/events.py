"""Versions, dedupe, sessions, attribution, identity and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.operators import identity, matching, sessions, spread, versions
from admere.plans import conformed, identities, incremental, staging
from admere.proofs.landing import Delivered, flat
from admere.proofs.models import Chain
from admere.proofs.registry import CTES, Tables, proof
from admere.session import scratch_path
from admere.sources import tables
from admere.sources.versioned import VersionedTable

CTES["latest_order"] = "SELECT DISTINCT ON (order_id) * FROM raw_orders ORDER BY order_id, updated_at DESC, dt DESC, source_file_name DESC"


@proof("order_id status updated_at dt:d", "SELECT order_id, status, updated_at, dt FROM latest_order")
def latest_version(t: Tables) -> DataFrame:
    return versions.latest_version(flat(t, "raw_orders"), ["order_id"], ["updated_at", "dt", "source_file_name"])


@proof("order_id status updated_at dt:d", "SELECT DISTINCT order_id, status, updated_at, dt FROM raw_orders")
def exact_dedupe(t: Tables) -> DataFrame:
    raw = flat(t, "raw_orders")
    business = [c for c in raw.columns if c not in staging.LINEAGE]
    return versions.drop_exact_copies(raw, business, staging.LINEAGE)


@proof("event_fingerprint transaction_id dt:d", "SELECT fp AS event_fingerprint, transaction_id, dt FROM z_events")
def two_stage_dedupe(t: Tables) -> DataFrame:
    return staging.dedupe_events(staging.flat_events(Delivered(t)["ga4_events"]))


@proof("event_timestamp:i user_pseudo_id dt:d copies:i", "SELECT event_timestamp, user_pseudo_id, dt, count(*) OVER (PARTITION BY event_timestamp, user_pseudo_id, event_name, ga_session_id) AS copies FROM raw_events")
def dup_count_window(t: Tables) -> DataFrame:
    key = ["event_timestamp", "user_pseudo_id", "event_name", "ga_session_id"]
    return spread.with_group_values(flat(t, "raw_events"), key, {"copies": F.count(F.lit(1))})


@proof("dt:d source_file_name duplicate_rows:i", "SELECT dt, source_file_name, count(*) - count(DISTINCT (order_id, customer_id, order_ts, subtotal, discount, revenue, status, item_count, updated_at)) AS duplicate_rows FROM raw_orders GROUP BY 1, 2")
def duplicate_excess(t: Tables) -> DataFrame:
    raw = flat(t, "raw_orders")
    return versions.duplicate_excess(raw, staging.LINEAGE, [c for c in raw.columns if c not in staging.LINEAGE])


@proof("order_id row_count:i", "SELECT order_id, count(*) AS row_count FROM raw_orders GROUP BY 1 HAVING count(*) > 1")
def having_dup(t: Tables) -> DataFrame:
    return versions.duplicate_keys(flat(t, "raw_orders"), ["order_id"])


CTES["z_meta_pulls"] = "SELECT ad, day, p AS pull, CAST(day + p AS DATE) AS dt, CASE WHEN p = 1 THEN impressions // 2 ELSE impressions END AS impressions FROM raw_ad_days, (VALUES (1), (2)) AS v(p)"


@proof("ad:i day:d impressions:i dt:d", "SELECT ad, day, arg_max(impressions, dt) AS impressions, max(dt) AS dt FROM z_meta_pulls GROUP BY 1, 2")
def restatement(t: Tables) -> DataFrame:
    pulls = flat(t, "raw_ad_days").withColumn("pull", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("dt", F.expr("date_add(day, pull)"))
    pulled = pulls.withColumn("impressions", F.expr("CASE WHEN pull = 1 THEN impressions div 2 ELSE impressions END"))
    return incremental.restate(pulled, ["ad", "day"], ["dt"])


@proof(
    "user_id:i last_type first_type last_buy:i first_buy:i",
    """SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_id, (ts, event_id)) FILTER (event_type = 'purchase') AS last_buy,
       arg_min(event_id, (ts, event_id)) FILTER (event_type = 'purchase') AS first_buy FROM events GROUP BY 1""",
)
def latest_by(t: Tables) -> DataFrame:
    bought = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return t.events.groupBy("user_id").agg(
        versions.latest_by("event_type", "ts", "event_id").alias("last_type"), versions.earliest_by("event_type", "ts", "event_id").alias("first_type"),
        versions.latest_by(bought, "ts", "event_id", ignore_nulls=True).alias("last_buy"), versions.earliest_by(bought, "ts", "event_id", ignore_nulls=True).alias("first_buy"),
    )


@proof("user_id:i event_type value:n2 props", "SELECT DISTINCT ON (user_id) user_id, event_type, value, props FROM events ORDER BY user_id, ts DESC, event_id DESC")
def latest_struct(t: Tables) -> DataFrame:
    whole = versions.latest_by(F.struct("event_type", "value", "props"), "ts", "event_id")
    return t.events.groupBy("user_id").agg(whole.alias("e")).select("user_id", "e.*")


@proof("o_custkey:i o_orderkey:i o_totalprice:n2", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey")
def first_event(t: Tables) -> DataFrame:
    return versions.top_per_key(t.orders, ["o_custkey"], [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()])


@proof("o_custkey:i history", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS history FROM orders GROUP BY 1")
def name_history(t: Tables) -> DataFrame:
    found = versions.distinct_history(t.orders, ["o_custkey"], "o_orderpriority", "history")
    return found.withColumn("history", F.concat_ws(",", "history"))


@proof("o_custkey:i any_open:b all_large:b", "SELECT o_custkey, bool_or(o_orderstatus = 'O') AS any_open, bool_and(o_totalprice > 50000) AS all_large FROM orders GROUP BY 1")
def bool_aggs(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "O").alias("any_open"), F.bool_and(F.col("o_totalprice") > 50000).alias("all_large"))


_SESSION = "user_pseudo_id ga_session_id:i"


@proof(
    f"{_SESSION} session_start_utc:t session_end_utc:t session_date:d city device_category operating_system transaction_id gclid utm_source is_internal_session:b event_count:i engagement_time_msec:i dt:d source_file_name",
    "SELECT *, started AS session_start_utc, ended AS session_end_utc, tag_source AS utm_source, staff AS is_internal_session FROM z_rolled",
)
def session_rollup(t: Tables) -> DataFrame:
    return sessions.roll_up(Chain(t)["stg_ga4_events"])


@proof(
    "event_fingerprint dt:d session_gclid session_fbclid session_source",
    "SELECT fp AS event_fingerprint, dt, s_gclid AS session_gclid, s_fbclid AS session_fbclid, s_source AS session_source FROM z_event_flat JOIN z_session_values USING (user_pseudo_id, ga_session_id)",
)
def session_carry(t: Tables) -> DataFrame:
    raw = Delivered(t)["ga4_events"]
    return sessions.carry_session_values(staging.flat_events(raw), {f"event_{n}": f"session_{n}" for n in ("gclid", "fbclid", "source")}, source=staging.event_tags(raw))


@proof(f"{_SESSION} customer_id customer_key", "SELECT r.user_pseudo_id, r.ga_session_id, s.customer_id, s.customer_key FROM z_rolled r LEFT JOIN z_sessions s USING (user_pseudo_id, ga_session_id) WHERE NOT staff")
def session_identity(t: Tables) -> DataFrame:
    c = Chain(t)
    order_people = c["stg_crm_orders"].select("order_id", "customer_id").join(c["int_customer_identity"].select("customer_id", "customer_key"), "customer_id")
    events = c["stg_ga4_events"]
    return sessions.session_people(sessions.roll_up(events), sessions.session_orders(events), order_people).filter(~F.col("is_internal_session"))


@proof(f"{_SESSION} campaign_id ad_id", "SELECT user_pseudo_id, ga_session_id, campaign_id, ad_id FROM z_sessions")
def session_campaign(t: Tables) -> DataFrame:
    c = Chain(t)
    ads = c["stg_meta_ads"].groupBy("ad_id").agg(versions.latest_by("campaign_id", "insight_date", "pulled_at_utc").alias("campaign_id"))
    rolled = sessions.roll_up(c["stg_ga4_events"]).filter(~F.col("is_internal_session"))
    return sessions.session_campaigns(rolled, c["stg_google_clicks"], ads)


@proof(
    "event_id:i method platform",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'click_id' WHEN event_type = 'signup' THEN 'utm' ELSE 'unattributed' END AS method,
       CASE event_type WHEN 'click' THEN 'google' WHEN 'view' THEN 'meta' WHEN 'signup' THEN 'newsletter' END AS platform FROM events""",
)
def attribution_rule(t: Tables) -> DataFrame:
    only = lambda kind, value: F.when(F.col("event_type") == kind, value)
    e = t.events.select("event_id", only("click", "g").alias("gclid"), only("view", "f").alias("fbclid"), only("signup", "Newsletter").alias("utm_source"))
    return e.select(
        "event_id", sessions.attribution_method(["gclid", "fbclid"], ["utm_source"]).alias("method"), sessions.attributed_platform(["gclid"], ["fbclid"], "utm_source").alias("platform")
    )


@proof("session_key", "SELECT session_key FROM z_sessions")
def exclude_internal(t: Tables) -> DataFrame:
    rolled = sessions.roll_up(Chain(t)["stg_ga4_events"])
    return rolled.filter(~F.col("is_internal_session")).select(sessions.session_key().alias("session_key"))


@proof("order_id is_test_order:b", "SELECT order_id, is_test_order FROM z_orders")
def quality_flags(t: Tables) -> DataFrame:
    c = Chain(t)
    return staging.crm_orders(flat(t, "raw_orders"), c["stg_crm_customers"])


@proof("event_fingerprint dt:d is_provisional:b arrived_late:b", "SELECT fp AS event_fingerprint, dt, event_date >= (SELECT max(event_date) - 1 FROM z_event_flat) AS is_provisional, event_date <> dt AS arrived_late FROM z_event_flat")
def provisional_flag(t: Tables) -> DataFrame:
    return staging.mark_provisional(staging.flat_events(Delivered(t)["ga4_events"]))


@proof("customer_id identity_hash identity_method", """
    SELECT customer_id, CASE WHEN o IS NOT NULL THEN o WHEN email_hash IS NOT NULL THEN email_hash ELSE phone_hash END AS identity_hash,
        CASE WHEN email_hash IS NOT NULL THEN 'email' WHEN o IS NOT NULL THEN 'phone_to_email_bridge' ELSE 'phone' END AS identity_method
    FROM (SELECT *, min(email_hash) OVER (PARTITION BY phone_hash) AS any_mail, CASE WHEN phone_hash IS NOT NULL THEN min(email_hash) OVER (PARTITION BY phone_hash) END AS o FROM z_customers)""")
def identity_bridge(t: Tables) -> DataFrame:
    return identity.bridge_identity(Chain(t)["stg_crm_customers"])


CTES["z_nodes"] = """SELECT 'c|' || customer_id AS a, 'e|' || email_hash AS b FROM z_customers WHERE email_hash IS NOT NULL UNION ALL SELECT 'c|' || customer_id, 'p|' || phone_hash FROM z_customers WHERE phone_hash IS NOT NULL"""


@proof(
    "customer_id component",
    """SELECT customer_id, coalesce(component, 'c|' || customer_id) AS component FROM z_customers LEFT JOIN (
        WITH RECURSIVE pairs AS (SELECT DISTINCT x.a AS l, y.a AS r FROM z_nodes x JOIN z_nodes y ON x.b = y.b),
        reach AS (SELECT DISTINCT l, l AS root FROM pairs UNION SELECT p.r, reach.root FROM reach JOIN pairs p ON p.l = reach.l)
        SELECT substr(l, 3) AS customer_id, min(root) AS component FROM reach GROUP BY 1) USING (customer_id)""",
)
def identity_components(t: Tables) -> DataFrame:
    return identity.people(Chain(t)["stg_crm_customers"])


@proof(
    "customer_id component",
    """SELECT customer_id, coalesce(component, 'c|' || customer_id) AS component FROM z_customers LEFT JOIN (
        WITH RECURSIVE pairs AS (SELECT DISTINCT x.a AS l, y.a AS r FROM z_nodes x JOIN z_nodes y ON x.b = y.b),
        reach AS (SELECT DISTINCT l, l AS root FROM pairs UNION SELECT p.r, reach.root FROM reach JOIN pairs p ON p.l = reach.l)
        SELECT substr(l, 3) AS customer_id, min(root) AS component FROM reach GROUP BY 1) USING (customer_id)""",
)
def identity_increment(t: Tables) -> DataFrame:
    """Three deliveries of customers, each contracted onto the labels of those before."""
    customers = Chain(t)["stg_crm_customers"]
    labels = identities.Labels(t.spark, scratch_path(t.spark, "labels"))
    for part in range(3):
        identities.add_customers(labels, customers.filter(F.pmod(F.xxhash64("customer_id"), F.lit(3)) == part))
    return identities.people_so_far(labels, customers)


@proof("customer_id dt:d source_file_name", "SELECT customer_id, dt, source_file_name FROM z_identity WHERE is_placeholder")
def late_dimension(t: Tables) -> DataFrame:
    c = Chain(t)
    genuine = c["stg_crm_orders"].filter(~F.col("is_test_order"))
    return identity.late_placeholders(genuine, c["stg_crm_customers"], "customer_id", ("dt", "updated_at_utc", "source_file_name"))


CTES["z_bought"] = "SELECT event_id AS order_id, ts AS order_ts, user_id, props FROM events WHERE event_type = 'purchase'"
CTES["z_visited"] = "SELECT event_id AS session_id, ts AS session_ts, user_id, CASE WHEN event_id % 3 = 0 THEN event_id // 2 END AS link FROM events WHERE event_type <> 'purchase'"
_PAIRS = """SELECT o.order_id, s.session_id, s.session_ts, s.link IS NOT DISTINCT FROM o.order_id AS named, s.user_id = o.user_id AND s.session_ts BETWEEN o.order_ts - INTERVAL 1 DAY AND o.order_ts + INTERVAL 1 HOUR AS near,
    abs(epoch_us(o.order_ts) - epoch_us(s.session_ts)) // 1000000 AS gap FROM z_bought o JOIN z_visited s
    ON s.link = o.order_id OR (s.user_id = o.user_id AND s.session_ts BETWEEN o.order_ts - INTERVAL 1 DAY AND o.order_ts + INTERVAL 1 HOUR)"""


def _orders_and_visits(t: Tables) -> tuple[DataFrame, DataFrame, dict]:
    bought = t.events.filter("event_type = 'purchase'").select(F.col("event_id").alias("order_id"), F.col("ts").alias("order_ts"), "user_id")
    link = F.when(F.col("event_id") % 3 == 0, F.expr("event_id div 2"))
    visited = t.events.filter("event_type <> 'purchase'").select(F.col("event_id").alias("session_id"), F.col("ts").alias("session_ts"), "user_id", link.alias("link"))
    return bought, visited, dict(order_id="order_id", order_at="order_ts", session_id="session_id", session_at="session_ts", person="user_id", link="link")


@proof(
    "order_id:i n_exact:i n_interval:i n_candidates:i",
    f"""SELECT order_id, count(*) FILTER (named) AS n_exact, count(*) FILTER (near) AS n_interval, count(session_id) AS n_candidates
        FROM z_bought LEFT JOIN ({_PAIRS}) p USING (order_id) GROUP BY 1""",
)
def or_interval_join(t: Tables) -> DataFrame:
    bought, visited, names = _orders_and_visits(t)
    return matching.candidate_counts(bought, visited, **names)


@proof(
    "order_id:i session_id:i exact_transaction_match:b distance_s:i",
    f"SELECT DISTINCT ON (order_id) order_id, session_id, named AS exact_transaction_match, gap AS distance_s FROM ({_PAIRS}) ORDER BY order_id, named DESC, gap, session_ts DESC, session_id DESC",
)
def best_match(t: Tables) -> DataFrame:
    bought, visited, names = _orders_and_visits(t)
    return matching.best_session(bought, visited, **names)


@proof(
    "c_custkey:i n:i spent:n2",
    """SELECT c_custkey, count(o_orderkey) AS n, coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS spent FROM customer LEFT JOIN orders ON o_custkey = c_custkey
       AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' + CAST(c_nationkey AS INT) AND DATE '1996-01-01' + CAST(c_nationkey AS INT) + 400 GROUP BY 1""",
)
def range_join(t: Tables) -> DataFrame:
    start = F.date_add(F.lit("1996-01-01").cast("date"), F.col("c_nationkey"))
    day = F.to_date("o_orderdate")
    joined = t.customer.join(t.orders, (F.col("o_custkey") == F.col("c_custkey")) & day.between(start, F.date_add(start, 400)), "left")
    return joined.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"), F.coalesce(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), F.lit(0)).alias("spent"))


@proof("dt:d n:i", "SELECT dt, count(*) AS n FROM raw_events WHERE dt >= (SELECT max(dt) - 2 FROM raw_events WHERE dt <= DATE '2024-01-20') GROUP BY 1")
def lookback_window(t: Tables) -> DataFrame:
    raw = flat(t, "raw_events")
    loaded = raw.filter(F.col("dt") <= F.lit("2024-01-20").cast("date"))
    return tables.lookback(raw, tables.high_water_mark(loaded), 3).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@proof(
    "event_fingerprint event_date:d transaction_id session_gclid session_source is_provisional:b dt:d source_file_name",
    "SELECT fp AS event_fingerprint, event_date, transaction_id, s_gclid AS session_gclid, s_source AS session_source, provisional AS is_provisional, dt, source_file_name FROM z_events",
)
def upsert_merge(t: Tables) -> DataFrame:
    """Two daily loads give the table a full refresh gives."""
    table = incremental.event_table(t.spark, scratch_path(t.spark, "events"))
    raw = Delivered(t)["ga4_events"]
    incremental.load_events(raw.filter(F.col("dt") <= F.lit("2024-01-15").cast("date")), table)
    incremental.load_events(raw, table)
    return table.read()


@proof(
    "version:i day:d rows:i price:n2",
    """SELECT 1 AS version, CAST(date_trunc('month', o_orderdate) AS DATE) AS day, count(*) AS rows, sum(o_totalprice) AS price
    FROM (SELECT DISTINCT ON (o_custkey) * FROM orders WHERE o_orderkey % 3 = 0 ORDER BY o_custkey, o_orderkey DESC) GROUP BY 2
    UNION ALL SELECT 2, CAST(date_trunc('month', o_orderdate) AS DATE), count(*), sum(o_totalprice)
    FROM (SELECT DISTINCT ON (o_custkey) * FROM orders WHERE o_orderkey % 3 < 2 ORDER BY o_custkey, o_orderkey DESC) GROUP BY 2
    UNION ALL SELECT 3, CAST(date_trunc('month', o_orderdate) AS DATE), count(*), sum(o_totalprice)
    FROM (SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_orderkey DESC) GROUP BY 2""",
)
def upsert_versions(t: Tables) -> DataFrame:
    """Three loads of each customer's latest order by month; every version is read after the last load."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "orders"), "day", [(["person"], None)])
    rows = t.orders.select(F.col("o_custkey").alias("person"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("newest"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("day"))
    for part in range(3):
        tables.upsert(rows.filter(F.col("newest") % 3 == part), table, ["person"], "day", ["newest"])
    each = [table.read(v).select(F.lit(v).alias("version"), "day", "price") for v in table.versions()]
    return each[0].union(each[1]).union(each[2]).groupBy("version", "day").agg(F.count(F.lit(1)).alias("rows"), F.sum("price").alias("price"))


@proof(
    "person:i price:n2 newest:i day:d",
    """SELECT DISTINCT ON (o_custkey) o_custkey AS person, o_totalprice AS price, o_orderkey AS newest, CASE WHEN o_orderkey % 4 > 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS day
    FROM orders ORDER BY o_custkey, o_orderkey DESC""",
)
def upsert_null_partition(t: Tables) -> DataFrame:
    """Two loads of each customer's latest order; every fourth order has no day."""
    path = scratch_path(t.spark, "orders")
    day = F.when(F.col("o_orderkey") % 4 > 0, F.to_date(F.date_trunc("month", "o_orderdate")))
    rows = t.orders.select(F.col("o_custkey").alias("person"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("newest"), day.alias("day"))
    for part in (F.col("newest") % 3 == 0, F.col("newest") % 3 > 0):
        tables.upsert(rows.filter(part), path, ["person"], "day", ["newest"])
    return t.spark.read.parquet(path)


@proof("customer_key order_id session_key", "SELECT customer_key, order_id, session_key FROM z_attributed WHERE session_key IS NULL")
def unattributed_orders(t: Tables) -> DataFrame:
    c = Chain(t)
    rows = conformed.orders_attributed(c["stg_crm_orders"], c["int_customer_identity"], c["int_sessions"])
    return rows.filter(F.col("session_key").isNull())
