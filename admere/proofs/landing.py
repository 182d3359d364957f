"""Delivered tables derived from the driver tables.

The driver tables hold no marketing data, so their rows are dressed up as the
deliveries of the pipeline: customers as CRM customers, orders as CRM orders,
events as web events, lineitem by supplier and day as ad performance, suppliers as
ads. Every row of the driver table takes part. Defects (late and re-sent rows,
truncated lines, odd spellings, repeated purchases) are derived from column values.

Scalar expressions are written once for both engines; the pipeline then reads them
packed as nested events, comma lines, JSON lines and documents, the SQL reads them
flat.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.proofs.registry import CTES, Tables
from admere.session import scratch_path
from admere.sources.schemas import CITIES
from admere.sources.tables import write_full

INTERNAL_DOMAIN = "qa.example"


class Spark:
    days = staticmethod(lambda d: f"datediff(CAST({d} AS DATE), DATE '1995-01-01')")
    plus = staticmethod(lambda d, n: f"date_add({d}, CAST({n} AS INT))")
    div = staticmethod(lambda a, b: f"({a}) div ({b})")
    micros = staticmethod(lambda t: f"unix_micros({t})")
    instant = staticmethod(lambda m: f"timestamp_micros({m})")
    text = staticmethod(lambda t: f"date_format({t}, 'yyyy-MM-dd HH:mm:ss')")
    compact = staticmethod(lambda d: f"date_format({d}, 'yyyyMMdd')")
    key = staticmethod(lambda j: f"CAST(get_json_object({j}, '$.k') AS BIGINT)")


class Duck:
    days = staticmethod(lambda d: f"datediff('day', DATE '1995-01-01', CAST({d} AS DATE))")
    plus = staticmethod(lambda d, n: f"CAST({d} + CAST({n} AS INT) AS DATE)")
    div = staticmethod(lambda a, b: f"({a}) // ({b})")
    micros = staticmethod(lambda t: f"epoch_us({t})")
    instant = staticmethod(lambda m: f"make_timestamp({m})")
    text = staticmethod(lambda t: f"strftime({t}, '%Y-%m-%d %H:%M:%S')")
    compact = staticmethod(lambda d: f"strftime({d}, '%Y%m%d')")
    key = staticmethod(lambda j: f"CAST(json_extract_string({j}, '$.k') AS BIGINT)")


DAY_US = 86_400_000_000
START = "DATE '2024-01-01'"
START_US = 1_704_067_200_000_000


def cents_text(c: str, e) -> str:
    return f"concat(CAST({e.div(c, 100)} AS STRING), '.', lpad(CAST(({c}) % 100 AS STRING), 2, '0'))"


# --- CRM customers -----------------------------------------------------------

_CITY_BY_NATION = {
    0: " Cape_Town ", 1: "CPT", 2: "Kaapstad", 3: "cape-town", 5: "JHB", 6: "jozi", 8: "joburg", 10: "DURBS", 11: "eThekwini", 12: "dbn", 24: "Pretoria",
}


def customer_fields(e) -> dict[str, str]:
    pair = e.div("c_custkey", 2)
    digits = f"CAST(820000000 + {pair} AS STRING)"
    created = f"{e.instant(f'{START_US} + (c_custkey % 45 - 31) * {DAY_US} + (c_custkey * 7919 % 86400) * 1000000')}"
    cities = " ".join(f"WHEN c_nationkey = {n} THEN '{c}'" for n, c in _CITY_BY_NATION.items())
    return {
        "customer_id": "CASE WHEN c_nationkey < 5 THEN concat(' C', CAST(c_custkey AS STRING), ' ') ELSE concat('C', CAST(c_custkey AS STRING)) END",
        "email": f"""CASE WHEN c_acctbal < 0 THEN ' '
            WHEN c_acctbal > 9500 THEN concat('qa', CAST(c_custkey AS STRING), '@{INTERNAL_DOMAIN}')
            WHEN c_mktsegment = 'MACHINERY' THEN concat('  USER', CAST({pair} AS STRING), '@Example.COM ')
            ELSE concat('user', CAST(c_custkey AS STRING), '@example.com') END""",
        "first_name": "c_name",
        "last_name": "c_mktsegment",
        "phone": f"""CASE WHEN c_nationkey < 6 THEN concat('0027', {digits})
            WHEN c_nationkey < 12 THEN concat('+27 ', substring({digits}, 1, 2), ' ', substring({digits}, 3, 3), '-', substring({digits}, 6, 4))
            WHEN c_nationkey < 18 THEN concat('0', {digits})
            WHEN c_nationkey < 23 THEN {digits} ELSE 'none' END""",
        "city": f"CASE {cities} WHEN c_nationkey < 5 OR c_nationkey > 20 THEN 'Cape Town' WHEN c_nationkey < 14 THEN 'Johannesburg' ELSE 'Durban' END",
        "created_at": e.text(created),
        "is_guest": "CASE WHEN c_nationkey = 24 THEN 'yes' WHEN c_acctbal < 3000 THEN 'true' ELSE 'False' END",
        "marketing_opt_in": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'true' WHEN c_mktsegment = 'AUTOMOBILE' THEN '' ELSE 'false' END",
        "dt": e.plus(f"CAST({created} AS DATE)", "CASE WHEN c_nationkey = 9 THEN 3 ELSE 0 END"),
    }


def _source(path: str) -> str:
    folder, name = path.split("|")
    return f"concat('/{folder}/dt=', CAST(dt AS STRING), '/{name}')"


def _select(fields: dict[str, str], source: str, where: str = "") -> str:
    return "SELECT " + ", ".join(f"{x} AS {n}" for n, x in fields.items()) + f" FROM {source} {where}"


def _customers(e) -> str:
    # Furniture customers are delivered again ten days later from another city.
    first = customer_fields(e)
    again = dict(first, city="'Durban'", dt=e.plus(first["dt"], 10))
    both = _select(first, "customer") + " UNION ALL " + _select(again, "customer", "WHERE c_mktsegment = 'FURNITURE'")
    return f"SELECT *, {_source('crm|customers.csv')} AS source_file_name FROM ({both}) AS d"


# --- CRM orders --------------------------------------------------------------


def order_fields(e) -> dict[str, str]:
    day = e.div(e.days("o_orderdate"), 20)
    placed = f"{START_US} + ({day}) * {DAY_US} + (o_orderkey * 7919 % 86400) * 1000000"
    cents = "CAST(round(o_totalprice * 100) AS BIGINT)"
    off = f"(CASE WHEN o_orderpriority = '3-MEDIUM' THEN {e.div(cents, 10)} ELSE 0 END)"
    return {
        "order_id": "concat('O', CAST(o_orderkey AS STRING))",
        "customer_id": """CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN concat('X', CAST(o_custkey AS STRING))
            ELSE concat('C', CAST(o_custkey AS STRING)) END""",
        "order_ts": e.text(e.instant(placed)),
        "currency": "' ZAR'",
        "subtotal": cents_text(cents, e),
        "discount": f"CASE WHEN o_orderstatus = 'O' AND {off} = 0 THEN '' ELSE {cents_text(off, e)} END",
        "revenue": f"CASE WHEN o_totalprice < 5000 THEN '1.00' ELSE {cents_text(f'{cents} - {off}', e)} END",
        "status": "CASE WHEN o_orderstatus = 'O' THEN ' Completed ' ELSE 'completed' END",
        "item_count": "CAST(o_orderkey % 7 + 1 AS STRING)",
        "updated_at": e.text(e.instant(placed)),
        "dt": f"CAST({e.instant(placed)} AS DATE)",
    }


def _orders(e) -> str:
    first = order_fields(e)
    later = e.instant(f"{e.micros('CAST(order_ts AS TIMESTAMP)')} + 5 * {DAY_US}")
    names = [n for n in first if n not in ("status", "updated_at", "dt")]
    refund = f"SELECT {', '.join(names)}, 'refunded' AS status, {e.text(later)} AS updated_at, CAST({later} AS DATE) AS dt FROM placed WHERE o_orderstatus = 'P'"
    columns = ", ".join([*names, "status", "updated_at", "dt"])
    placed = f"SELECT {', '.join(f'{x} AS {n}' for n, x in first.items())}, o_orderstatus, o_orderpriority FROM orders"
    both = f"SELECT {columns} FROM placed UNION ALL SELECT {columns} FROM placed WHERE o_orderpriority = '2-HIGH' UNION ALL {refund}"
    return f"WITH placed AS ({placed}) SELECT *, {_source('crm|orders.csv')} AS source_file_name FROM ({both}) AS d"


def _items(e) -> str:
    fields = {
        "order_id": "concat('O', CAST(l_orderkey AS STRING))",
        "sku": "concat('P', CAST(l_partkey AS STRING))",
        "product_name": "CASE WHEN l_linestatus = 'F' THEN ' ' ELSE concat('part ', CAST(l_partkey AS STRING)) END",
        "unit_price": cents_text("CAST(round(l_extendedprice * 100) AS BIGINT)", e),
        "quantity": "CAST(CAST(l_quantity AS BIGINT) AS STRING)",
        "dt": e.plus(START, f"{e.div(e.days('l_shipdate'), 20)}"),
    }
    # The line number is the file: it makes the newest line of a repeated product unique.
    inner = _select(dict(fields, n="l_linenumber", raw_cents="CAST(round(l_extendedprice * 100) AS BIGINT)"), "lineitem")
    path = "concat('/crm/dt=', CAST(dt AS STRING), '/order_items-', CAST(n AS STRING), '-', lpad(CAST(raw_cents AS STRING), 12, '0'), '.csv')"
    return f"SELECT order_id, sku, product_name, unit_price, quantity, dt, {path} AS source_file_name FROM ({inner}) AS d"


# --- Web events --------------------------------------------------------------


def _events(e) -> str:
    k = e.key("props")
    us = e.micros("ts")
    local = f"CAST({e.instant(f'{us} + 2 * 3600000000')} AS DATE)"
    eid = "CAST(event_id AS STRING)"
    even, odd = f"2 * ({e.div('k', 2)})", f"2 * ({e.div('k', 2)}) + 1"
    base = f"SELECT event_id, {k} AS k, {us} AS us, {local} AS local_day, user_id, event_type, value FROM events"
    fields = {
        "event_date": e.compact("local_day"),
        "event_timestamp": "us",
        "event_name": """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'session_start'
            WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'begin_checkout' ELSE event_type END""",
        "user_pseudo_id": "concat('u', CAST(user_id AS STRING))",
        "ga_session_id": f"CAST({e.compact('local_day')} AS BIGINT)",
        "page_location": f"""concat('https://shop.example.com/p/', CAST(k AS STRING), CASE
            WHEN event_type <> 'click' THEN ''
            WHEN k < 30 THEN concat('?ref=x&GCLID=g', {eid})
            WHEN k < 45 THEN concat('?fbclid=f', {eid}, '&utm_source=Facebook&utm_content=ad', CAST({odd} AS STRING), '#top')
            WHEN k < 60 THEN concat('?utm_source=Newsletter&utm_medium=email&utm_campaign=spring', CAST(k AS STRING))
            WHEN k < 65 THEN concat('?srsltid=s', {eid}, '#x') ELSE '' END)""",
        "field_gclid": f"CASE WHEN event_type = 'view' AND k < 3 THEN concat('G', {eid}) END",
        "field_campaign_id": f"CASE WHEN event_type = 'signup' AND k < 8 THEN concat('G', CAST(({even}) % 25 AS STRING)) END",
        "field_source": "CASE WHEN event_type = 'signup' AND k < 8 THEN 'google' END",
        "order_field": f"CASE WHEN event_type = 'purchase' AND k < 50 THEN concat('O', CAST({e.div('event_id', 3)} AS STRING)) END",
        "order_parameter": f"CASE WHEN event_type = 'purchase' AND k BETWEEN 50 AND 97 THEN concat('O', CAST({e.div('event_id', 3)} AS STRING)) END",
        "value_double": "CASE WHEN k < 40 THEN value * (CASE WHEN k < 5 THEN 100 ELSE 1 END) END",
        "value_float": "CASE WHEN k >= 70 THEN value END",
        "value_int": "CASE WHEN k BETWEEN 30 AND 75 THEN CAST(floor(value) AS BIGINT) END",
        "traffic_type": "CASE WHEN event_type = 'error' AND k > 96 THEN 'Internal' WHEN k = 50 THEN 'partner' END",
        "engagement_time_msec": "CASE WHEN event_type <> 'error' THEN k * 100 END",
        "device_category": "CASE WHEN k > 90 THEN NULL WHEN user_id % 3 = 0 THEN 'desktop' ELSE 'mobile' END",
        "operating_system": "CASE WHEN user_id % 3 = 0 THEN 'Windows' WHEN k < 50 THEN 'Android' ELSE 'iOS' END",
        "city": "CASE WHEN k < 5 THEN NULL WHEN user_id % 4 = 0 THEN 'Cape Town' WHEN user_id % 4 = 1 THEN 'Johannesburg' WHEN user_id % 4 = 2 THEN 'Durban' ELSE 'Pretoria' END",
        "dt": e.plus("local_day", "CASE WHEN k BETWEEN 10 AND 14 THEN 1 WHEN k = 15 THEN 2 ELSE 0 END"),
    }
    flat = _select(fields, "base")
    again = _select(dict(fields, dt=e.plus("local_day", 1)), "base", "WHERE k BETWEEN 20 AND 24")
    return f"WITH base AS ({base}) SELECT *, {_source('ga4|events.ndjson.gz')} AS source_file_name FROM ({flat} UNION ALL {again}) AS d"


def _clicks(e) -> str:
    k = e.key("props")
    inner = f"SELECT event_id, {k} AS k, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click'"
    ad = f"2 * ({e.div('k', 2)})"
    fields = {
        "segments_date": "CAST(day AS STRING)",
        "click_view_gclid": "concat(CASE WHEN k < 30 THEN 'g' ELSE 'other' END, CAST(event_id AS STRING))",
        "campaign_id": f"concat('G', CAST(({ad}) % 25 AS STRING))",
        "ad_group_id": "' '",
        "ad_group_ad_ad_id": f"concat('ad', CAST({ad} AS STRING))",
        "click_view_area_of_interest_city": "CASE WHEN k < 50 THEN 'Durban ' ELSE '' END",
        "dt": e.plus("day", 1),
    }
    return f"SELECT *, {_source('google_ads|click_view.csv')} AS source_file_name FROM ({_select(fields, f'({inner}) AS c')}) AS d"


# --- Ad platforms, rates, weather, copy --------------------------------------


def _ad_days(e) -> str:
    return f"""SELECT {e.plus(START, e.div(e.days('l_shipdate'), 20))} AS day, l_suppkey AS ad,
        {e.div(e.days('l_shipdate'), 20)} AS n_day,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS impressions, count(*) AS clicks,
        CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
        CAST(sum(l_linenumber) AS BIGINT) AS all_conversions,
        CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS conversions,
        CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS claimed_cents
        FROM lineitem GROUP BY 1, 2, 3"""


def _rates(e) -> str:
    weekday = "dayofweek(day) BETWEEN 2 AND 6" if e is Spark else "isodow(day) < 6"
    return f"""SELECT CAST(day AS STRING) AS rate_date, ' USD' AS base_currency, 'ZAR' AS quote_currency,
        concat(CAST({e.div('rate', 100)} AS STRING), '.', lpad(CAST(rate % 100 AS STRING), 2, '0')) AS rate, day AS dt,
        concat('/fx_rates/dt=', CAST(day AS STRING), '/usd_zar.csv') AS source_file_name
        FROM (SELECT {e.plus(START, e.div(e.days('l_shipdate'), 20))} AS day, 1500 + count(*) % 500 AS rate FROM lineitem GROUP BY 1) AS r
        WHERE {weekday}"""


def _weather_days(e) -> str:
    cities = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CITIES))
    return f"""SELECT CASE city_no {cities} END AS city, day, 20 + n % 15 + 0.5 AS hi, 5 + n % 10 AS lo, (cents % 100) / 10.0 AS rain
        FROM (SELECT o_custkey % 3 AS city_no, {e.plus(START, e.div(e.days('o_orderdate'), 20))} AS day, count(*) AS n,
              CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1, 2) AS w"""


def _copy(e) -> str:
    n, ad = "s_nationkey", "CAST(s_suppkey AS STRING)"
    fields = {
        "raw_line": f"""CASE WHEN {n} < 5 THEN 'Last chance! Karoo fleece 20% off. Shop now.'
            WHEN {n} < 10 THEN 'Made for the wind: Cederberg hiking boots. Learn more.'
            WHEN {n} < 15 THEN 'Some trails change you. Table Mountain daypack, claim the offer.'
            WHEN {n} < 20 THEN concat('Hello ', s_name, ', 5%  OFF today') ELSE 'Stay dry' END""",
        "ad": ad,
        "dt": f"{e.plus(START, n)}",
    }
    again = dict(fields, raw_line="'Ends Sunday: Drakensberg shell jacket 35% off. Shop now.'", dt=e.plus(START, f"{n} + 7"))
    blank = dict(fields, raw_line="'  '", dt=e.plus(START, f"{n} + 30"))
    both = _select(fields, "supplier") + " UNION ALL " + _select(again, "supplier", "WHERE s_acctbal > 5000") + " UNION ALL " + _select(blank, "supplier")
    return f"SELECT raw_line, dt, concat('/creatives/dt=', CAST(dt AS STRING), '/ad_ad', ad, '/copy.txt') AS source_file_name FROM ({both}) AS d"


RELATIONS = {
    "raw_customers": (_customers, "customer"),
    "raw_orders": (_orders, "orders"),
    "raw_items": (_items, "lineitem"),
    "raw_events": (_events, "events"),
    "raw_clicks": (_clicks, "events"),
    "raw_ad_days": (_ad_days, "lineitem"),
    "raw_rates": (_rates, "lineitem"),
    "raw_weather": (_weather_days, "orders"),
    "raw_copy": (_copy, "supplier"),
}
for _name, (_make, _table) in RELATIONS.items():
    CTES[_name] = _make(Duck)


def flat(t: Tables, name: str) -> DataFrame:
    """A derived relation in flat form."""
    make, table = RELATIONS[name]
    sql = re.sub(rf"\bFROM {table}\b", f"FROM {{{table}}}", make(Spark))
    sql = re.sub(r"\{(?!%s\})" % table, "{{", sql)
    return t.spark.sql(sql, **{table: getattr(t, table)})


def web_events(t: Tables) -> DataFrame:
    """Flat events packed in the nested shape of the web export, parameter order varied by row."""
    e = flat(t, "raw_events")
    value = lambda s=None, i=None, f=None, d=None: F.struct(
        (s if s is not None else F.lit(None)).cast("string").alias("string_value"),
        (i if i is not None else F.lit(None)).cast("bigint").alias("int_value"),
        (f if f is not None else F.lit(None)).cast("double").alias("float_value"),
        (d if d is not None else F.lit(None)).cast("double").alias("double_value"),
    )
    parameter = lambda key, **slot: F.struct(F.lit(key).alias("key"), value(**slot).alias("value"))
    parameters = [
        parameter("ga_session_id", i=F.col("ga_session_id")),
        parameter("page_location", s=F.col("page_location")),
        parameter("traffic_type", s=F.col("traffic_type")),
        parameter("engagement_time_msec", i=F.col("engagement_time_msec")),
        parameter("transaction_id", s=F.col("order_parameter")),
        parameter("value", i=F.col("value_int"), f=F.col("value_float"), d=F.col("value_double")),
        parameter("currency", s=F.lit("ZAR")),
    ]
    forward, backward = F.array(*parameters), F.array(*reversed(parameters))
    none = F.lit(None).cast("string")
    return e.select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id",
        F.when(F.col("event_timestamp") % 2 == 0, forward).otherwise(backward).alias("event_params"),
        F.struct(F.col("device_category").alias("category"), "operating_system").alias("device"),
        F.struct(F.lit("ZA").alias("country"), "city").alias("geo"),
        F.struct(
            F.col("field_campaign_id").alias("manual_campaign_id"), none.alias("manual_campaign_name"),
            F.col("field_source").alias("manual_source"), none.alias("manual_medium"), none.alias("manual_term"),
            none.alias("manual_content"), F.col("field_gclid").alias("gclid"), none.alias("dclid"), none.alias("srsltid"),
        ).alias("collected_traffic_source"),
        F.struct(
            F.col("order_field").alias("transaction_id"), F.lit(None).cast("double").alias("purchase_revenue"),
            F.lit(1).cast("bigint").alias("total_item_quantity"),
        ).alias("ecommerce"),
        F.array().cast("array<struct<item_id:string,item_name:string,price:double,quantity:bigint>>").alias("items"),
        "dt", "source_file_name",
    )


CHANGE_DAY = 60


def _campaign_name(platform: str) -> str:
    return f"CASE WHEN ad % 25 < 5 AND n_day >= {CHANGE_DAY} THEN concat('{platform} campaign ', CAST(ad % 25 AS STRING), ' new') ELSE concat('{platform} campaign ', CAST(ad % 25 AS STRING)) END"


def google_lines(t: Tables) -> DataFrame:
    """Even suppliers as comma lines; one more column from the change day on."""
    d = flat(t, "raw_ad_days").filter("ad % 2 = 0").withColumn("dt", F.date_add("day", 1))
    late = F.col("n_day") >= CHANGE_DAY
    old_header = "segments_date,customer_id,campaign_id,campaign_name,ad_group_id,ad_group_name,ad_group_ad_ad_id,metrics_impressions,metrics_clicks,metrics_cost_micros,metrics_conversions,metrics_conversions_value"
    new_header = old_header.replace("metrics_conversions,", "metrics_all_conversions,metrics_conversions,", 1)
    text = lambda c: F.col(c).cast("string")
    line = F.concat_ws(
        ",", text("day"), F.lit("acc1"), F.expr("concat('G', ad % 25)"), F.expr(_campaign_name("google")), F.expr("concat('grp', ad % 5)"), F.lit(" "),
        F.expr("concat('ad', ad)"), text("impressions"), text("clicks"), F.expr("CAST(cents * 10000 AS STRING)"),
        F.when(late, text("all_conversions")), text("conversions"), F.expr(cents_text("claimed_cents", Spark)),
    )
    path = F.concat(F.lit("/google_ads/dt="), text("dt"), F.lit("/ad_performance.csv")).alias("source_file_name")
    data = d.select(line.alias("raw_line"), "dt", path)
    headers = d.select("dt", F.when(late, new_header).otherwise(old_header).alias("raw_line")).distinct()
    blank = headers.select(F.lit("").alias("raw_line"), "dt", path)
    return data.unionByName(headers.select("raw_line", "dt", path)).unionByName(blank)


def meta_lines(t: Tables) -> DataFrame:
    """Odd suppliers as JSON lines: a first pull with half the numbers, then the full one. Some first pulls are cut off."""
    d = flat(t, "raw_ad_days").filter("ad % 2 = 1")
    pulls = d.withColumn("pull", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("dt", F.expr("date_add(day, pull)"))
    part = lambda c: F.expr(f"CASE WHEN pull = 1 THEN {c} div 2 ELSE {c} END")
    as_cents = lambda c: F.expr(cents_text(f"(CASE WHEN pull = 1 THEN {c} div 2 ELSE {c} END)", Spark))
    purchase = "offsite_conversion.fb_pixel_purchase"
    action = lambda kind, v: F.struct(F.lit(kind).alias("action_type"), v.cast("string").alias("value"))
    line = F.to_json(
        F.struct(
            F.lit("act1").alias("account_id"), F.lit("USD").alias("account_currency"),
            F.col("day").cast("string").alias("date_start"), F.col("day").cast("string").alias("date_stop"),
            F.expr("concat('M', ad % 25)").alias("campaign_id"), F.expr(_campaign_name("meta")).alias("campaign_name"),
            F.expr("concat('set', ad % 5)").alias("adset_id"), F.lit("").alias("adset_name"),
            F.expr("concat('ad', ad)").alias("ad_id"), F.expr("concat('Ad ', ad)").alias("ad_name"),
            part("impressions").cast("string").alias("impressions"), part("clicks").cast("string").alias("clicks"),
            as_cents("cents").alias("spend"),
            F.array(action("link_click", part("clicks")), action(purchase, part("conversions"))).alias("actions"),
            F.when(F.col("claimed_cents") > 0, F.array(action(purchase, as_cents("claimed_cents")))).alias("action_values"),
            F.lit("7d_click").alias("attribution_setting"),
            F.expr("concat(CAST(dt AS STRING), ' 06:00:00')").alias("_pulled_at"),
        )
    )
    cut = (F.col("pull") == 1) & (F.col("ad") % 25 == 7)
    return pulls.select(
        F.when(cut, line.substr(F.lit(1), F.length(line) - 10)).otherwise(line).alias("raw_line"),
        "dt",
        F.concat(F.lit("/meta_ads/dt="), F.col("dt").cast("string"), F.lit("/insights.jsonl")).alias("source_file_name"),
    )


def weather_documents(t: Tables) -> DataFrame:
    """City weeks and city months as documents of parallel arrays; the month restates the weeks."""
    d = flat(t, "raw_weather").withColumn("hi", F.col("hi").cast("double")).withColumn("lo", F.col("lo").cast("double")).withColumn("rain", F.col("rain").cast("double"))

    def documents(start: str, delivered: str) -> DataFrame:
        packed = d.groupBy("city", F.expr(start).alias("start")).agg(
            # At most 31 days per city and month.
            F.sort_array(F.collect_list(F.struct("day", "hi", "lo", "rain"))).alias("days")
        )
        return packed.select("city", "days", F.expr(delivered).alias("dt"))

    both = documents("trunc(day, 'WEEK')", "date_add(start, 7)").unionByName(documents("trunc(day, 'MONTH')", "date_add(start, 32)"))
    stem = F.lower(F.replace("city", F.lit(" "), F.lit("_")))
    each = lambda f: F.transform("days", f)
    return both.select(
        F.lit(-30.0).alias("latitude"), F.lit(25.0).alias("longitude"), F.lit(10.0).alias("elevation"), F.lit("Africa/Johannesburg").alias("timezone"),
        F.struct(
            each(lambda x: x["day"].cast("string")).alias("time"),
            each(lambda x: x["hi"]).alias("temperature_2m_max"),
            each(lambda x: x["lo"]).alias("temperature_2m_min"),
            each(lambda x: x["rain"]).alias("precipitation_sum"),
        ).alias("daily"),
        "dt",
        F.concat(F.lit("/weather/dt="), F.col("dt").cast("string"), F.lit("/"), stem, F.lit(".json")).alias("source_file_name"),
    )


_LANDED: dict[tuple[str, str], dict[str, str]] = {}


class Delivered(dict):
    """The ten delivered tables. Each is landed as files on first use and kept for the session."""

    MAKERS = {
        "google_ads_performance_raw": google_lines,
        "google_ads_clicks": lambda t: flat(t, "raw_clicks"),
        "meta_ads_insights_raw": meta_lines,
        "ga4_events": web_events,
        "crm_customers": lambda t: flat(t, "raw_customers"),
        "crm_orders": lambda t: flat(t, "raw_orders"),
        "crm_order_items": lambda t: flat(t, "raw_items"),
        "creative_copy_raw": lambda t: flat(t, "raw_copy"),
        "weather_daily": weather_documents,
        "fx_rates": lambda t: flat(t, "raw_rates"),
    }

    def __init__(self, t: Tables):
        super().__init__()
        self.t = t
        self.landed = _LANDED.setdefault((t.spark.sparkContext.applicationId, t.sf_dir), {})

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.landed:
            path = scratch_path(self.t.spark, f"landed-{name}")
            write_full(self.MAKERS[name](self.t), path)
            self.landed[name] = path
        self[name] = self.t.spark.read.parquet(self.landed[name])
        return self[name]
