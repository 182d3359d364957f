"""Casts, cleaning, dates, JSON, URLs, text rules, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.functions import clean, creative, nested, values
from admere.operators.spread import date_spine, forward_fill, one_bounds, with_scalars
from admere.plans import staging, star
from admere.proofs.landing import Delivered, flat
from admere.proofs.registry import CTES, Tables, proof
from admere.session import scratch_path
from admere.sources import files, schemas
from admere.sources.tables import write_full


@proof(
    "customer_id phone:i is_guest:b created_at:t city:d first_name:i",
    """SELECT customer_id, try_cast(phone AS BIGINT) AS phone, CASE lower(is_guest) WHEN 'true' THEN true WHEN 'false' THEN false END AS is_guest,
       try_cast(created_at AS TIMESTAMP) AS created_at, try_cast(city AS DATE) AS city, try_cast(substr(first_name, 10) AS BIGINT) AS first_name,
       CASE k WHEN 0 THEN DATE '2024-01-05' WHEN 1 THEN DATE '2024-02-29' END AS day,
       CASE k WHEN 0 THEN TIMESTAMP '2024-01-05 00:00:00' WHEN 1 THEN TIMESTAMP '2024-02-29 00:00:00' WHEN 2 THEN TIMESTAMP '2024-01-05 10:00:00' WHEN 3 THEN TIMESTAMP '2024-01-05 08:00:00' END AS at
       FROM (SELECT *, CAST(substr(first_name, 10) AS BIGINT) % 10 AS k FROM raw_customers)""",
)
def safe_cast(t: Tables) -> DataFrame:
    c = flat(t, "raw_customers")
    # Two whole dates, two whole instants, and what must not be read as either.
    shapes = ["2024-01-05", " 2024-02-29 ", "2024-01-05 10:00:00", "2024-01-05T10:00:00+02:00", "10:00", "2024", "2024-01", "2024-01-05 junk", "2024-02-30", "05.01.2024"]
    written = F.get(F.array(*map(F.lit, shapes)), (F.col("first_name").substr(10, 20).cast("bigint") % 10).cast("int"))
    return c.select(
        "customer_id", clean.safe_cast("phone", "bigint").alias("phone"), clean.safe_cast("is_guest", "boolean").alias("is_guest"),
        clean.safe_cast("created_at", "timestamp").alias("created_at"), clean.safe_cast("city", "date").alias("city"),
        clean.safe_cast(F.col("first_name").substr(10, 20), "bigint").alias("first_name"),
        clean.safe_cast(written, "date").alias("day"), clean.safe_cast(written, "timestamp").alias("at"),
    )


@proof("customer_id email marketing_opt_in", "SELECT trim(customer_id) AS customer_id, nullif(trim(email), '') AS email, nullif(trim(marketing_opt_in), '') AS marketing_opt_in FROM raw_customers")
def blank_to_null(t: Tables) -> DataFrame:
    return flat(t, "raw_customers").select(*[clean.blank_to_null(c).alias(c) for c in ("customer_id", "email", "marketing_opt_in")])


@proof("p_partkey:i p_name p_brand p_size:i", "SELECT * EXCLUDE (p_type, p_retailprice) FROM part")
def star_except(t: Tables) -> DataFrame:
    return clean.drop_columns(t.part, "p_type", "p_retailprice")


@proof(
    "p_partkey:i lowered second_word starts ends middle length:i digits brand_no:i digest",
    """SELECT p_partkey, lower(p_brand) AS lowered, split_part(p_name, ' ', 2) AS second_word, CAST(starts_with(p_name, 'small') AS VARCHAR) AS starts, CAST(ends_with(p_name, 't') AS VARCHAR) AS ends,
       substr(p_type, 2, 3) AS middle, length(p_name) AS length, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits, CAST(regexp_extract(p_brand, '#(\\d+)$', 1) AS BIGINT) AS brand_no, sha256(p_name) AS digest FROM part""",
)
def scalar_strings(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.lower("p_brand").alias("lowered"), F.get(F.split("p_name", " "), F.lit(1)).alias("second_word"),
        F.col("p_name").startswith("small").cast("string").alias("starts"), F.col("p_name").endswith("t").cast("string").alias("ends"),
        F.substring("p_type", 2, 3).alias("middle"), F.length("p_name").alias("length"), F.regexp_replace("p_brand", "[^0-9]", "").alias("digits"),
        clean.safe_cast(clean.first_match("p_brand", r"#(\d+)$"), "bigint").alias("brand_no"), clean.pseudonym("p_name").alias("digest"),
    )


@proof(
    "o_orderkey:i day:d plus_week:d week:d month:d age:i y:i q:i m:i d:i iso:i dow:i text parsed:d seconds:i",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) + 7 AS plus_week, date_trunc('week', o_orderdate) AS week, date_trunc('month', o_orderdate) AS month,
       datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, day(o_orderdate) AS d, weekofyear(o_orderdate) AS iso,
       dayofweek(o_orderdate) + 1 AS dow, strftime(o_orderdate, '%Y%m%d') AS text, CAST(o_orderdate AS DATE) AS parsed, datediff('second', o_orderdate, o_orderdate + INTERVAL 90 MINUTE) AS seconds FROM orders""",
)
def scalar_dates(t: Tables) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    d = F.to_date(at)
    text = F.date_format(d, "yyyyMMdd")
    return t.orders.select(
        "o_orderkey", d.alias("day"), F.date_add(d, 7).alias("plus_week"), values.week_start(d).alias("week"), F.trunc(d, "MONTH").alias("month"),
        F.datediff(F.lit("2002-01-01").cast("date"), d).alias("age"), F.year(d).alias("y"), F.quarter(d).alias("q"), F.month(d).alias("m"), F.day(d).alias("d"),
        F.weekofyear(d).alias("iso"), F.dayofweek(d).alias("dow"), text.alias("text"), values.compact_date(text).alias("parsed"),
        F.timestamp_diff("SECOND", at, at + F.expr("INTERVAL 90 MINUTES")).alias("seconds"),
    )


@proof("event_id:i local:d", "SELECT event_id, CAST(ts + INTERVAL 2 HOUR AS DATE) AS local FROM events")
def local_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", values.local_date("ts").alias("local"))


@proof(
    "event_id:i happened:t day:d money:n6",
    "SELECT event_id, ts AS happened, CAST(ts AS DATE) AS day, epoch_us(ts) / 1000000 AS money FROM events",
)
def unit_convert(t: Tables) -> DataFrame:
    micros = F.unix_micros("ts")
    return t.events.select(
        "event_id", values.micros_to_timestamp(micros).alias("happened"), values.compact_date(F.date_format("ts", "yyyyMMdd")).alias("day"),
        values.micros_to_money(micros).alias("money"),
    )


@proof("event_id:i k:i missing whole", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.z') AS missing, replace(props, ' ', '') AS whole FROM events")
def scalar_json(t: Tables) -> DataFrame:
    payload = F.try_parse_json("props")
    return t.events.select(
        "event_id", nested.json_number(payload, "$.k", "bigint").alias("k"), nested.json_text(payload, "$.z").alias("missing"), F.to_json(payload).alias("whole")
    )


_insight = "concat('{{\"ad_id\":\"', {id}, '\",\"impressions\":\"', {k}, '\",\"spend\":\"', {k}, '.25\",\"name\":\"\",\"date_start\":\"2024-01-', {day}, '\"}}')"


@proof(
    "event_id:i ad_id impressions:i spend:n2 name day:d",
    """SELECT event_id, CAST(event_id AS VARCHAR) AS ad_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS impressions, CAST(json_extract_string(props, '$.k') AS BIGINT) + 0.25 AS spend, CAST(NULL AS VARCHAR) AS name,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 10 AND 31 THEN DATE '2024-01-01' + CAST(json_extract_string(props, '$.k') AS INT) - 1 END AS day FROM events""",
)
def json_typed(t: Tables) -> DataFrame:
    k = "get_json_object(props, '$.k')"
    lines = t.events.select("event_id", F.expr(_insight.format(id="event_id", k=k, day=k)).alias("raw_line"))
    good, _ = nested.split_json(lines)
    p = F.col("payload")
    return good.select(
        "event_id", F.nullif(nested.json_text(p, "$.ad_id"), F.lit("")).alias("ad_id"), nested.json_number(p, "$.impressions", "bigint").alias("impressions"),
        nested.json_number(p, "$.spend", clean.MONEY).alias("spend"), F.nullif(nested.json_text(p, "$.name"), F.lit("")).alias("name"),
        nested.json_number(p, "$.date_start", "date").alias("day"),
    )


@proof(
    "event_fingerprint session:i location traffic",
    "SELECT sha256(concat_ws('|', user_pseudo_id, event_timestamp, event_name, ga_session_id)) AS event_fingerprint, ga_session_id AS session, page_location AS location, traffic_type AS traffic FROM raw_events",
)
def kv_lookup(t: Tables) -> DataFrame:
    look = lambda key, slot: nested.kv_lookup("event_params", key, slot)
    e = Delivered(t)["ga4_events"]
    return e.select(
        clean.event_fingerprint("user_pseudo_id", values.micros_to_timestamp("event_timestamp"), "event_name", look("ga_session_id", "int_value")).alias("event_fingerprint"),
        look("ga_session_id", "int_value").alias("session"), look("page_location", "string_value").alias("location"), look("traffic_type", "string_value").alias("traffic"),
    )


@proof("event_timestamp:i user_pseudo_id reported:n4", "SELECT event_timestamp, user_pseudo_id, coalesce(value_double, value_float, value_int) AS reported FROM raw_events")
def kv_numeric(t: Tables) -> DataFrame:
    return Delivered(t)["ga4_events"].select("event_timestamp", "user_pseudo_id", nested.kv_number("event_params", "value").alias("reported"))


@proof("event_timestamp:i device system city gclid transaction", "SELECT event_timestamp, device_category AS device, operating_system AS system, city, field_gclid AS gclid, order_field AS transaction FROM raw_events")
def struct_flatten(t: Tables) -> DataFrame:
    paths = {"device": "device.category", "system": "device.operating_system", "city": "geo.city", "gclid": "collected_traffic_source.gclid", "transaction": "ecommerce.transaction_id"}
    return Delivered(t)["ga4_events"].select("event_timestamp", *[F.col(p).alias(n) for n, p in paths.items()])


CTES["cut_lines"] = "SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) ELSE props END AS raw_line, CAST(ts AS DATE) AS dt FROM events"


@proof("event_id:i raw_line outcome k:i", "SELECT event_id, raw_line, CASE WHEN json_valid(raw_line) THEN 'valid' ELSE 'quarantine' END AS outcome, CASE WHEN json_valid(raw_line) THEN CAST(json_extract_string(raw_line, '$.k') AS BIGINT) END AS k FROM cut_lines")
def json_quarantine(t: Tables) -> DataFrame:
    line = F.when(F.col("event_type") == "error", F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    good, bad = nested.split_json(t.events.select("event_id", line.alias("raw_line")))
    valid = good.select("event_id", "raw_line", F.lit("valid").alias("outcome"), nested.json_number(F.col("payload"), "$.k", "bigint").alias("k"))
    return valid.unionByName(bad.withColumn("outcome", F.lit("quarantine")), allowMissingColumns=True)


@proof(
    "event_id:i purchases:n2 revenue:n2",
    "SELECT event_id, CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0 END AS purchases, 0 AS revenue FROM events",
)
def json_array_pivot(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    line = F.concat(
        F.lit('{"actions":[{"action_type":"link_click","value":"7"}'),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit(',{"action_type":"buy","value":"'), k, F.lit('"},{"action_type":"buy","value":"1"}'))).otherwise(""),
        F.lit("]}"),
    )
    p = F.try_parse_json(line)
    return t.events.select("event_id", nested.action_value(p, "actions", "buy").alias("purchases"), nested.action_value(p, "action_values", "buy").alias("revenue"))


_spellings = ", ".join(f"('{s}', '{city}')" for city, many in schemas.CITY_SPELLINGS.items() for s in many)


@proof(
    "customer_id dt:d key city_standard",
    f"""SELECT customer_id, dt, key, city_standard FROM (SELECT *, lower(regexp_replace(trim(city), '[\\s_-]+', ' ', 'g')) AS key FROM raw_customers)
        LEFT JOIN (VALUES {_spellings}) AS s(key, city_standard) USING (key)""",
)
def canonical_category(t: Tables) -> DataFrame:
    seed = files.city_mapping(t.spark).withColumnRenamed("city_raw_normalized", "key")
    return flat(t, "raw_customers").withColumn("key", clean.category_key("city")).join(seed, "key", "left")


@proof("customer_id dt:d email domain", "SELECT customer_id, dt, nullif(lower(trim(email)), '') AS email, nullif(split_part(lower(trim(email)), '@', 2), '') AS domain FROM raw_customers")
def email_domain(t: Tables) -> DataFrame:
    key = clean.email_key("email")
    return flat(t, "raw_customers").select("customer_id", "dt", key.alias("email"), clean.email_domain(key).alias("domain"))


@proof(
    "customer_id dt:d phone",
    """SELECT customer_id, dt, CASE WHEN d = '' THEN NULL WHEN starts_with(d, '0027') THEN '+27' || substr(d, 5) WHEN starts_with(d, '27') THEN '+' || d WHEN starts_with(d, '0') THEN '+27' || substr(d, 2) ELSE '+27' || d END AS phone
       FROM (SELECT *, regexp_replace(phone, '\\D', '', 'g') AS d FROM raw_customers)""",
)
def phone_normalise(t: Tables) -> DataFrame:
    return flat(t, "raw_customers").select("customer_id", "dt", clean.phone_key("phone").alias("phone"))


@proof("customer_id dt:d email_hash", "SELECT customer_id, dt, sha256(nullif(lower(trim(email)), '')) AS email_hash FROM raw_customers")
def pii_hash(t: Tables) -> DataFrame:
    return flat(t, "raw_customers").select("customer_id", "dt", clean.pseudonym(clean.email_key("email")).alias("email_hash"))


@proof("o_orderkey:i order_key line_key", "SELECT o_orderkey, sha256('order|' || o_orderkey) AS order_key, sha256(o_orderkey || '|' || o_custkey || '|' || o_orderpriority) AS line_key FROM orders")
def surrogate_key(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", clean.surrogate_key(F.lit("order"), "o_orderkey").alias("order_key"), clean.surrogate_key("o_orderkey", "o_custkey", "o_orderpriority").alias("line_key")
    )


@proof("event_id:i event_fingerprint", "SELECT event_id, sha256(concat_ws('|', user_id, epoch_us(ts), event_type, strftime(ts, '%Y%m%d'))) AS event_fingerprint FROM events")
def event_fingerprint(t: Tables) -> DataFrame:
    return t.events.select("event_id", clean.event_fingerprint("user_id", "ts", "event_type", F.date_format("ts", "yyyyMMdd")).alias("event_fingerprint"))


@proof(
    "page_id:i page ref tag missing",
    """SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1, 'i'), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1, 'i'), '') AS ref,
       coalesce(nullif(regexp_extract(html, 'lang="([a-z]+)"', 1), ''), nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1, 'i'), '')) AS tag, CAST(NULL AS VARCHAR) AS missing FROM pages""",
)
def url_params(t: Tables) -> DataFrame:
    lang = clean.first_match("html", 'lang="([a-z]+)"')
    return t.pages.select(
        "page_id", clean.url_parameter("url", "PAGE").alias("page"), clean.url_parameter("url", "ref").alias("ref"),
        clean.url_parameter("url", "utm_source", lang).alias("tag"), clean.url_parameter("url", "gclid").alias("missing"),
    )


@proof("page_id:i stem section host", "SELECT page_id, nullif(regexp_extract(url, '/([^/]+)\\.html$', 1), '') AS stem, nullif(regexp_extract(url, '//[^/]+/([a-z]+)/', 1), '') AS section, nullif(regexp_extract(url, '//([^/]+)', 1), '') AS host FROM pages")
def path_id(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", clean.file_stem("url", "html").alias("stem"), clean.path_id("url", "//[^/]+/([a-z]+)/").alias("section"), clean.path_id("url", "//([^/]+)").alias("host")
    )


@proof(
    "segments_date ad metrics_impressions metrics_all_conversions metrics_conversions metrics_cost_micros dt:d",
    """SELECT CAST(day AS VARCHAR) AS segments_date, 'ad' || ad AS ad, CAST(impressions AS VARCHAR) AS metrics_impressions, CASE WHEN n_day >= 60 THEN CAST(all_conversions AS VARCHAR) END AS metrics_all_conversions,
       CAST(conversions AS VARCHAR) AS metrics_conversions, CAST(cents * 10000 AS VARCHAR) AS metrics_cost_micros, CAST(day + 1 AS DATE) AS dt FROM raw_ad_days WHERE ad % 2 = 0""",
)
def header_projection(t: Tables) -> DataFrame:
    columns = ["segments_date", "ad_group_ad_ad_id", "metrics_impressions", "metrics_all_conversions", "metrics_conversions", "metrics_cost_micros"]
    return staging.by_header(Delivered(t)["google_ads_performance_raw"], "segments_date", columns).withColumnRenamed("ad_group_ad_ad_id", "ad")


@proof(
    "vec_id:i position:i value:n6 next_value:n6",
    "SELECT vec_id, pos - 1 AS position, embedding[pos] AS value, embedding[pos + 1] AS next_value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)",
)
def zip_arrays(t: Tables) -> DataFrame:
    # The second array is one shorter: its last position is NULL.
    e = t.embeddings.withColumn("shifted", F.slice("embedding", F.lit(2), F.size("embedding")))
    return nested.zip_arrays(e, {"value": "embedding", "next_value": "shifted"}, ["vec_id"])


_TONE_SQL = """CASE WHEN regexp_matches(lower(text), 'the|and') THEN 'english' WHEN regexp_matches(lower(text), 'eau|que') THEN 'french' WHEN regexp_matches(lower(text), 'der|und') THEN 'german' ELSE 'other' END"""


@proof(
    "doc_id:i tone has_digit:b discount:i",
    f"SELECT doc_id, {_TONE_SQL} AS tone, regexp_matches(text, '[0-9]') AS has_digit, coalesce(try_cast(nullif(regexp_extract(text || ' 15%  OFF', '(\\d+)%\\s+off', 1, 'i'), '') AS BIGINT), 0) AS discount FROM documents",
)
def text_features(t: Tables) -> DataFrame:
    phrases = {"english": "the|and", "french": "eau|que", "german": "der|und"}
    return t.documents.select(
        "doc_id", creative.rule_tone("text", phrases, "other").alias("tone"), F.col("text").rlike("[0-9]").alias("has_digit"),
        F.coalesce(creative.stated_discount(F.concat("text", F.lit(" 15%  OFF"))), F.lit(0)).alias("discount"),
    )


@proof(
    "doc_id:i tone discount_pct:i cta product extraction_method",
    """WITH d AS (SELECT doc_id, lang, n_chars, CASE lang WHEN 'en' THEN 'urgent' WHEN 'fr' THEN 'playful' WHEN 'de' THEN 'loud' END AS said FROM documents)
       SELECT doc_id, CASE WHEN said IN ('urgent', 'playful') THEN said ELSE 'informative' END AS tone, CASE WHEN lang IN ('en', 'fr', 'de') THEN n_chars % 101 ELSE 25 END AS discount_pct,
           CASE WHEN lang IN ('en', 'fr', 'de') THEN 'learn_more' ELSE 'shop_now' END AS cta, CASE WHEN lang = 'en' THEN 'Tent' ELSE 'Karoo fleece' END AS product,
           CASE WHEN lang = 'en' THEN 'model' ELSE 'deterministic_fallback' END AS extraction_method FROM d""",
)
def response_validate(t: Tables) -> DataFrame:
    pct = (F.col("n_chars") % 101).cast("string")
    body = lambda tone, product: F.concat(F.lit(f'{{"tone":"{tone}","discount_pct":'), pct, F.lit(f',"cta":"LEARN_MORE","product":"{product}"}}'))
    fence = lambda c: F.concat(F.lit("```json\n"), c, F.lit("\n```"))
    reply = F.when(F.col("lang") == "en", fence(body("Urgent", " Tent "))).when(F.col("lang") == "fr", body("playful", "")).when(F.col("lang") == "de", fence(body("loud", " ")))
    df = t.documents.select(
        "doc_id", F.lit("Made for rain: Karoo fleece, 25% off. Shop now").alias("copy_text"), F.coalesce(reply, F.lit("no JSON here")).alias("model_response"),
        F.when(F.col("lang") == "es", "error").alias("model_status"), "n_chars", "lang",
    )
    return creative.features(df)


@proof("conv_id:i turn:i chars:i copy_at:i", "SELECT conv_id, turn, length(text) AS chars, 1 AS copy_at FROM conversations")
def prompt_text(t: Tables) -> DataFrame:
    prompt = creative.prompt_text("text")
    lead = F.length(creative.prompt_text(F.lit("")))
    return t.conversations.select(
        "conv_id", "turn", (F.length(prompt) - lead).alias("chars"), F.when(prompt.endswith(F.col("text")), 1).otherwise(0).alias("copy_at")
    )


@proof(
    "calendar_date:d date_key:i calendar_year:i calendar_quarter:i calendar_month:i month_name iso_week:i week_start_date:d month_start_date:d day_of_month:i day_name is_weekend:b",
    """SELECT day AS calendar_date, CAST(strftime(day, '%Y%m%d') AS INT) AS date_key, year(day) AS calendar_year, quarter(day) AS calendar_quarter, month(day) AS calendar_month, monthname(day) AS month_name,
       weekofyear(day) AS iso_week, date_trunc('week', day) AS week_start_date, date_trunc('month', day) AS month_start_date, day(day) AS day_of_month, dayname(day) AS day_name, isodow(day) IN (6, 7) AS is_weekend
       FROM (SELECT CAST(unnest(generate_series(least(min(o), min(l)), greatest(max(o), max(l)), INTERVAL 1 DAY)) AS DATE) AS day
             FROM (SELECT min(o_orderdate) AS o, NULL AS l FROM orders UNION ALL SELECT max(o_orderdate), NULL FROM orders UNION ALL SELECT NULL, min(l_shipdate) FROM lineitem UNION ALL SELECT NULL, max(l_shipdate) FROM lineitem))""",
)
def date_dimension(t: Tables) -> DataFrame:
    o = t.orders.select(F.to_date("o_orderdate").alias("d"))
    line = t.lineitem.select(F.to_date("l_shipdate").alias("d"))
    return star.dim_date([(o, "d"), (line, "d")])


CTES["weekday_rates"] = "SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS series, 1000 + count(*) AS rate FROM orders WHERE isodow(o_orderdate) < 6 GROUP BY 1, 2"


def _rate_days(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    rates = t.orders.filter(F.dayofweek(day).between(2, 6)).groupBy(day.alias("day"), F.col("o_orderpriority").alias("series")).agg((F.count(F.lit(1)) + 1000).alias("rate"))
    series = t.orders.select(F.col("o_orderpriority").alias("series")).distinct()
    bounds = with_scalars(series, one_bounds([(t.orders.select(day.alias("d")), "d")]))
    return date_spine(bounds, "first_day", "last_day", "day").join(rates, ["series", "day"], "left")


_FILLED = """SELECT s.series, s.day, r.rate FROM (
    SELECT series, CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT o_orderpriority AS series FROM orders)) s
    ASOF LEFT JOIN weekday_rates r ON r.series = s.series AND s.day >= r.day"""


@proof("series day:d rate:i", _FILLED, name="forward_fill")
def fill_rates(t: Tables) -> DataFrame:
    return forward_fill(_rate_days(t), "day", ["rate"], ["series"])


@proof(
    "o_orderkey:i rate:i converted:n2",
    f"SELECT o_orderkey, f.rate, round(CAST(CAST(round(o_totalprice * 100) AS HUGEINT) * f.rate AS DECIMAL(38,2)) / 100, 2) AS converted FROM orders o LEFT JOIN ({_FILLED}) f ON f.series = o_orderpriority AND f.day = CAST(o_orderdate AS DATE)",
)
def fx_convert(t: Tables) -> DataFrame:
    daily = forward_fill(_rate_days(t), "day", ["rate"], ["series"])
    o = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return o.join(daily, ["series", "day"], "left").withColumn("converted", values.convert("amount", "rate"))


# --- Sources and sinks: written to the shared folder by delivery day, read back ---


def _delivered_csv(t: Tables) -> tuple[str, DataFrame]:
    root = scratch_path(t.spark, "csv")
    rows = flat(t, "raw_orders").select(*schemas.DELIVERED_TEXT["crm_orders"], "dt")
    rows.hint("rebalance", "dt").write.option("header", True).option("quoteAll", True).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).partitionBy("dt").csv(root)
    return root, files.read_delimited(t.spark, root, "*.csv", schemas.DELIVERED_TEXT["crm_orders"])


@proof("order_id customer_id order_ts subtotal discount revenue status dt:d", "SELECT order_id, customer_id, order_ts, subtotal, nullif(discount, '') AS discount, revenue, status, dt FROM raw_orders")
def source_delimited(t: Tables) -> DataFrame:
    return _delivered_csv(t)[1].withColumn("discount", F.nullif("discount", F.lit("")))


@proof("dt:d n:i traced:i", "SELECT dt, count(*) AS n, count(*) AS traced FROM raw_orders GROUP BY dt")
def lineage_columns(t: Tables) -> DataFrame:
    path = F.col("source_file_name")
    traced = F.count_if(path.contains(F.concat(F.lit("/dt="), F.col("dt").cast("string"), F.lit("/"))))
    return _delivered_csv(t)[1].groupBy("dt").agg(F.count(F.lit(1)).alias("n"), traced.alias("traced"))


@proof("raw_line dt:d", "SELECT event_id || ',\"' || event_type || '\",' AS raw_line, CAST(ts AS DATE) AS dt FROM events")
def source_lines(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "lines")
    line = F.concat(F.col("event_id").cast("string"), F.lit(',"'), F.col("event_type"), F.lit('",'))
    t.events.select(line.alias("value"), F.to_date("ts").alias("dt")).write.partitionBy("dt").text(root)
    return files.read_lines(t.spark, root, "*.txt")


@proof("event_timestamp:i user_pseudo_id session:i location device city dt:d", "SELECT event_timestamp, user_pseudo_id, ga_session_id AS session, page_location AS location, device_category AS device, city, dt FROM raw_events")
def source_nested_json(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "json")
    Delivered(t)["ga4_events"].drop("source_file_name").write.option("compression", "gzip").partitionBy("dt").json(root)
    e = files.read_nested_json(t.spark, root, "*.json.gz", schemas.EVENT_SCHEMA)
    look = lambda key, slot: nested.kv_lookup("event_params", key, slot)
    return e.select(
        "event_timestamp", "user_pseudo_id", look("ga_session_id", "int_value").alias("session"), look("page_location", "string_value").alias("location"),
        F.col("device.category").alias("device"), F.col("geo.city").alias("city"), "dt",
    )


@proof("c_custkey:i c_name c_nationkey:i c_acctbal:n2 c_mktsegment", "FROM customer")
def sink_full(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "full")
    write_full(t.customer.withColumn("c_name", F.lit("old")), path, "c_mktsegment")
    write_full(t.customer, path, "c_mktsegment", ["c_custkey"])
    return t.spark.read.parquet(path)
