"""Every table of the pipeline on the derived deliveries, against SQL of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admere.plans import conformed, marts, staging, star, value
from admere.proofs.landing import INTERNAL_DOMAIN, Delivered
from admere.proofs.registry import CTES, Tables, proof
from admere.session import scratch_path
from admere.sources.files import city_mapping, internal_domains
from admere.sources.schemas import CITIES, CITY_SPELLINGS
from admere.sources.tables import write_full


#: Tables that are a plain projection of one other table; nothing is saved by storing them.
PROJECTIONS = {"fct_orders", "fct_sessions", "fct_ad_spend_daily"}
_STORED: dict[tuple[str, str], dict[str, str]] = {}


class Chain:
    """The pipeline's tables on the derived deliveries.

    ``define`` gives a table as a lazy DataFrame. A table another one reads is
    written to the shared folder first, as in a run of the pipeline, and kept for
    the session.
    """

    def __init__(self, t: Tables):
        self.t, self.raw = t, Delivered(t)
        self.domains = internal_domains(t.spark, [INTERNAL_DOMAIN])
        self.stored = _STORED.setdefault((t.spark.sparkContext.applicationId, t.sf_dir), {})
        self.opened: dict[str, DataFrame] = {}

    def define(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = self.define(name) if name in PROJECTIONS else self._open(name)
        return self.opened[name]

    def _open(self, name: str) -> DataFrame:
        if name not in self.stored:
            path = scratch_path(self.t.spark, name)
            write_full(self.define(name), path)
            self.stored[name] = path
        return self.t.spark.read.parquet(self.stored[name])

    def _stg_crm_customers(self):
        return staging.crm_customers(self.raw["crm_customers"], city_mapping(self.t.spark), self.domains)

    def _stg_crm_orders(self):
        return staging.crm_orders(self.raw["crm_orders"], self["stg_crm_customers"])

    def _stg_crm_order_items(self):
        return staging.crm_order_items(self.raw["crm_order_items"])

    def _stg_google_clicks(self):
        return staging.google_clicks(self.raw["google_ads_clicks"])

    def _stg_google_ads_performance(self):
        return staging.google_ads_performance(self.raw["google_ads_performance_raw"])

    def _stg_fx_rates(self):
        return staging.fx_rates(self.raw["fx_rates"], last="2024-05-31")

    def _stg_meta_ads(self):
        return staging.meta_ads(self.raw["meta_ads_insights_raw"], self["stg_fx_rates"])

    def _quarantine_meta_ads(self):
        return staging.quarantine_meta_ads(self.raw["meta_ads_insights_raw"])

    def _stg_weather(self):
        return staging.weather(self.raw["weather_daily"])

    def _stg_creatives(self):
        return staging.creatives(self.raw["creative_copy_raw"])

    def _stg_ga4_events(self):
        return staging.ga4_events(self.raw["ga4_events"])

    def _int_customer_identity(self):
        return conformed.customer_identity(self["stg_crm_customers"], self["stg_crm_orders"])

    def _int_sessions(self):
        return conformed.sessions(
            self["stg_ga4_events"], self["stg_crm_orders"], self["int_customer_identity"], self["stg_google_clicks"], self["stg_meta_ads"]
        )

    def _int_orders_attributed(self):
        return conformed.orders_attributed(self["stg_crm_orders"], self["int_customer_identity"], self["int_sessions"])

    def _int_creative_features(self):
        return conformed.creative_features(self["stg_creatives"])

    def _fct_orders(self):
        return star.fct_orders(self["int_orders_attributed"])

    def _fct_sessions(self):
        return star.fct_sessions(self["int_sessions"])

    def _fct_ad_spend_daily(self):
        return star.fct_ad_spend_daily(self["stg_google_ads_performance"], self["stg_meta_ads"])

    def _dim_date(self):
        return star.dim_date([
            (self["stg_google_ads_performance"], "performance_date"), (self["stg_meta_ads"], "insight_date"),
            (self["int_sessions"], "session_date"), (self["int_orders_attributed"], "order_date"),
        ])

    def _dim_customer(self):
        return star.dim_customer(self["int_customer_identity"], self["int_orders_attributed"])

    def _dim_campaign(self):
        return star.dim_campaign(self["stg_google_ads_performance"], self["stg_meta_ads"])

    def _dim_ad(self):
        return star.dim_ad(self["stg_google_ads_performance"], self["stg_meta_ads"], self["int_creative_features"])

    def _mart_customer_features(self):
        return value.mart_customer_features(
            self["dim_customer"], self["fct_orders"], self["fct_sessions"], self["dim_ad"], F.lit("2024-01-23").cast("date")
        )

    def _scores(self):
        """Stand-in for the model, so that the marts can be checked in SQL: a fixed share of early revenue."""
        guess = F.col("completed_revenue_7d").cast("double") * 0.25
        scored = self["mart_customer_features"].filter(F.col("acquisition_date") <= F.lit("2024-04-20").cast("date")).select(
            "customer_key", guess.alias("predicted_future_value_90d"), "dt", "source_file_name"
        )
        return value.segments(scored, "predicted_future_value_90d", "customer_key").withColumn(
            "scored_at_utc", F.lit("2024-06-01 00:00:00").cast("timestamp")
        )

    def _mart_customer_value(self):
        return marts.mart_customer_value(self["scores"], self["mart_customer_features"], self["dim_customer"], self["dim_campaign"])

    def _mart_campaign_value(self):
        return marts.mart_campaign_value(
            self["fct_ad_spend_daily"], self["fct_orders"], self["dim_customer"], self["mart_customer_value"], self["dim_campaign"]
        )

    def _mart_campaign_drivers(self):
        return marts.mart_campaign_drivers(
            self["fct_sessions"], self["fct_orders"], self["dim_customer"], self["stg_weather"], self["fct_ad_spend_daily"],
            self["dim_ad"], self["mart_campaign_value"],
        )


def _model(name: str, spec: str, sql: str) -> None:
    def run(t: Tables) -> DataFrame:
        df = Chain(t).define(name)
        lists = [f.name for f in df.schema.fields if f.dataType.simpleString() == "array<string>"]
        return df.withColumns({c: F.concat_ws(",", c) for c in lists})

    proof(spec, sql, name)(run)


_spellings = ", ".join(f"('{s}', '{city}')" for city, many in CITY_SPELLINGS.items() for s in many)
_cities = ", ".join(f"'{c}'" for c in CITIES)

CTES["z_customers"] = f"""
    WITH newest AS (
        SELECT DISTINCT ON (trim(customer_id)) trim(customer_id) AS customer_id, nullif(lower(trim(email)), '') AS mail,
            nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS digits, lower(regexp_replace(trim(city), '[\\s_-]+', ' ', 'g')) AS spelling,
            try_cast(created_at AS TIMESTAMP) AS created_at_utc, is_guest, marketing_opt_in, dt, source_file_name
        FROM raw_customers ORDER BY trim(customer_id), dt DESC, created_at DESC, source_file_name DESC)
    SELECT customer_id, sha256(mail) AS email_hash,
        sha256(CASE WHEN digits LIKE '0027%' THEN '+27' || digits[5:] WHEN digits LIKE '27%' THEN '+' || digits
               WHEN digits LIKE '0%' THEN '+27' || digits[2:] ELSE '+27' || digits END) AS phone_hash,
        city_standard, created_at_utc, CAST(created_at_utc + INTERVAL 2 HOUR AS DATE) AS created_date,
        CASE lower(is_guest) WHEN 'true' THEN true WHEN 'false' THEN false END AS is_guest,
        CASE lower(marketing_opt_in) WHEN 'true' THEN true WHEN 'false' THEN false END AS marketing_opt_in,
        coalesce(split_part(mail, '@', 2) = '{INTERNAL_DOMAIN}', false) AS is_internal_customer, dt, source_file_name
    FROM newest LEFT JOIN (VALUES {_spellings}) AS s(spelling, city_standard) USING (spelling)"""

CTES["z_orders"] = """
    WITH newest AS (
        SELECT DISTINCT ON (order_id) order_id, customer_id, CAST(order_ts AS TIMESTAMP) AS order_timestamp_utc, trim(currency) AS currency,
            CAST(subtotal AS DECIMAL(18,4)) AS subtotal, CAST(nullif(discount, '') AS DECIMAL(18,4)) AS discount, CAST(revenue AS DECIMAL(18,4)) AS revenue,
            lower(trim(status)) AS status, CAST(item_count AS BIGINT) AS item_count, CAST(updated_at AS TIMESTAMP) AS updated_at_utc, dt, source_file_name
        FROM raw_orders ORDER BY order_id, updated_at DESC, dt DESC, source_file_name DESC)
    SELECT n.*, CAST(order_timestamp_utc + INTERVAL 2 HOUR AS DATE) AS order_date, coalesce(c.is_internal_customer, false) OR revenue <= 1 AS is_test_order
    FROM newest n LEFT JOIN (SELECT customer_id, is_internal_customer FROM z_customers) c USING (customer_id)"""

CTES["z_items"] = """
    SELECT order_id, sku, arg_max(struct_pack(p := unit_price, q := quantity, n := nullif(trim(product_name), ''), d := dt, f := source_file_name), (dt, source_file_name)) AS pick
    FROM raw_items GROUP BY 1, 2"""

CTES["z_clicks"] = """
    SELECT CAST(segments_date AS DATE) AS click_date, click_view_gclid AS gclid, campaign_id, nullif(trim(ad_group_id), '') AS ad_group_id,
        ad_group_ad_ad_id AS ad_id, nullif(trim(click_view_area_of_interest_city), '') AS area_of_interest_city, dt, source_file_name FROM raw_clicks"""

CTES["z_google"] = """
    SELECT day AS performance_date, 'acc1' AS account_id, 'G' || (ad % 25) AS campaign_id,
        'google campaign ' || (ad % 25) || CASE WHEN ad % 25 < 5 AND n_day >= 60 THEN ' new' ELSE '' END AS campaign_name,
        'grp' || (ad % 5) AS ad_group_id, CAST(NULL AS VARCHAR) AS ad_group_name, 'ad' || ad AS ad_id, impressions, clicks,
        CASE WHEN n_day >= 60 THEN all_conversions END AS all_conversions, conversions, claimed_cents / 100 AS conversions_value_zar,
        CAST(cents AS DECIMAL(28,4)) / 100 AS cost_zar, CAST(cents AS HUGEINT) AS cost_cents, claimed_cents, CAST(day + 1 AS DATE) AS dt,
        '/google_ads/dt=' || CAST(day + 1 AS DATE) || '/ad_performance.csv' AS source_file_name
    FROM raw_ad_days WHERE ad % 2 = 0"""

CTES["z_rates"] = """
    WITH published AS (SELECT CAST(rate_date AS DATE) AS rate_date, trim(base_currency) AS base_currency, quote_currency, CAST(rate AS DECIMAL(18,6)) AS rate, dt, source_file_name FROM raw_rates),
    spine AS (SELECT CAST(unnest(generate_series((SELECT min(dt) FROM published), DATE '2024-05-31', INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT day AS rate_date, p.base_currency, p.quote_currency, p.rate, p.dt AS rate_source_dt, day AS dt, p.source_file_name
    FROM spine ASOF JOIN published p ON day >= p.rate_date"""

CTES["z_meta"] = """
    SELECT day AS insight_date, 'M' || (ad % 25) AS campaign_id,
        'meta campaign ' || (ad % 25) || CASE WHEN ad % 25 < 5 AND n_day >= 60 THEN ' new' ELSE '' END AS campaign_name, 'set' || (ad % 5) AS adset_id,
        'ad' || ad AS ad_id, 'Ad ' || ad AS ad_name, impressions, clicks, CAST(cents AS HUGEINT) AS spend_cents, conversions AS purchases, claimed_cents,
        CAST(day + 2 AS DATE) AS dt, CAST(day + 2 AS TIMESTAMP) + INTERVAL 6 HOUR AS pulled_at_utc, r.rate AS usd_zar_rate,
        CAST(cents * CAST(rate * 100 AS HUGEINT) AS DECIMAL(38,4)) / 10000 AS spend_zar, CAST(claimed_cents * CAST(rate * 100 AS HUGEINT) AS DECIMAL(38,4)) / 10000 AS purchase_value_zar,
        CAST(cents * CAST(rate * 100 AS HUGEINT) AS HUGEINT) AS spend_units, CAST(claimed_cents * CAST(rate * 100 AS HUGEINT) AS HUGEINT) AS claimed_units,
        '/meta_ads/dt=' || CAST(day + 2 AS DATE) || '/insights.jsonl' AS source_file_name
    FROM raw_ad_days LEFT JOIN z_rates r ON r.rate_date = day WHERE ad % 2 = 1"""

CTES["z_weather"] = """SELECT city AS city_standard, day AS weather_date, hi, lo, rain, CAST(greatest(date_trunc('month', day) + INTERVAL 32 DAY, date_trunc('week', day) + INTERVAL 7 DAY) AS DATE) AS dt FROM raw_weather"""

CTES["z_copy"] = """
    SELECT DISTINCT ON (regexp_extract(source_file_name, 'ad_([^/]+)/copy', 1)) regexp_extract(source_file_name, 'ad_([^/]+)/copy', 1) AS ad_id, raw_line AS copy_text, dt, source_file_name
    FROM raw_copy WHERE trim(raw_line) <> '' ORDER BY regexp_extract(source_file_name, 'ad_([^/]+)/copy', 1), dt DESC, source_file_name DESC, raw_line DESC"""

CTES["z_features"] = """
    SELECT ad_id, copy_text, dt,
        CASE WHEN regexp_matches(copy_text, 'last chance|won''t wait|ends sunday', 'i') THEN 'urgent'
             WHEN regexp_matches(copy_text, 'made for|built for|with .+', 'i') THEN 'informative'
             WHEN contains(lower(copy_text), 'some trails change you') THEN 'aspirational' ELSE 'playful' END AS tone,
        coalesce(try_cast(nullif(regexp_extract(copy_text, '(\\d+)%\\s+off', 1, 'i'), '') AS BIGINT), 0) AS discount_pct,
        CASE WHEN contains(lower(copy_text), 'shop now') THEN 'shop_now' WHEN contains(lower(copy_text), 'learn more') THEN 'learn_more'
             WHEN contains(lower(copy_text), 'claim the offer') THEN 'get_offer' ELSE 'sign_up' END AS cta,
        nullif(regexp_extract(copy_text, 'Drakensberg shell jacket|Cederberg hiking boots|Karoo fleece|Tsitsikamma rain pants|Table Mountain daypack'), '') AS product
    FROM z_copy"""

_tag = lambda p: f"nullif(regexp_extract(page_location, '[?&]{p}=([^&#]+)', 1, 'i'), '')"

CTES["z_event_flat"] = f"""
    SELECT sha256(concat_ws('|', user_pseudo_id, event_timestamp, event_name, ga_session_id)) AS fp, CAST(strptime(event_date, '%Y%m%d') AS DATE) AS event_date,
        make_timestamp(event_timestamp) AS happened, event_name, user_pseudo_id, ga_session_id, page_location, engagement_time_msec, device_category, operating_system, city,
        coalesce(field_gclid, {_tag('gclid')}) AS gclid, {_tag('srsltid')} AS srsltid, {_tag('fbclid')} AS fbclid, field_campaign_id AS tag_campaign,
        {_tag('utm_campaign')} AS tag_name, coalesce(field_source, {_tag('utm_source')}) AS tag_source, {_tag('utm_medium')} AS tag_medium, {_tag('utm_content')} AS tag_content,
        coalesce(order_field, order_parameter) AS transaction_id, coalesce(value_double, value_float, CAST(value_int AS DOUBLE)) AS reported, coalesce(traffic_type ILIKE 'internal', false) AS staff,
        dt, source_file_name
    FROM raw_events"""

CTES["z_session_values"] = """
    SELECT user_pseudo_id, ga_session_id, max(gclid) AS s_gclid, max(srsltid) AS s_srsltid, max(fbclid) AS s_fbclid, max(tag_campaign) AS s_campaign, max(tag_name) AS s_name,
        max(tag_source) AS s_source, max(tag_medium) AS s_medium, max(tag_content) AS s_content FROM z_event_flat GROUP BY ALL"""

CTES["z_event_unique"] = "SELECT DISTINCT ON (fp) * FROM z_event_flat ORDER BY fp, dt DESC, source_file_name DESC"

CTES["z_events"] = """
    SELECT u.*, v.* EXCLUDE (user_pseudo_id, ga_session_id), event_date >= (SELECT max(event_date) - 1 FROM z_event_flat) AS provisional, event_date <> dt AS arrived_late
    FROM z_event_unique u JOIN z_session_values v USING (user_pseudo_id, ga_session_id)
    WHERE event_name <> 'purchase' OR transaction_id IS NULL OR fp IN (
        SELECT first(fp ORDER BY happened, dt DESC, source_file_name DESC, fp) FROM z_event_unique WHERE event_name = 'purchase' AND transaction_id IS NOT NULL GROUP BY transaction_id)"""

CTES["z_identity"] = """
    WITH bridge AS (SELECT phone_hash, min(email_hash) AS other FROM z_customers WHERE phone_hash IS NOT NULL GROUP BY 1),
    known AS (
        SELECT c.*, coalesce(other, email_hash, phone_hash) AS identity, false AS is_placeholder,
            CASE WHEN email_hash IS NOT NULL THEN 'email' WHEN other IS NOT NULL THEN 'phone_to_email_bridge' ELSE 'phone' END AS identity_method
        FROM z_customers c LEFT JOIN bridge USING (phone_hash)),
    late AS (
        SELECT customer_id, max(dt) AS dt, last(source_file_name ORDER BY dt, updated_at_utc, source_file_name) AS source_file_name FROM z_orders o
        WHERE NOT is_test_order AND NOT EXISTS (FROM z_customers c WHERE c.customer_id = o.customer_id) GROUP BY 1)
    SELECT customer_id, sha256('customer|' || identity) AS customer_key, email_hash, phone_hash, identity_method, city_standard, created_at_utc, created_date, is_guest,
        marketing_opt_in, is_internal_customer, is_placeholder, dt, source_file_name FROM known
    UNION ALL SELECT customer_id, sha256('customer|late_customer|' || customer_id), NULL, NULL, 'late_arriving_placeholder', NULL, NULL, NULL, NULL, NULL, false, true, dt, source_file_name FROM late"""

CTES["z_rolled"] = """
    SELECT user_pseudo_id, ga_session_id, min(happened) AS started, max(happened) AS ended, min(event_date) AS session_date,
        first(city ORDER BY happened, city) FILTER (city IS NOT NULL) AS city, first(device_category ORDER BY happened, device_category) FILTER (device_category IS NOT NULL) AS device_category,
        first(operating_system ORDER BY happened, operating_system) AS operating_system, first(transaction_id ORDER BY happened, transaction_id) FILTER (transaction_id IS NOT NULL) AS transaction_id,
        any_value(s_gclid) AS gclid, any_value(s_srsltid) AS srsltid, any_value(s_fbclid) AS fbclid, any_value(s_campaign) AS tag_campaign, any_value(s_name) AS tag_name,
        any_value(s_source) AS tag_source, any_value(s_medium) AS tag_medium, any_value(s_content) AS tag_content, bool_or(staff) AS staff, bool_or(provisional) AS is_provisional,
        count(*) AS event_count, sum(coalesce(engagement_time_msec, 0)) AS engagement_time_msec, max(dt) AS dt, last(source_file_name ORDER BY dt, happened, source_file_name) AS source_file_name
    FROM z_events GROUP BY 1, 2"""

CTES["z_sessions"] = """
    WITH direct AS (
        SELECT r.user_pseudo_id, r.ga_session_id, o.customer_id, i.customer_key
        FROM z_rolled r JOIN z_orders o ON o.order_id = r.transaction_id JOIN z_identity i ON i.customer_id = o.customer_id),
    latest AS (SELECT DISTINCT ON (user_pseudo_id) user_pseudo_id, customer_id, customer_key FROM direct ORDER BY user_pseudo_id, ga_session_id DESC),
    ads AS (SELECT DISTINCT ON (ad_id) ad_id, campaign_id FROM z_meta ORDER BY ad_id, insight_date DESC)
    SELECT sha256(r.user_pseudo_id || '|' || r.ga_session_id) AS session_key, r.user_pseudo_id, r.ga_session_id, started, ended, session_date, city, device_category, operating_system,
        CASE WHEN d.customer_id IS NOT NULL THEN d.customer_id ELSE l.customer_id END AS customer_id, CASE WHEN d.customer_id IS NOT NULL THEN d.customer_key ELSE l.customer_key END AS customer_key,
        r.gclid, r.srsltid, r.fbclid, tag_source, tag_medium, tag_campaign, tag_name, tag_content, coalesce(k.campaign_id, a.campaign_id, tag_campaign) AS campaign_id, coalesce(k.ad_id, a.ad_id, tag_content) AS ad_id,
        CASE WHEN coalesce(r.gclid, r.fbclid, r.srsltid) IS NOT NULL THEN 'click_id' WHEN coalesce(tag_source, tag_medium, tag_name, tag_content) IS NOT NULL THEN 'utm' ELSE 'unattributed' END AS attribution_method,
        CASE WHEN r.gclid IS NOT NULL THEN 'google' WHEN r.fbclid IS NOT NULL OR a.ad_id IS NOT NULL THEN 'meta' ELSE lower(tag_source) END AS attributed_platform,
        transaction_id, is_provisional, event_count, engagement_time_msec, r.dt, r.source_file_name
    FROM z_rolled r LEFT JOIN direct d ON d.user_pseudo_id = r.user_pseudo_id AND d.ga_session_id = r.ga_session_id LEFT JOIN latest l ON l.user_pseudo_id = r.user_pseudo_id
    LEFT JOIN z_clicks k ON k.gclid = r.gclid LEFT JOIN ads a ON a.ad_id = r.tag_content WHERE NOT staff"""

CTES["z_genuine"] = "SELECT o.*, i.customer_key FROM z_orders o JOIN z_identity i USING (customer_id) WHERE NOT is_test_order"

CTES["z_attributed"] = """
    WITH pairs AS (
        SELECT o.order_id, s.session_key, s.started, s.transaction_id IS NOT DISTINCT FROM o.order_id AS exact, abs(epoch_us(o.order_timestamp_utc) - epoch_us(s.started)) // 1000000 AS gap
        FROM z_genuine o JOIN z_sessions s ON s.transaction_id = o.order_id
            OR (s.customer_key = o.customer_key AND s.started >= o.order_timestamp_utc - INTERVAL 1 DAY AND s.started <= o.order_timestamp_utc + INTERVAL 1 HOUR)),
    best AS (SELECT DISTINCT ON (order_id) order_id, session_key, exact FROM pairs ORDER BY order_id, exact DESC, gap, started DESC, session_key DESC)
    SELECT o.*, b.session_key, b.exact, s.campaign_id, s.ad_id, s.attributed_platform, coalesce(s.attribution_method, 'unattributed') AS attribution_method, s.gclid, s.fbclid, s.started,
        CASE WHEN status = 'completed' THEN revenue ELSE 0 END AS completed_revenue, CASE WHEN status = 'refunded' THEN revenue ELSE 0 END AS refunded_order_value, s.source_file_name AS session_file
    FROM z_genuine o LEFT JOIN best b USING (order_id) LEFT JOIN z_sessions s ON s.session_key = b.session_key"""

CTES["z_people"] = """
    WITH p AS (
        SELECT customer_key, count(DISTINCT customer_id) AS identity_count, string_agg(customer_id, ',' ORDER BY customer_id) AS ids,
            last(city_standard ORDER BY created_at_utc NULLS FIRST, customer_id) FILTER (city_standard IS NOT NULL) AS city_standard, min(created_date) AS first_created_date,
            bool_or(coalesce(is_guest, false)) AS has_guest_identity, bool_or(coalesce(marketing_opt_in, false)) AS marketing_opt_in, bool_and(is_placeholder) AS is_placeholder,
            bool_or(is_internal_customer) AS is_internal_customer, max(dt) AS dt, last(source_file_name ORDER BY dt, source_file_name) AS source_file_name
        FROM z_identity GROUP BY customer_key),
    o AS (SELECT customer_key, min(order_timestamp_utc) AS first_at, max(order_timestamp_utc) AS last_at, count(*) AS n FROM z_attributed GROUP BY 1)
    SELECT p.*, first_at, CAST(first_at + INTERVAL 2 HOUR AS DATE) AS first_order_date, last_at, coalesce(n, 0) AS lifetime_order_count FROM p LEFT JOIN o USING (customer_key) WHERE NOT is_internal_customer"""

CTES["z_campaigns"] = """
    SELECT 'google' AS platform, campaign_id, last(campaign_name ORDER BY performance_date) AS current_campaign_name, string_agg(DISTINCT campaign_name, ',' ORDER BY campaign_name) AS history,
        min(performance_date) AS first_seen_date, max(performance_date) AS last_seen_date, max(dt) AS dt FROM z_google GROUP BY campaign_id
    UNION ALL SELECT 'meta', campaign_id, last(campaign_name ORDER BY insight_date), string_agg(DISTINCT campaign_name, ',' ORDER BY campaign_name), min(insight_date), max(insight_date), max(dt)
    FROM z_meta GROUP BY campaign_id"""

CTES["z_ads"] = """
    SELECT a.*, f.copy_text, f.tone, f.discount_pct, f.cta, f.product FROM (
        SELECT 'google' AS platform, ad_id, any_value(campaign_id) AS campaign_id, any_value(ad_group_id) AS ad_group_id, CAST(NULL AS VARCHAR) AS ad_name, min(performance_date) AS first_seen_date, max(performance_date) AS last_seen_date FROM z_google GROUP BY ad_id
        UNION ALL SELECT 'meta', ad_id, any_value(campaign_id), any_value(adset_id), any_value(ad_name), min(insight_date), max(insight_date) FROM z_meta GROUP BY ad_id) a
    LEFT JOIN z_features f USING (ad_id)"""

CTES["z_spend"] = """
    SELECT performance_date AS spend_date, 'google' AS platform, campaign_id, ad_id, impressions, clicks, cost_cents * 100 AS spend_units, conversions AS claimed, CAST(claimed_cents AS HUGEINT) * 100 AS claimed_units,
        all_conversions, dt, source_file_name FROM z_google
    UNION ALL SELECT insight_date, 'meta', campaign_id, ad_id, impressions, clicks, spend_units, purchases, claimed_units, NULL, dt, source_file_name FROM z_meta"""

CTES["z_first"] = "SELECT DISTINCT ON (customer_key) * FROM z_attributed ORDER BY customer_key, order_timestamp_utc, order_id"

CTES["z_mart_features"] = """
    WITH early AS (
        SELECT p.customer_key, count(*) FILTER (age <= 7) AS orders_7d, count(*) FILTER (age <= 7 AND status = 'completed') AS completed_orders_7d, count(*) FILTER (age <= 7 AND status = 'refunded') AS refunded_orders_7d,
            coalesce(sum(completed_revenue) FILTER (age <= 7), 0) AS completed_revenue_7d, coalesce(sum(discount) FILTER (age <= 7), 0) AS discount_7d, coalesce(sum(item_count) FILTER (age <= 7), 0) AS items_7d,
            coalesce(sum(completed_revenue) FILTER (age BETWEEN 8 AND 97), 0) AS future_value_90d, max(o_dt) AS order_dt, last(file ORDER BY placed, order_id) AS order_file
        FROM z_people p JOIN (SELECT customer_key, order_id, order_date, status, completed_revenue, discount, item_count, dt AS o_dt, source_file_name AS file, order_timestamp_utc AS placed FROM z_attributed) o USING (customer_key),
            LATERAL (SELECT order_date - first_order_date AS age) GROUP BY 1),
    visits AS (
        SELECT s.customer_key, count(*) AS sessions_7d, count(*) FILTER (attribution_method = 'click_id') AS clicks_7d, count(*) FILTER (attribution_method = 'utm') AS utm_7d, count(DISTINCT campaign_id) AS campaigns_7d,
            sum(event_count) AS events_7d, sum(engagement_time_msec) AS engaged_7d, first(device_category ORDER BY started, session_key) FILTER (device_category IS NOT NULL) AS device, max(s.dt) AS session_dt
        FROM z_people p JOIN z_sessions s USING (customer_key) WHERE session_date - first_order_date BETWEEN 0 AND 7 GROUP BY 1)
    SELECT p.customer_key, p.first_order_date AS acquisition_date, p.city_standard, p.has_guest_identity, p.is_placeholder, p.first_order_date - p.first_created_date AS signup_days,
        f.attributed_platform AS acquisition_platform, f.campaign_id AS acquisition_campaign_id, f.ad_id AS acquisition_ad_id, f.attribution_method AS method, f.revenue AS first_order_value, a.tone, e.* EXCLUDE (customer_key),
        coalesce(sessions_7d, 0) AS sessions_7d, coalesce(clicks_7d, 0) AS clicks_7d, coalesce(utm_7d, 0) AS utm_7d, coalesce(campaigns_7d, 0) AS campaigns_7d, coalesce(events_7d, 0) AS events_7d,
        coalesce(engaged_7d, 0) AS engaged_7d, device, p.first_order_date <= DATE '2024-01-23' AS is_training_eligible, greatest(p.dt, e.order_dt, coalesce(v.session_dt, p.dt)) AS dt, p.lifetime_order_count
    FROM z_people p JOIN early e ON e.customer_key = p.customer_key LEFT JOIN visits v ON v.customer_key = p.customer_key JOIN z_first f ON f.customer_key = p.customer_key
    LEFT JOIN z_ads a ON a.platform = f.attributed_platform AND a.ad_id = f.ad_id"""

CTES["z_scores"] = """
    SELECT customer_key, CAST(completed_revenue_7d AS DOUBLE) * 0.25 AS predicted, ntile(3) OVER (ORDER BY CAST(completed_revenue_7d AS DOUBLE) * 0.25 DESC, customer_key) AS tile
    FROM z_mart_features WHERE acquisition_date <= DATE '2024-04-20'"""

CTES["z_campaign_weeks"] = """
    WITH parts AS (
        SELECT CAST(date_trunc('week', spend_date) AS DATE) AS week, platform, campaign_id, spend_units, claimed, claimed_units, impressions, clicks, dt AS s_dt, NULL AS done, NULL AS revenue, NULL AS first_revenue, NULL AS once, NULL AS predicted, 's' AS part FROM z_spend
        UNION ALL SELECT CAST(date_trunc('week', order_date) AS DATE), attributed_platform, campaign_id, NULL, NULL, NULL, NULL, NULL, NULL, status = 'completed', completed_revenue, NULL, NULL, NULL, 'o'
        FROM z_attributed WHERE attributed_platform IN ('google', 'meta') AND campaign_id IS NOT NULL
        UNION ALL SELECT CAST(date_trunc('week', order_date) AS DATE), attributed_platform, campaign_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, completed_revenue, p.lifetime_order_count = 1, coalesce(s.predicted, 0), 'n'
        FROM z_first f JOIN z_people p USING (customer_key) LEFT JOIN z_scores s USING (customer_key) WHERE attributed_platform IN ('google', 'meta') AND campaign_id IS NOT NULL)
    SELECT week AS week_start_date, platform, campaign_id, coalesce(sum(spend_units), 0) AS spend_units, sum(spend_units) AS raw_spend, coalesce(sum(claimed), 0) AS claimed_conversions, coalesce(sum(claimed_units), 0) AS claimed_units,
        coalesce(sum(impressions), 0) AS impressions, coalesce(sum(clicks), 0) AS clicks, count(*) FILTER (part = 'o') AS real_orders, count(*) FILTER (done) AS completed_orders, coalesce(sum(revenue), 0) AS real_revenue, sum(revenue) AS raw_revenue,
        count(*) FILTER (part = 'n') AS new_customers, coalesce(sum(first_revenue), 0) AS first_revenue, coalesce(sum(predicted), 0) AS predicted, count(*) FILTER (once) / greatest(count(*) FILTER (part = 'n'), 1) AS once_share,
        sum(claimed_units) AS raw_claimed, max(s_dt) AS s_dt
    FROM parts GROUP BY 1, 2, 3"""

_model("stg_crm_customers", "customer_id email_hash phone_hash city_standard created_at_utc:t created_date:d is_guest:b marketing_opt_in:b is_internal_customer:b dt:d source_file_name", "FROM z_customers")
_model(
    "stg_crm_orders",
    "order_id customer_id order_timestamp_utc:t order_date:d currency subtotal:n2 discount:n2 revenue:n2 status item_count:i updated_at_utc:t is_test_order:b dt:d source_file_name",
    "FROM z_orders",
)
_model(
    "stg_crm_order_items", "order_id sku product_name unit_price:n2 quantity:i dt:d source_file_name",
    "SELECT order_id, sku, pick.n AS product_name, CAST(pick.p AS DOUBLE) AS unit_price, pick.q AS quantity, pick.d AS dt, pick.f AS source_file_name FROM z_items",
)
_model("stg_google_clicks", "click_date:d gclid campaign_id ad_group_id ad_id area_of_interest_city dt:d source_file_name", "FROM z_clicks")
_model(
    "stg_google_ads_performance",
    "performance_date:d account_id campaign_id campaign_name ad_group_id ad_group_name ad_id impressions:i clicks:i cost_zar:n2 all_conversions:n2 conversions:n2 conversions_value_zar:n2 dt:d source_file_name",
    "FROM z_google",
)
_model("stg_fx_rates", "rate_date:d base_currency quote_currency rate:n4 rate_source_dt:d dt:d source_file_name", "FROM z_rates")
_model(
    "stg_meta_ads",
    "ad_id insight_date:d campaign_id campaign_name adset_id ad_name impressions:i clicks:i spend_usd:n2 purchases:n2 purchase_value_usd:n2 pulled_at_utc:t usd_zar_rate:n4 spend_zar:n4 purchase_value_zar:n4 dt:d source_file_name",
    "SELECT *, spend_cents / 100 AS spend_usd, claimed_cents / 100 AS purchase_value_usd FROM z_meta",
)
_model(
    "stg_weather", "city_standard weather_date:d temperature_max_c:n2 temperature_min_c:n2 precipitation_mm:n2 dt:d",
    "SELECT *, hi AS temperature_max_c, lo AS temperature_min_c, rain AS precipitation_mm FROM z_weather",
)
_model("stg_creatives", "ad_id copy_text dt:d source_file_name", "FROM z_copy")
_model(
    "stg_ga4_events",
    "event_fingerprint event_date:d event_timestamp_utc:t event_name user_pseudo_id ga_session_id:i page_location engagement_time_msec:i device_category operating_system city "
    "session_gclid session_srsltid session_fbclid session_campaign_id session_campaign_name session_source session_medium session_content transaction_id ga4_reported_value:n2 "
    "is_internal_traffic:b is_provisional:b arrived_late:b dt:d source_file_name",
    """SELECT *, fp AS event_fingerprint, happened AS event_timestamp_utc, s_gclid AS session_gclid, s_srsltid AS session_srsltid, s_fbclid AS session_fbclid, s_campaign AS session_campaign_id,
       s_name AS session_campaign_name, s_source AS session_source, s_medium AS session_medium, s_content AS session_content, reported AS ga4_reported_value, staff AS is_internal_traffic, provisional AS is_provisional FROM z_events""",
)
_model(
    "int_customer_identity",
    "customer_id customer_key email_hash phone_hash identity_method city_standard created_at_utc:t created_date:d is_guest:b marketing_opt_in:b is_internal_customer:b is_placeholder:b dt:d source_file_name",
    "FROM z_identity",
)
SESSION_SPEC = (
    "session_key user_pseudo_id ga_session_id:i session_start_utc:t session_end_utc:t session_date:d city device_category operating_system customer_id customer_key gclid srsltid fbclid utm_source utm_medium "
    "utm_campaign_id utm_campaign_name utm_content campaign_id ad_id attribution_method attributed_platform transaction_id is_provisional:b event_count:i engagement_time_msec:i dt:d source_file_name"
)
SESSION_SQL = "SELECT *, started AS session_start_utc, ended AS session_end_utc, tag_source AS utm_source, tag_medium AS utm_medium, tag_campaign AS utm_campaign_id, tag_name AS utm_campaign_name, tag_content AS utm_content FROM z_sessions"
_model("int_sessions", SESSION_SPEC, SESSION_SQL)
ORDER_SPEC = (
    "order_id customer_id customer_key order_timestamp_utc:t order_date:d revenue:n2 status session_key session_start_utc:t campaign_id ad_id attributed_platform attribution_method gclid fbclid "
    "exact_transaction_match:b dt:d source_file_name session_source_file_name"
)
ORDER_SQL = "SELECT *, started AS session_start_utc, exact AS exact_transaction_match, session_file AS session_source_file_name FROM z_attributed"
_model("int_orders_attributed", ORDER_SPEC, ORDER_SQL)
_model("int_creative_features", "ad_id copy_text tone discount_pct:i cta product extraction_method dt:d", "SELECT *, 'deterministic_fallback' AS extraction_method FROM z_features")
_model("dim_customer", "customer_key customer_ids identity_count:i city_standard first_created_date:d has_guest_identity:b marketing_opt_in:b is_placeholder:b first_order_timestamp_utc:t first_order_date:d latest_order_timestamp_utc:t lifetime_order_count:i dt:d source_file_name",
       "SELECT *, ids AS customer_ids, first_at AS first_order_timestamp_utc, last_at AS latest_order_timestamp_utc FROM z_people")
_model("dim_campaign", "platform campaign_id current_campaign_name campaign_name_history first_seen_date:d last_seen_date:d dt:d", "SELECT *, history AS campaign_name_history FROM z_campaigns")
_model("dim_ad", "platform ad_id campaign_id ad_group_id ad_name first_seen_date:d last_seen_date:d copy_text tone discount_pct:i cta product", "FROM z_ads")
_model("fct_orders", "date_key:i order_id customer_key completed_revenue:n2 refunded_order_value:n2", "SELECT *, CAST(strftime(order_date, '%Y%m%d') AS INT) AS date_key FROM z_attributed")
_model("fct_sessions", "date_key:i session_key attribution_method event_count:i", "SELECT *, CAST(strftime(session_date, '%Y%m%d') AS INT) AS date_key FROM z_sessions")
_model(
    "fct_ad_spend_daily", "spend_date:d date_key:i platform campaign_id ad_id impressions:i clicks:i spend_zar:n4 claimed_conversions:n2 claimed_revenue_zar:n4 platform_all_conversions:n2 dt:d source_file_name",
    "SELECT *, CAST(strftime(spend_date, '%Y%m%d') AS INT) AS date_key, spend_units / 10000 AS spend_zar, claimed AS claimed_conversions, claimed_units / 10000 AS claimed_revenue_zar, all_conversions AS platform_all_conversions FROM z_spend",
)
_model(
    "dim_date", "calendar_date:d date_key:i calendar_year:i calendar_quarter:i calendar_month:i month_name iso_week:i week_start_date:d month_start_date:d day_of_month:i day_name is_weekend:b",
    """SELECT day AS calendar_date, CAST(strftime(day, '%Y%m%d') AS INT) AS date_key, year(day) AS calendar_year, quarter(day) AS calendar_quarter, month(day) AS calendar_month, monthname(day) AS month_name,
       weekofyear(day) AS iso_week, date_trunc('week', day) AS week_start_date, date_trunc('month', day) AS month_start_date, day(day) AS day_of_month, dayname(day) AS day_name, isodow(day) > 5 AS is_weekend
       FROM (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS day FROM (
           SELECT spend_date AS d FROM z_spend UNION ALL SELECT session_date FROM z_sessions UNION ALL SELECT order_date FROM z_attributed))""",
)
_model(
    "mart_customer_features",
    "customer_key acquisition_date:d acquisition_month:i acquisition_iso_week:i city_standard has_guest_identity:b is_placeholder:b days_from_signup_to_first_order:i acquisition_platform acquisition_campaign_id "
    "acquisition_ad_id acquisition_attribution_method first_order_value:n2 acquisition_creative_tone orders_7d:i completed_orders_7d:i refunded_orders_7d:i completed_revenue_7d:n2 discount_7d:n2 items_7d:i sessions_7d:i "
    "click_id_sessions_7d:i utm_sessions_7d:i distinct_campaigns_7d:i events_7d:i engagement_time_msec_7d:i first_device_category future_value_90d:n2 is_training_eligible:b dt:d source_file_name",
    """SELECT *, month(acquisition_date) AS acquisition_month, weekofyear(acquisition_date) AS acquisition_iso_week, signup_days AS days_from_signup_to_first_order, method AS acquisition_attribution_method,
       tone AS acquisition_creative_tone, clicks_7d AS click_id_sessions_7d, utm_7d AS utm_sessions_7d, campaigns_7d AS distinct_campaigns_7d, engaged_7d AS engagement_time_msec_7d, device AS first_device_category,
       order_file AS source_file_name FROM z_mart_features""",
)
_model(
    "mart_customer_value", "customer_key acquisition_date:d acquisition_platform acquisition_campaign_name predicted_value_90d:n4 value_segment observed_future_value_90d:n2 lifetime_order_count:i is_one_time_buyer:b dt:d",
    """SELECT f.customer_key, acquisition_date, acquisition_platform, c.current_campaign_name AS acquisition_campaign_name, s.predicted AS predicted_value_90d, ['high', 'steady', 'low'][s.tile] AS value_segment,
       future_value_90d AS observed_future_value_90d, lifetime_order_count, lifetime_order_count = 1 AS is_one_time_buyer, f.dt
       FROM z_mart_features f JOIN z_scores s USING (customer_key) LEFT JOIN z_campaigns c ON c.platform = f.acquisition_platform AND c.campaign_id = f.acquisition_campaign_id""",
)
_model(
    "mart_campaign_value",
    "week_start_date:d platform campaign_id campaign_name spend_zar:n4 impressions:i clicks:i claimed_conversions:n2 claimed_revenue_zar:n4 real_orders:i completed_orders:i real_revenue_zar:n2 new_customers:i "
    "first_order_revenue_zar:n2 predicted_value_90d:n4 one_time_buyer_share:n6 platform_roas:n9 actual_roas:n9 value_adjusted_roas:n6 dt:d",
    """SELECT w.*, c.current_campaign_name AS campaign_name, spend_units / 10000 AS spend_zar, claimed_units / 10000 AS claimed_revenue_zar, real_revenue AS real_revenue_zar, first_revenue AS first_order_revenue_zar,
       predicted AS predicted_value_90d, once_share AS one_time_buyer_share, raw_claimed / nullif(raw_spend, 0) AS platform_roas, raw_revenue / (nullif(raw_spend, 0) / 10000) AS actual_roas,
       (CAST(first_revenue AS DOUBLE) + predicted) / (nullif(raw_spend, 0) / 10000) AS value_adjusted_roas, coalesce(s_dt, CAST(week_start_date + 6 AS DATE)) AS dt
       FROM z_campaign_weeks w LEFT JOIN z_campaigns c USING (platform, campaign_id)""",
)
_model(
    "mart_campaign_drivers",
    "week_start_date:d platform campaign_id campaign_name city_standard attributed_sessions:i real_orders:i real_revenue_zar:n2 new_customers:i allocated_spend_zar:n6 city_actual_roas:n6 avg_temperature_max_c:n4 "
    "avg_temperature_min_c:n4 total_precipitation_mm:n2 dominant_tone dominant_cta creative_discount_pct:n4",
    f"""WITH visits AS (SELECT CAST(date_trunc('week', session_date) AS DATE) AS week, attributed_platform AS platform, campaign_id, city, count(*) AS n FROM z_sessions
            WHERE attributed_platform IN ('google', 'meta') AND campaign_id IS NOT NULL AND city IN ({_cities}) GROUP BY ALL),
        sales AS (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, attributed_platform AS platform, campaign_id, p.city_standard AS city, count(*) AS orders, sum(completed_revenue) AS revenue,
                count(DISTINCT customer_key) FILTER (order_date = first_order_date) AS fresh
            FROM z_attributed JOIN (SELECT customer_key, city_standard, first_order_date FROM z_people) p USING (customer_key)
            WHERE attributed_platform IN ('google', 'meta') AND campaign_id IS NOT NULL AND p.city_standard IN ({_cities}) GROUP BY ALL),
        both_sides AS (SELECT * FROM visits FULL JOIN sales USING (week, platform, campaign_id, city)),
        shares AS (SELECT *, n / sum(n) OVER (PARTITION BY week, platform, campaign_id) AS share FROM both_sides),
        sky AS (SELECT CAST(date_trunc('week', weather_date) AS DATE) AS week, city_standard AS city, avg(hi) AS hi, avg(lo) AS lo, sum(rain) AS rain FROM z_weather GROUP BY ALL),
        looks AS (SELECT CAST(date_trunc('week', spend_date) AS DATE) AS week, s.platform, s.campaign_id, a.tone, a.cta, avg(a.discount_pct) AS pct, sum(spend_units) AS units
            FROM z_spend s LEFT JOIN z_ads a ON a.platform = s.platform AND a.ad_id = s.ad_id GROUP BY ALL),
        top_look AS (SELECT DISTINCT ON (week, platform, campaign_id) * FROM looks ORDER BY week, platform, campaign_id, units DESC, tone NULLS FIRST, cta NULLS FIRST)
        SELECT b.week AS week_start_date, b.platform, b.campaign_id, c.current_campaign_name AS campaign_name, b.city AS city_standard, coalesce(n, 0) AS attributed_sessions, coalesce(orders, 0) AS real_orders,
            coalesce(revenue, 0) AS real_revenue_zar, coalesce(fresh, 0) AS new_customers, coalesce(w.spend_units / 10000 * share, 0) AS allocated_spend_zar,
            coalesce(CAST(revenue AS DOUBLE), 0) / nullif(w.spend_units / 10000 * share, 0) AS city_actual_roas, sky.hi AS avg_temperature_max_c, sky.lo AS avg_temperature_min_c, sky.rain AS total_precipitation_mm,
            t.tone AS dominant_tone, t.cta AS dominant_cta, t.pct AS creative_discount_pct
        FROM shares b JOIN z_campaign_weeks w ON w.week_start_date = b.week AND w.platform = b.platform AND w.campaign_id = b.campaign_id JOIN sky ON sky.week = b.week AND sky.city = b.city
        LEFT JOIN top_look t ON t.week = b.week AND t.platform = b.platform AND t.campaign_id = b.campaign_id
        LEFT JOIN z_campaigns c ON c.platform = b.platform AND c.campaign_id = b.campaign_id""",
)
