"""Fixed input schemas of the delivered files."""

from __future__ import annotations

DELIVERED_TEXT = {
    "google_ads_clicks": ("segments_date", "click_view_gclid", "campaign_id", "ad_group_id", "ad_group_ad_ad_id", "click_view_area_of_interest_city"),
    "crm_customers": ("customer_id", "email", "first_name", "last_name", "phone", "city", "created_at", "is_guest", "marketing_opt_in"),
    "crm_orders": ("order_id", "customer_id", "order_ts", "currency", "subtotal", "discount", "revenue", "status", "item_count", "updated_at"),
    "crm_order_items": ("order_id", "sku", "product_name", "unit_price", "quantity"),
    "fx_rates": ("rate_date", "base_currency", "quote_currency", "rate"),
}

EVENT_SCHEMA = """
    event_date STRING, event_timestamp BIGINT, event_name STRING, user_pseudo_id STRING,
    event_params ARRAY<STRUCT<key: STRING, value: STRUCT<
        string_value: STRING, int_value: BIGINT, float_value: DOUBLE, double_value: DOUBLE>>>,
    device STRUCT<category: STRING, operating_system: STRING>,
    geo STRUCT<country: STRING, city: STRING>,
    collected_traffic_source STRUCT<manual_campaign_id: STRING, manual_campaign_name: STRING,
        manual_source: STRING, manual_medium: STRING, manual_term: STRING, manual_content: STRING,
        gclid: STRING, dclid: STRING, srsltid: STRING>,
    ecommerce STRUCT<transaction_id: STRING, purchase_revenue: DOUBLE, total_item_quantity: BIGINT>,
    items ARRAY<STRUCT<item_id: STRING, item_name: STRING, price: DOUBLE, quantity: BIGINT>>
"""

WEATHER_SCHEMA = """
    latitude DOUBLE, longitude DOUBLE, generationtime_ms DOUBLE, elevation DOUBLE,
    utc_offset_seconds BIGINT, timezone STRING, timezone_abbreviation STRING,
    daily_units STRUCT<time: STRING, temperature_2m_max: STRING, temperature_2m_min: STRING, precipitation_sum: STRING>,
    daily STRUCT<time: ARRAY<STRING>, temperature_2m_max: ARRAY<DOUBLE>,
        temperature_2m_min: ARRAY<DOUBLE>, precipitation_sum: ARRAY<DOUBLE>>
"""

#: Table -> (folder below the landing root, file name pattern).
LOCATIONS = {
    "google_ads_performance_raw": ("google_ads", "ad_performance.csv"),
    "google_ads_clicks": ("google_ads", "click_view.csv"),
    "meta_ads_insights_raw": ("meta_ads", "insights.jsonl"),
    "ga4_events": ("ga4", "events.ndjson*"),
    "crm_customers": ("crm", "customers.csv"),
    "crm_orders": ("crm", "orders.csv"),
    "crm_order_items": ("crm", "order_items.csv"),
    "creative_copy_raw": ("creatives", "copy.txt"),
    "weather_daily": ("weather", "*.json"),
    "fx_rates": ("fx_rates", "usd_zar.csv"),
}

#: Table -> how often it must be delivered.
CADENCE = {t: "EVENT_DRIVEN" if t == "creative_copy_raw" else "DAILY" for t in LOCATIONS} | {"crm_customers": "DAILY_SECURED"}

# Free-text city spellings and the city they mean.
CITY_SPELLINGS = {
    "Cape Town": ("cape town", "capetown", "cpt", "kaapstad"),
    "Johannesburg": ("johannesburg", "joburg", "jhb", "jozi"),
    "Durban": ("dbn", "durban", "durbs", "ethekwini"),
}
CITIES = tuple(CITY_SPELLINGS)
WEATHER_FILE_CITIES = {"cape_town": "Cape Town", "johannesburg": "Johannesburg", "durban": "Durban"}
