"""A small hand-written landing zone with one example of every known defect."""

import gzip
import json
import pathlib

ZONE_NOTE = "local time is UTC+2"


def put(root: pathlib.Path, path: str, text: str) -> None:
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)


def micros(text: str) -> int:
    import datetime

    at = datetime.datetime.fromisoformat(text).replace(tzinfo=datetime.timezone.utc)
    return int(at.timestamp()) * 1_000_000 + at.microsecond


def parameter(key, **slots):
    value = {"string_value": None, "int_value": None, "float_value": None, "double_value": None}
    value.update(slots)
    return {"key": key, "value": value}


def event(day, at, name, visitor, session, location="https://shop.example/p", tx=None, value=None, tags=None, staff=False, city="Durban", extra=()):
    parameters = [parameter("ga_session_id", int_value=session), parameter("page_location", string_value=location)]
    if value is not None:
        parameters.append(parameter("value", **value))
    if staff:
        parameters.append(parameter("traffic_type", string_value="Internal"))
    parameters.extend(extra)
    parameters.append(parameter("engagement_time_msec", int_value=100))
    return json.dumps({
        "event_date": day, "event_timestamp": micros(at), "event_name": name, "user_pseudo_id": visitor, "event_params": parameters[::-1],
        "device": {"category": "mobile", "operating_system": "iOS"}, "geo": {"country": "ZA", "city": city},
        "collected_traffic_source": tags or {}, "ecommerce": {"transaction_id": tx} if tx else None, "items": [],
    })


def put_events(root, dt, lines):
    target = root / f"ga4/dt={dt}/events.ndjson.gz"
    target.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(target, "wt") as f:
        f.write("\n".join(lines) + "\n")


CUSTOMERS = "customer_id,email,first_name,last_name,phone,city,created_at,is_guest,marketing_opt_in\n"
ORDERS = "order_id,customer_id,order_ts,currency,subtotal,discount,revenue,status,item_count,updated_at\n"
ITEMS = "order_id,sku,product_name,unit_price,quantity\n"
CLICKS = "segments_date,click_view_gclid,campaign_id,ad_group_id,ad_group_ad_ad_id,click_view_area_of_interest_city\n"
OLD = "segments_date,customer_id,campaign_id,campaign_name,ad_group_id,ad_group_name,ad_group_ad_ad_id,metrics_impressions,metrics_clicks,metrics_cost_micros,metrics_conversions,metrics_conversions_value\n"
NEW = OLD.replace("metrics_conversions,", "metrics_all_conversions,metrics_conversions,", 1)
RATES = "rate_date,base_currency,quote_currency,rate\n"


def insight(day, pulled, spend, purchases, value=None, ad="m1", name="Winter"):
    row = {
        "account_id": "a", "account_currency": "USD", "date_start": day, "date_stop": day, "campaign_id": "M1", "campaign_name": name,
        "adset_id": "s1", "adset_name": "set", "ad_id": ad, "ad_name": "Ad", "impressions": "1000", "clicks": "10", "spend": spend,
        "actions": [{"action_type": "link_click", "value": "9"}, {"action_type": "offsite_conversion.fb_pixel_purchase", "value": purchases}],
        "attribution_setting": "7d", "_pulled_at": pulled,
    }
    if value is not None:
        row["action_values"] = [{"action_type": "offsite_conversion.fb_pixel_purchase", "value": value}]
    return json.dumps(row)


def weather(days, hi, lo, rain):
    return json.dumps({
        "latitude": -29.8, "longitude": 31.0, "elevation": 8.0, "timezone": "Africa/Johannesburg", "utc_offset_seconds": 7200,
        "daily": {"time": days, "temperature_2m_max": hi, "temperature_2m_min": lo, "precipitation_sum": rain},
    })


def deliver(root: pathlib.Path) -> None:
    # Customers: one person as guest and registered, blank e-mail, phone forms, padded e-mail, spellings, staff.
    put(root, "crm/dt=2026-03-02/customers.csv", CUSTOMERS
        + "c1, Ann@Mail.example ,Ann,A,+27 82 555 0142,CPT,2026-03-01 10:00:00,false,true\n"
        + "c2,,Ann,A,082 555 0142,cape-town,2026-03-02 09:00:00,true,false\n"
        + "qa,bot@staff.example,Q,A,0027820000001,Durban,2026-03-01 08:00:00,false,false\n"
        + "c3,bob@mail.example,Bob,B,831112222, jozi ,2026-03-02 11:00:00,false,\n")
    put(root, "crm/dt=2026-03-03/customers.csv", CUSTOMERS + "c3,bob@mail.example,Bob,B,831112222,Johannesburg,2026-03-02 11:00:00,false,true\n"
        + "c4,cat@mail.example,Cat,C,0841234567,Durban,2026-03-02 20:00:00,false,true\n")
    # Orders: file content twice, refund days later, QA order of 1.00, customer one day late, a customer never delivered.
    first = ("o1,c1,2026-03-02 10:00:00,ZAR,500,0,500.00,completed,2,2026-03-02 10:00:00\n"
             "o2,c3,2026-03-02 12:00:00,ZAR,300,20,280.00,completed,1,2026-03-02 12:00:00\n"
             "o3,qa,2026-03-02 13:00:00,ZAR,1,0,1.00,completed,1,2026-03-02 13:00:00\n"
             "o4,c4,2026-03-02 21:00:00,ZAR,900,0,900.00,completed,3,2026-03-02 21:00:00\n")
    put(root, "crm/dt=2026-03-02/orders.csv", ORDERS + first + first)
    put(root, "crm/dt=2026-03-06/orders.csv", ORDERS
        + "o2,c3,2026-03-02 12:00:00,ZAR,300,20,280.00,refunded,1,2026-03-06 09:00:00\n"
        + "o5,c2,2026-03-09 22:30:00,ZAR,200,0,200.00,completed,1,2026-03-09 22:30:00\n"
        + "o6,ghost,2026-03-06 08:00:00,ZAR,50,0,50.00,completed,1,2026-03-06 08:00:00\n"
        + "o7,c1,2026-03-12 08:00:00,ZAR,700,0,700.00,completed,1,2026-03-12 08:00:00\n")
    put(root, "crm/dt=2026-03-02/order_items.csv", ITEMS + "o1,k1,Tent,250,2\no1,k1,Tent,250,2\no2,k2, ,300,1\no4,k3,Boot,bad,3\n")
    put(root, "google_ads/dt=2026-03-03/click_view.csv", CLICKS + "2026-03-02,g-1,G1,grp,a1,Durban\n2026-03-02,g-1,G1,grp,a1,Durban\n")
    # Two header layouts, a renamed campaign with the same id, a blank line.
    put(root, "google_ads/dt=2026-03-03/ad_performance.csv", OLD + "2026-03-02,acc,G1,Brand,grp,Group,a1,100,5,2500000,2,900.50\n\n")
    put(root, "google_ads/dt=2026-03-10/ad_performance.csv", NEW + "2026-03-09,acc,G1,Brand new,grp,Group,a1,200,6,3500000,9,3,1200\n")
    # Two pulls of one day, a truncated line, no action_values, an empty line.
    put(root, "meta_ads/dt=2026-03-03/insights.jsonl", insight("2026-03-02", "2026-03-03 06:00:00", "10.50", "1", "40.00") + "\n"
        + insight("2026-03-02", "2026-03-03 06:00:00", "8.00", "1", ad="m2")[:60] + "\n\n")
    put(root, "meta_ads/dt=2026-03-04/insights.jsonl", insight("2026-03-02", "2026-03-04 06:00:00", "10.50", "3", "90.00") + "\n"
        + insight("2026-03-07", "2026-03-04 06:00:00", "5.00", "0", ad="m2") + "\n")
    # Friday has a rate, the weekend files hold only a header.
    put(root, "fx_rates/dt=2026-03-02/usd_zar.csv", RATES + "2026-03-02,USD,ZAR,18.50\n")
    put(root, "fx_rates/dt=2026-03-06/usd_zar.csv", RATES + "2026-03-06,USD,ZAR,19.00\n")
    put(root, "fx_rates/dt=2026-03-07/usd_zar.csv", RATES)
    put(root, "fx_rates/dt=2026-03-08/usd_zar.csv", RATES)
    days = ["2026-03-02", "2026-03-03"]
    put(root, "weather/dt=2026-03-04/durban.json", weather(days, [28.0, 29.0], [20.0, 21.0], [0.0]))
    put(root, "weather/dt=2026-03-05/durban.json", weather(["2026-03-03"], [30.0], [22.0], [4.5]))
    put(root, "weather/dt=2026-03-04/cape_town.json", weather(days, [25.0, 24.0], [15.0, 14.0], [1.0, 2.0]))
    put(root, "creatives/dt=2026-03-01/ad_a1/copy.txt", "  \nMade for rain: Karoo fleece. Learn more.\n")
    put(root, "creatives/dt=2026-03-05/ad_a1/copy.txt", "Last chance! 30% off Karoo fleece. Shop now.\n")
    put(root, "creatives/dt=2026-03-01/ad_m1/copy.txt", "Some trails change you. Claim the offer.\n")
    # Events: click id on the landing page only, repeated purchase, re-sent and late events, staff, a value in cents, 22:30 UTC.
    put_events(root, "2026-03-02", [
        event("20260302", "2026-03-02 09:30:00", "session_start", "v1", 1, "https://shop.example/?GCLID=g-1&utm_source=Google"),
        event("20260302", "2026-03-02 10:00:05", "purchase", "v1", 1, tx="o1", value={"double_value": 500.0}),
        event("20260302", "2026-03-02 10:05:00", "purchase", "v1", 1, tx="o1", value={"double_value": 500.0}),
        event("20260302", "2026-03-02 08:00:00", "page_view", "staff", 7, staff=True),
        event("20260303", "2026-03-02 22:30:00", "page_view", "v3", 4),
        event("20260302", "2026-03-02 11:00:00", "session_start", "v2", 2, "https://shop.example/?fbclid=f&utm_source=Facebook&utm_content=m1"),
        event("20260302", "2026-03-02 12:00:30", "purchase", "v2", 2, value={"int_value": 28000}, extra=[parameter("transaction_id", string_value="o2")]),
    ])
    put_events(root, "2026-03-03", [
        # Re-sent.
        event("20260302", "2026-03-02 09:30:00", "session_start", "v1", 1, "https://shop.example/?GCLID=g-1&utm_source=Google"),
        # One day late, brings a tag to a known session.
        event("20260302", "2026-03-02 11:30:00", "view_item", "v2", 2, tags={"manual_term": "boots"}),
        # The earlier original of a purchase loaded below on the day before.
        event("20260303", "2026-03-03 10:00:00", "page_view", "v1", 3),
    ])
    put_events(root, "2026-03-04", [
        event("20260302", "2026-03-02 10:00:01", "purchase", "v1", 1, tx="o1", value={"double_value": 500.0}),
        event("20260304", "2026-03-04 07:00:00", "page_view", "v2", 5, "https://shop.example/?utm_source=Newsletter&utm_medium=email"),
    ])
    put_events(root, "2026-03-10", [event("20260310", "2026-03-09 22:00:00", "page_view", "v1", 9, "https://shop.example/?utm_source=Newsletter")])
