from admere.plans import monitoring

PARAMETER = "struct<key:string,value:struct<string_value:string,int_value:bigint,float_value:double,double_value:double>>"
EVENTS = f"event_date string, event_timestamp long, event_name string, user_pseudo_id string, event_params array<{PARAMETER}>, ecommerce struct<transaction_id:string,purchase_revenue:double>, dt string"
ORDERS = "order_id string, customer_id string, order_ts string, currency string, subtotal string, discount string, revenue string, status string, item_count string, updated_at string, dt string, source_file_name string"


def event(at, name, user, session, order=None, value=None, traffic=None, day="2024-03-01"):
    parameters = [("ga_session_id", (None, session, None, None)), ("value", (None, None, None, value)), ("traffic_type", (traffic, None, None, None))]
    return day.replace("-", ""), at, name, user, parameters, (order, None), day


def test_event_parameters_are_searched_once(spark, tmp_path):
    """Re-sent purchases, odd values and staff sessions come from one pass over the parameters of all events."""
    rows = [
        *[event(1, "purchase", "a", 1, "o1", 100.0)] * 2,
        event(2, "purchase", "b", 2, "o2", 500.0),
        event(3, "purchase", "c", 3, "o3", 90.0, "Internal"),
        *[event(4, "page_view", "c", 3, traffic="internal")] * 2,
        event(5, "page_view", "c", 4, traffic="INTERNAL"),
        event(6, "page_view", "d", 5, traffic="external"),
        event(7, "page_view", None, None, day="2024-03-09"),
        event(8, None, "e", 6),
    ]
    events = spark.createDataFrame(rows, EVENTS).withColumn("dt", monitoring.F.to_date("dt"))
    events.write.parquet(str(tmp_path / "events"))
    orders = [(f"o{i}", "k", "2024-03-01 10:00:00", "ZAR", "100", "0", "100", "completed", "1", "2024-03-01 10:00:00", "2024-03-01", "f") for i in (1, 2, 3)]
    orders = spark.createDataFrame(orders, ORDERS).withColumn("dt", monitoring.F.to_date("dt"))
    found = monitoring.event_findings(monitoring.monitored_events(spark.read.parquet(str(tmp_path / "events"))), orders)
    assert {r.dq_code: (r.detected_count, str(r.source_max_dt)) for r in found.collect()} == {"DQ02": (1, "2024-03-09"), "DQ06": (1, "2024-03-01"), "DQ08": (2, "2024-03-09")}
    plan = found._jdf.queryExecution().toString()
    assert "Subquery" in plan and "ReadSchema" in plan and "event_params:array" not in plan
