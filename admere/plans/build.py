"""The whole pipeline: read a landing root, write every table, check, report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admere.functions.values import DEFAULT_ZONE
from admere.operators.checks import assert_empty, scorecard, snapshot
from admere.plans import conformed, incremental, marts, monitoring, propagate, staging, star, value
from admere.session import prepare
from admere.sources.files import city_mapping, internal_domains, land, read_landing
from admere.sources.tables import append_snapshot, existing, write_full


class Build:
    """Tables below ``root``; each is written once and read back by its followers."""

    def __init__(self, spark: SparkSession, landing: str, root: str, domains: Sequence[str], zone: str = DEFAULT_ZONE):
        self.spark, self.root, self.zone = prepare(spark), root.rstrip("/"), zone
        self.raw = read_landing(spark, landing)
        self.domains = internal_domains(spark, domains)
        self.tables: dict[str, DataFrame] = {}
        #: Tables with versions, since daily loads change parts of them.
        self.versioned = {
            "stg_ga4_events": incremental.event_table(spark, self.path("stg_ga4_events")),
            "stg_meta_ads": incremental.ad_table(spark, self.path("stg_meta_ads")),
            **propagate.tables(spark, self.root),
        }

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame, partition: str | None = None, cluster: Sequence[str] = ()) -> DataFrame:
        if name in self.versioned:
            self.versioned[name].replace(df)
        else:
            write_full(df, self.path(name), partition, cluster)
        return self.load(name)

    def load(self, name: str) -> DataFrame:
        table = self.versioned.get(name)
        self.tables[name] = table.read() if table else self.spark.read.parquet(self.path(name))
        return self.tables[name]

    def silver(self, full_refresh: bool = True, answer: Callable | None = None, last_day: str | None = None) -> dict[str, DataFrame]:
        """Staging and conformed tables. Without ``full_refresh`` events and ads load incrementally, sessions and orders after them."""
        raw, t = self.raw, self.tables
        self.write("stg_crm_customers", staging.crm_customers(raw["crm_customers"], city_mapping(self.spark), self.domains, self.zone))
        self.write("stg_crm_orders", staging.crm_orders(raw["crm_orders"], t["stg_crm_customers"], self.zone))
        self.write("stg_crm_order_items", staging.crm_order_items(raw["crm_order_items"]))
        self.write("stg_google_clicks", staging.google_clicks(raw["google_ads_clicks"]))
        self.write("stg_google_ads_performance", staging.google_ads_performance(raw["google_ads_performance_raw"]))
        self.write("stg_fx_rates", staging.fx_rates(raw["fx_rates"], last=last_day))
        self.write("quarantine_meta_ads", staging.quarantine_meta_ads(raw["meta_ads_insights_raw"]))
        self.write("stg_weather", staging.weather(raw["weather_daily"]))
        self.write("stg_creatives", staging.creatives(raw["creative_copy_raw"]))
        if full_refresh:
            self.write("stg_meta_ads", staging.meta_ads(raw["meta_ads_insights_raw"], t["stg_fx_rates"]))
            # Detectors read the landed rows, too.
            raw["ga4_events"] = land(raw["ga4_events"])
            self.write("stg_ga4_events", staging.ga4_events(raw["ga4_events"], self.zone))
        else:
            incremental.load_meta_ads(raw["meta_ads_insights_raw"], t["stg_fx_rates"], self.versioned["stg_meta_ads"])
            incremental.load_events(raw["ga4_events"], self.versioned["stg_ga4_events"], zone=self.zone)
            self.load("stg_meta_ads"), self.load("stg_ga4_events")
        self.write("int_customer_identity", conformed.customer_identity(t["stg_crm_customers"], t["stg_crm_orders"]))
        propagate.conform(
            self.versioned, self.versioned["stg_ga4_events"], t["stg_crm_orders"], t["int_customer_identity"], t["stg_google_clicks"], t["stg_meta_ads"], full_refresh)
        self.load("int_sessions"), self.load("int_orders_attributed")
        self.write("int_creative_features", conformed.creative_features(t["stg_creatives"], answer))
        return t

    def star(self, full_refresh: bool = True) -> dict[str, DataFrame]:
        t = self.tables
        google, meta = t["stg_google_ads_performance"], t["stg_meta_ads"]
        propagate.facts(self.versioned, full_refresh)
        self.load("fct_orders"), self.load("fct_sessions")
        self.write("fct_ad_spend_daily", star.fct_ad_spend_daily(google, meta))
        self.write("dim_date", star.dim_date([
            (google, "performance_date"), (meta, "insight_date"), (t["int_sessions"], "session_date"), (t["int_orders_attributed"], "order_date")]))
        self.write("dim_customer", star.dim_customer(t["int_customer_identity"], t["int_orders_attributed"], self.zone))
        self.write("dim_campaign", star.dim_campaign(google, meta))
        self.write("dim_ad", star.dim_ad(google, meta, t["int_creative_features"]))
        return t

    def check(self, blocking: bool = True) -> list[str]:
        """Names of the broken rules; the first one stops a blocking run."""
        return [name for name, rows in monitoring.violations(self.tables).items() if not assert_empty(rows, name, blocking)]

    def gold(self, trained_until: str | None = None, scored_at: str | None = None) -> value.ValueModel:
        """Feature mart, model, scores and marts."""
        t = self.tables
        last_day = t["dim_date"].agg(F.max("calendar_date").alias("last_day"))
        until = F.lit(trained_until).cast("date") if trained_until else last_day
        features = self.write("mart_customer_features", value.mart_customer_features(
            t["dim_customer"], t["fct_orders"], t["fct_sessions"], t["dim_ad"], until))
        model = value.train(features)
        stamp = F.lit(scored_at).cast("timestamp") if scored_at else F.current_timestamp()
        self.write("ml_customer_pltv_evaluation", value.evaluate(model, features).select(stamp.alias("evaluated_at_utc"), "*"))
        self.write("ml_customer_pltv", value.ml_customer_pltv(model, features, last_day, stamp))
        self.write("mart_customer_value", marts.mart_customer_value(t["ml_customer_pltv"], features, t["dim_customer"], t["dim_campaign"]))
        self.write("mart_campaign_value", marts.mart_campaign_value(
            t["fct_ad_spend_daily"], t["fct_orders"], t["dim_customer"], t["mart_customer_value"], t["dim_campaign"]))
        self.write("mart_campaign_drivers", marts.mart_campaign_drivers(
            t["fct_sessions"], t["fct_orders"], t["dim_customer"], t["stg_weather"], t["fct_ad_spend_daily"], t["dim_ad"], t["mart_campaign_value"]))
        return model

    def story(self) -> DataFrame:
        return marts.campaign_story(self.tables["mart_campaign_value"])

    def findings(self) -> DataFrame:
        """The detectors on the delivered data, before anything of them is written."""
        return monitoring.detectors(self.raw, self.tables["stg_google_ads_performance"], self.domains)

    def monitor(self, run_at: str | None = None, manifest: DataFrame | None = None) -> DataFrame:
        """Append a snapshot of the detectors; with a truth manifest also write the scorecard."""
        path = self.path("ops_dq_results")
        history = existing(self.spark, path)
        found = self.findings()
        stamp = F.lit(run_at).cast("timestamp") if run_at else F.current_timestamp()
        append_snapshot(snapshot(found, history, stamp, self.zone), path)
        results = self.load("ops_dq_results")
        return results if manifest is None else self.write("ops_dq_scorecard", scorecard(results, manifest))

    def vacuum(self, keep: int = 3) -> None:
        """Remove old versions of all versioned tables; readers of older ones must have ended."""
        for table in self.versioned.values():
            table.vacuum(keep)

    def run(self, full_refresh: bool = True, **gold) -> DataFrame:
        self.silver(full_refresh)
        self.star(full_refresh)
        self.check()
        self.gold(**gold)
        return self.story()
