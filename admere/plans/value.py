"""Early behaviour of acquired customers, 90-day value model, scores and segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admere.functions.values import greatest_or_null, when_amount, within
from admere.operators.spread import global_row_number, ntile, with_scalars
from admere.operators.versions import earliest_by, latest_by
from admere.session import stable, use_checkpoints

FEATURE_DAYS = 7
LABEL_DAYS = 90
LABEL = "future_value_90d"


def order_windows(acquired: DataFrame, orders: DataFrame, key: str = "customer_key") -> DataFrame:
    """Order behaviour of days 0-7, the label of days 8-97 and the first order, in one pass."""
    early = within("order_date", "acquisition_date", 0, FEATURE_DAYS)
    later = within("order_date", "acquisition_date", FEATURE_DAYS + 1, FEATURE_DAYS + LABEL_DAYS)
    completed, refunded = F.col("status") == "completed", F.col("status") == "refunded"
    zero = F.lit(0)
    first = F.struct("attributed_platform", "campaign_id", "ad_id", "attribution_method", "revenue", "completed_revenue", "item_count", "discount")
    joined = orders.join(acquired.select(key, "acquisition_date"), key)
    return joined.groupBy(key).agg(
        earliest_by(first, "order_timestamp_utc", "order_id").alias("first"),
        F.count_if(early).alias("orders_7d"),
        F.count_if(early & completed).alias("completed_orders_7d"),
        F.count_if(early & refunded).alias("refunded_orders_7d"),
        F.sum(when_amount(early, "completed_revenue")).alias("completed_revenue_7d"),
        F.sum(when_amount(early, F.coalesce("discount", zero))).alias("discount_7d"),
        F.sum(when_amount(early, F.coalesce("item_count", zero))).alias("items_7d"),
        F.sum(when_amount(later & completed, "completed_revenue")).alias(LABEL),
        F.max("dt").alias("order_dt"),
        latest_by("source_file_name", "order_timestamp_utc", "order_id", ignore_nulls=True).alias("order_source_file_name"),
    )


def session_windows(acquired: DataFrame, sessions: DataFrame, key: str = "customer_key") -> DataFrame:
    """Session behaviour of days 0-7; customers without such a session are absent."""
    joined = sessions.join(acquired.select(key, "acquisition_date"), key).filter(
        within("session_date", "acquisition_date", 0, FEATURE_DAYS)
    )
    method = F.col("attribution_method")
    return joined.groupBy(key).agg(
        F.count("session_key").alias("sessions_7d"),
        F.count_if(method == "click_id").alias("click_id_sessions_7d"),
        F.count_if(method == "utm").alias("utm_sessions_7d"),
        F.count_distinct("campaign_id").alias("distinct_campaigns_7d"),
        F.sum("event_count").alias("events_7d"),
        F.sum("engagement_time_msec").alias("engagement_time_msec_7d"),
        earliest_by("device_category", "session_start_utc", "session_key", ignore_nulls=True).alias("first_device_category"),
        F.max("dt").alias("session_dt"),
        latest_by("source_file_name", "session_start_utc", "session_key", ignore_nulls=True).alias("session_source_file_name"),
    )


SESSION_COUNTS = ("sessions_7d", "click_id_sessions_7d", "utm_sessions_7d", "distinct_campaigns_7d", "events_7d", "engagement_time_msec_7d")

FEATURE_COLUMNS = (
    "customer_key", "acquisition_date", "acquisition_month", "acquisition_iso_week", "city_standard", "has_guest_identity",
    "marketing_opt_in", "is_placeholder", "days_from_signup_to_first_order", "acquisition_platform", "acquisition_campaign_id",
    "acquisition_ad_id", "acquisition_attribution_method", "first_order_value", "first_order_completed_revenue",
    "first_order_item_count", "first_order_discount", "acquisition_creative_tone", "acquisition_creative_discount_pct",
    "acquisition_creative_cta", "acquisition_creative_product", "orders_7d", "completed_orders_7d", "refunded_orders_7d",
    "completed_revenue_7d", "avg_completed_order_value_7d", "discount_7d", "items_7d", *SESSION_COUNTS,
    "first_device_category", LABEL, "is_training_eligible", "dt", "source_file_name",
)


def training_cutoff(last_day: Column) -> Column:
    """Last acquisition day whose label window has ended."""
    return F.date_sub(last_day, FEATURE_DAYS + LABEL_DAYS)


def mart_customer_features(
    customers: DataFrame, orders: DataFrame, sessions: DataFrame, ads: DataFrame, trained_until: Column | DataFrame
) -> DataFrame:
    """One row per acquired customer. ``trained_until`` is a date or a one-row ``last_day`` relation."""
    acquired = customers.filter(F.col("first_order_date").isNotNull()).withColumn("acquisition_date", F.col("first_order_date"))
    first = lambda c: F.col(f"first.{c}")
    joined = acquired.join(order_windows(acquired, orders), "customer_key").join(session_windows(acquired, sessions), "customer_key", "left")
    copy = ads.select(
        F.col("platform").alias("ad_platform"), F.col("ad_id").alias("ad_key"),
        *[F.col(c).alias(f"acquisition_creative_{c}") for c in ("tone", "discount_pct", "cta", "product")],
    )
    joined = joined.join(copy, (first("attributed_platform") == F.col("ad_platform")) & (first("ad_id") == F.col("ad_key")), "left")
    if isinstance(trained_until, DataFrame):
        joined = with_scalars(joined, trained_until.select(training_cutoff(F.col("last_day")).alias("trained_until")))
        trained_until = F.col("trained_until")
    day = F.col("acquisition_date")
    money = lambda c: F.col(c).cast("decimal(29,9)")
    derived = {
        "acquisition_month": F.month(day),
        "acquisition_iso_week": F.weekofyear(day),
        "days_from_signup_to_first_order": F.datediff(day, F.col("first_created_date")),
        "acquisition_platform": first("attributed_platform"),
        "acquisition_campaign_id": first("campaign_id"),
        "acquisition_ad_id": first("ad_id"),
        "acquisition_attribution_method": first("attribution_method"),
        "first_order_value": first("revenue"),
        "first_order_completed_revenue": first("completed_revenue"),
        "first_order_item_count": first("item_count"),
        "first_order_discount": first("discount"),
        "avg_completed_order_value_7d": F.try_divide(money("completed_revenue_7d"), money("completed_orders_7d")),
        "is_training_eligible": day <= trained_until,
        "source_file_name": F.coalesce("order_source_file_name", "session_source_file_name", "source_file_name"),
        "dt": greatest_or_null("dt", "order_dt", F.coalesce("session_dt", "dt")),
        **{c: F.coalesce(c, F.lit(0).cast("bigint")) for c in SESSION_COUNTS},
    }
    return joined.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FEATURE_COLUMNS])


NUMERIC_INPUTS = (
    "acquisition_month", "acquisition_iso_week", "days_from_signup_to_first_order", "orders_7d", "completed_orders_7d",
    "refunded_orders_7d", "completed_revenue_7d", "avg_completed_order_value_7d", "discount_7d", "items_7d", *SESSION_COUNTS,
)
FLAG_INPUTS = ("has_guest_identity", "marketing_opt_in", "is_placeholder")
TEXT_INPUTS = {
    "city_standard": "Unknown",
    "acquisition_platform": "unattributed",
    "acquisition_attribution_method": "unattributed",
    "first_device_category": "unknown",
}
MISSING_NUMBER = {"days_from_signup_to_first_order": -1.0}


MODEL_INPUTS = (*NUMERIC_INPUTS, *FLAG_INPUTS, *TEXT_INPUTS)


def label_codes(features: DataFrame) -> DataFrame:
    """Number of every label of the text inputs, from 1 in alphabetical order: ``input, label, code``.

    No two labels share a number, however many there are; the table is as long as
    the list of labels and is joined, never held by the driver.
    """
    each = F.array(*[F.struct(F.lit(c).alias("input"), F.coalesce(F.col(c), F.lit(default)).alias("label")) for c, default in TEXT_INPUTS.items()])
    pairs = features.select(F.inline(each)).distinct()
    numbered = global_row_number(pairs, [F.col("input"), F.col("label")], "__row")
    first = numbered.groupBy(F.col("input").alias("__input")).agg(F.min("__row").alias("__first"))
    return numbered.join(first, F.col("input") == F.col("__input")).select("input", "label", (F.col("__row") - F.col("__first") + 1).cast("double").alias("code"))


def with_codes(features: DataFrame, codes: DataFrame) -> DataFrame:
    """Add ``code_<input>`` for every text input; a label not learnt is 0."""
    for c, default in TEXT_INPUTS.items():
        known = codes.filter(F.col("input") == c).select(F.col("label").alias("__label"), F.col("code").alias(f"code_{c}"))
        features = features.join(known, F.coalesce(F.col(c), F.lit(default)) == F.col("__label"), "left").drop("__label")
    return features.fillna(0.0, [f"code_{c}" for c in TEXT_INPUTS])


def model_inputs(features: DataFrame, codes: DataFrame) -> DataFrame:
    """Model columns with the constants that stand for a missing value; keys stay beside them."""
    return with_codes(features, codes).select(
        *features.columns,
        *[F.coalesce(F.col(c).cast("double"), F.lit(MISSING_NUMBER.get(c, 0.0))).alias(f"in_{c}") for c in NUMERIC_INPUTS],
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"in_{c}") for c in FLAG_INPUTS],
        *[F.col(f"code_{c}").alias(f"in_{c}") for c in TEXT_INPUTS],
    )


def holdout(key: Column | str, percent: int = 20) -> Column:
    """True for a fixed share of keys, the same on every run and partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    bucket = F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("bigint") % 100
    return bucket < percent


@dataclass
class ValueModel:
    fitted: PipelineModel
    inputs: list[str]
    losses: list[float]
    codes: DataFrame

    def score(self, features: DataFrame) -> DataFrame:
        """Features with ``prediction``."""
        scored = self.fitted.transform(model_inputs(features, self.codes))
        return scored.select(*features.columns, F.col("prediction").alias("prediction"))

    def training_info(self, spark) -> DataFrame:
        """Holdout loss after each iteration; one row per tree of the model."""
        return spark.createDataFrame([(i + 1, x) for i, x in enumerate(self.losses)], "iteration int, eval_loss double")

    def feature_info(self, spark) -> DataFrame:
        """Input columns with their importance."""
        weights = self.fitted.stages[-1].featureImportances.toArray().tolist()
        rows = list(zip(self.inputs, weights))
        return spark.createDataFrame(rows, "input string, importance double")


def train(features: DataFrame, key: str = "customer_key", iterations: int = 50, seed: int = 7) -> ValueModel:
    """Boosted trees on the mature cohort, stopped early on the holdout."""
    learnt = features.filter(F.col("is_training_eligible"))
    # Scores are asked for after training, so the codes are written out.
    codes = stable(label_codes(learnt))
    frame = model_inputs(learnt, codes)
    frame = frame.withColumn("label", F.col(LABEL).cast("double")).withColumn("is_holdout", holdout(key))
    assembler = VectorAssembler(inputCols=[f"in_{c}" for c in MODEL_INPUTS], outputCol="features")
    trees = GBTRegressor(
        featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=iterations, seed=seed,
        validationTol=0.001, cacheNodeIds=True, maxMemoryInMB=256,
    )
    # Training passes over this frame many times; it is kept while they last.
    use_checkpoints(features.sparkSession)
    assembled = assembler.transform(frame).select("features", "label", "is_holdout").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sides = assembled.agg(F.bool_or("is_holdout").alias("held"), F.bool_and("is_holdout").alias("only")).first()
        # A cohort too small to fall on both sides trains without early stopping.
        split = bool(sides["held"]) and not sides["only"]
        fitted = (trees.setValidationIndicatorCol("is_holdout") if split else trees).fit(assembled)
        losses = fitted.evaluateEachIteration(assembled.filter("is_holdout") if split else assembled, "squared")
    finally:
        assembled.unpersist()
    return ValueModel(PipelineModel([assembler, fitted]), list(MODEL_INPUTS), list(losses), codes)


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Error measures of a regression as one row.

    The median is the middle error, the lower one of two: its rank is found in a
    sort over range partitions, so it is exact however many rows there are.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    log_gap = F.log1p(F.greatest(y, F.lit(0.0))) - F.log1p(F.greatest(p, F.lit(0.0)))
    both = scored.filter(y.isNotNull() & p.isNotNull())
    ranked = global_row_number(both.select(F.abs(error).alias("__gap")), [F.col("__gap")], "__rank")
    middle = with_scalars(ranked, ranked.agg(F.max("__rank").alias("__n"))).filter(F.col("__rank") == F.ceil(F.col("__n") / 2))
    row = both.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(error * error).alias("mean_squared_error"),
        F.avg(log_gap * log_gap).alias("mean_squared_log_error"),
        F.var_pop(y).alias("__spread"),
        F.var_pop(error).alias("__left"),
    )
    return with_scalars(row, middle.agg(F.max("__gap").alias("median_absolute_error"))).select(
        "mean_absolute_error", "mean_squared_error", "mean_squared_log_error", "median_absolute_error",
        (1 - F.try_divide(F.col("mean_squared_error"), F.col("__spread"))).alias("r2_score"),
        (1 - F.try_divide(F.col("__left"), F.col("__spread"))).alias("explained_variance"),
    )


def evaluate(model: ValueModel, features: DataFrame, key: str = "customer_key") -> DataFrame:
    """Measures on the holdout of the training cohort."""
    held = features.filter(F.col("is_training_eligible") & holdout(key))
    return regression_metrics(model.score(held), LABEL, "prediction")


def segments(scored: DataFrame, value: str, key: str, names: tuple[str, ...] = ("high", "steady", "low")) -> DataFrame:
    """Equal-sized segments by descending value, ties by key."""
    tiled = ntile(scored, len(names), [F.col(value).desc(), F.col(key).asc()], "__tile")
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("__tile"))
    return tiled.withColumn("value_segment", label).drop("__tile")


def ml_customer_pltv(model: ValueModel, features: DataFrame, last_day: DataFrame, scored_at: Column) -> DataFrame:
    """Scores of every customer seen for at least seven days; ``last_day`` has one row."""
    ripe = with_scalars(features, last_day.select("last_day")).filter(
        F.col("acquisition_date") <= F.date_sub("last_day", FEATURE_DAYS)
    )
    scored = model.score(ripe.drop("last_day")).select(
        "customer_key", "acquisition_date", "city_standard", "acquisition_platform", "acquisition_campaign_id",
        "acquisition_ad_id", "acquisition_attribution_method", "completed_revenue_7d", "sessions_7d",
        F.col(LABEL).alias("observed_future_value_90d"),
        F.col("prediction").alias("predicted_future_value_90d_raw"),
        greatest_or_null("prediction", F.lit(0.0)).alias("predicted_future_value_90d"),
        "dt", "source_file_name",
    )
    return segments(scored, "predicted_future_value_90d", "customer_key").withColumn("scored_at_utc", scored_at)
