"""Features of ad copy: prompt text, ordered rules and checks on model replies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from admere.functions.clean import col, strip_code_fence

# Answer classes, the phrases that select them, product names.
TONES = ("urgent", "informative", "aspirational", "playful")
CALLS = ("shop_now", "learn_more", "get_offer", "sign_up")
TONE_PHRASES = {
    "urgent": r"last chance|won't wait|ends sunday",
    "informative": r"made for|built for|with .+",
    "aspirational": r"some trails change you",
}
CALL_PHRASES = {
    "shop_now": r"shop now",
    "learn_more": r"learn more",
    "get_offer": r"claim the offer",
}
PRODUCTS = (
    "Drakensberg shell jacket",
    "Cederberg hiking boots",
    "Karoo fleece",
    "Tsitsikamma rain pants",
    "Table Mountain daypack",
)
DISCOUNT_PATTERN = r"(?i)(\d+)%\s+off"


def classify(text: Column, phrases: dict[str, str], default: str | None) -> Column:
    """Label of the first phrase pattern found, in the order given."""
    rules: Column | None = None
    for label, pattern in phrases.items():
        rules = F.when(text.rlike(pattern), label) if rules is None else rules.when(text.rlike(pattern), label)
    return rules.otherwise(F.lit(default))


def rule_tone(copy: Column | str, phrases: dict[str, str] = TONE_PHRASES, default: str = "playful") -> Column:
    return classify(F.lower(col(copy)), phrases, default)


def rule_call(copy: Column | str, phrases: dict[str, str] = CALL_PHRASES, default: str = "sign_up") -> Column:
    return classify(F.lower(col(copy)), phrases, default)


def rule_product(copy: Column | str, products: tuple[str, ...] = PRODUCTS) -> Column:
    return classify(col(copy), {p: p for p in products}, None)


def stated_discount(copy: Column | str) -> Column:
    return F.regexp_extract(col(copy), DISCOUNT_PATTERN, 1).try_cast("bigint")


def prompt_text(copy: Column | str, tones: tuple[str, ...] = TONES, calls: tuple[str, ...] = CALLS) -> Column:
    """Question for a text model about one advertisement."""
    lead = (
        "Describe this advertisement as one JSON object with the keys "
        f"tone ({', '.join(tones)}), discount_pct (0 to 100, 0 if none is stated), "
        f"cta ({', '.join(calls)}) and product. Advertisement: "
    )
    return F.concat(F.lit(lead), col(copy))


def features(df: DataFrame, copy: str = "copy_text", reply: str = "model_response", status: str = "model_status") -> DataFrame:
    """Checked features: a valid model answer first, else the rules.

    ``extraction_method`` says whether the model alone supplied all of them.
    """
    answer = F.try_parse_json(strip_code_fence(reply))
    field = lambda name: F.try_variant_get(answer, f"$.{name}", "string")
    parsed = (
        df.withColumn("__tone", F.lower(field("tone")))
        .withColumn("__pct", field("discount_pct").try_cast("bigint"))
        .withColumn("__cta", F.lower(field("cta")))
        .withColumn("__product", F.nullif(F.trim(field("product")), F.lit("")))
    )
    tone_ok, cta_ok = F.col("__tone").isin(*TONES), F.col("__cta").isin(*CALLS)
    complete = (F.coalesce(F.col(status), F.lit("")) == "") & tone_ok & cta_ok & F.col("__product").isNotNull()
    return (
        parsed.withColumn("tone", F.when(tone_ok, F.col("__tone")).otherwise(rule_tone(copy)))
        .withColumn("discount_pct", F.coalesce(F.col("__pct"), stated_discount(copy), F.lit(0).cast("bigint")))
        .withColumn("cta", F.when(cta_ok, F.col("__cta")).otherwise(rule_call(copy)))
        .withColumn("product", F.coalesce(F.col("__product"), rule_product(copy)))
        .withColumn("extraction_method", F.when(complete, "model").otherwise("deterministic_fallback"))
        .drop("__tone", "__pct", "__cta", "__product")
    )


def enrich(df: DataFrame, answer: Callable | None = None, copy: str = "copy_text") -> DataFrame:
    """Ask a text model about every row.

    ``answer(prompts: pandas.Series) -> (responses, statuses)`` runs once per
    Arrow batch inside the tasks. Without it the reply is NULL and the rules of
    :func:`features` decide.
    """
    asked = df.withColumn("prompt", prompt_text(copy))
    if answer is None:
        return asked.withColumn("model_response", F.lit(None).cast("string")).withColumn(
            "model_status", F.lit("").cast("string")
        )
    answers = [T.StructField(name, T.StringType()) for name in ("model_response", "model_status")]
    schema = T.StructType([*asked.schema.fields, *answers])

    def batches(frames: Iterator) -> Iterator:
        for frame in frames:
            responses, statuses = answer(frame["prompt"])
            yield frame.assign(model_response=responses, model_status=statuses)

    return asked.mapInPandas(batches, schema)
