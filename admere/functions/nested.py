"""Key/value arrays, JSON lines and parallel arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admere.functions.clean import col, safe_cast


def kv_lookup(array: Column | str, key: str, slot: str) -> Column:
    """``slot`` of the first element whose key is ``key``; NULL when absent.

    Position of the key, then the value there: both stay in generated code, which a
    lambda over the array would not.
    """
    array = col(array)
    return F.get(array["value"][slot], F.array_position(array["key"], key).cast("int") - 1)


def kv_number(array: Column | str, key: str, slots: tuple[str, ...] = ("double_value", "float_value", "int_value")) -> Column:
    """First typed slot that holds a number, as double."""
    return F.coalesce(*[kv_lookup(array, key, s).cast("double") for s in slots])


def valid_json(line: Column | str) -> Column:
    return F.try_parse_json(col(line)).isNotNull()


def json_text(payload: Column, path: str) -> Column:
    """Scalar at ``path`` of a parsed document as text; NULL if absent."""
    return F.try_variant_get(payload, path, "string")


def json_number(payload: Column, path: str, to: str) -> Column:
    return safe_cast(json_text(payload, path), to)


def action_value(payload: Column, field: str, action_type: str) -> Column:
    """Value of the first ``{action_type, value}`` entry of a kind, 0 when there is none."""
    entries = F.try_variant_get(payload, f"$.{field}", "array<struct<action_type:string,value:string>>")
    first = F.get(F.filter(entries, lambda e: e["action_type"] == action_type), F.lit(0))
    return F.coalesce(first["value"].try_cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))


def split_json(df: DataFrame, line: str = "raw_line") -> tuple[DataFrame, DataFrame]:
    """Rows whose line parses (with ``payload``), and rows whose line does not."""
    # As a generator the line is parsed once per row; a plain projection would be parsed again for the filter.
    parsed = df.select("*", F.inline(F.array(F.struct(F.try_parse_json(F.col(line)).alias("payload")))))
    good = parsed.filter(F.col("payload").isNotNull())
    bad = df.filter(~valid_json(line))
    return good, bad


def zip_arrays(df: DataFrame, arrays: dict[str, Column | str], keep: list[Column | str]) -> DataFrame:
    """One row per position of the first array; a shorter array gives NULL there."""
    names = list(arrays)
    exploded = df.select(
        *[col(k) for k in keep],
        *[col(arrays[n]).alias(f"__{n}") for n in names[1:]],
        F.posexplode(col(arrays[names[0]])).alias("position", names[0]),
    )
    kept = [c for c in exploded.columns if not c.startswith("__")]
    return exploded.select(*kept, *[F.get(F.col(f"__{n}"), F.col("position")).alias(n) for n in names[1:]])
