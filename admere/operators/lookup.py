"""Joins to dimensions.

No side is hinted for broadcast here: Spark copies a side to all tasks only where its
planned or measured size is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def left_lookup(df: DataFrame, dimension: DataFrame, on: dict[str, str] | Sequence[str]) -> DataFrame:
    """Left join that spreads rows with a NULL key over all tasks.

    NULL matches nothing, yet all NULL keys hash to one task. A second key column,
    0 for every row that can match, takes many values on the NULL rows.
    """
    pairs = on if isinstance(on, dict) else {k: k for k in on}
    # Maps and variants have no hash; the keys always do.
    hashed = [f.name for f in df.schema if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    missing = F.lit(False)
    for left_key in pairs:
        missing = missing | df[left_key].isNull()
    salted = df.withColumn("__salt", F.when(missing, F.pmod(F.xxhash64(*hashed), F.lit(1009))).otherwise(F.lit(0).cast("bigint")))
    # pmod(x, 1) is always 0, but not a literal the optimizer could fold away.
    keyed = dimension.select(
        "*", F.pmod(F.xxhash64(*pairs.values()), F.lit(1)).cast("bigint").alias("__dim_salt")
    )
    for i, right_key in enumerate(pairs.values()):
        keyed = keyed.withColumnRenamed(right_key, f"__dim_{i}")
    condition = salted["__salt"] == keyed["__dim_salt"]
    for i, left_key in enumerate(pairs):
        condition = condition & (salted[left_key] == keyed[f"__dim_{i}"])
    joined = salted.join(keyed, condition, "left")
    return joined.drop("__salt", "__dim_salt", *[f"__dim_{i}" for i in range(len(pairs))])
