"""Whole-group values and ordered fills that do not pull a group into one task.

A window over a key sorts all rows of that key in one task. Where the key may be
hot, these operators aggregate first (partial sums on the map side) and join the
small result back; adaptive execution splits the hot side of that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admere.session import stable


def with_group_values(df: DataFrame, keys: Sequence[str], values: dict[str, Column], source: DataFrame | None = None) -> DataFrame:
    """Add aggregates over each key group to every row; NULL keys are one group.

    ``source`` aggregates other rows than ``df``; a key it lacks gives NULL.
    """
    renamed = [f"__key_{i}" for i in range(len(keys))]
    totals = (df if source is None else source).groupBy(*[F.col(k).alias(r) for k, r in zip(keys, renamed)]).agg(
        *[c.alias(f"__{n}") for n, c in values.items()]
    )
    condition = F.lit(True)
    for k, r in zip(keys, renamed):
        condition = condition & df[k].eqNullSafe(totals[r])
    kept = [c for c in df.columns if c not in values]
    joined = df.join(totals, condition, "left")
    return joined.select(*[df[c] for c in kept], *[totals[f"__{n}"].alias(n) for n in values])


def share_of_group(df: DataFrame, keys: Sequence[str], measure: str, name: str) -> DataFrame:
    """``measure`` divided by its total over the key group."""
    with_total = with_group_values(df, keys, {"__group_total": F.sum(measure)})
    share = F.try_divide(F.col(measure).cast("double"), F.col("__group_total").cast("double"))
    return with_total.withColumn(name, share).drop("__group_total")


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Add the columns of a one-row relation to every row, as a scalar subquery."""
    row = scalars.select(F.struct(*scalars.columns).alias("row")).scalar()
    return df.select("*", row.alias("__scalars")).select("*", *[F.col("__scalars")[c].alias(c) for c in scalars.columns]).drop("__scalars")


def date_spine(bounds: DataFrame, first: str, last: str, name: str = "calendar_date") -> DataFrame:
    """One row per day between the bounds of a small bounds relation."""
    return bounds.filter(F.col(first).isNotNull() & F.col(last).isNotNull()).select(
        F.explode(F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))).alias(name),
        *[c for c in bounds.columns if c not in (first, last)],
    )


def forward_fill(
    df: DataFrame,
    order: str,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    chunk: Column | None = None,
) -> DataFrame:
    """Carry the last non-NULL value of each column forward along ``order``.

    Rows are filled inside time chunks (a month by default), then each chunk takes
    the value carried into it. The second step sees one row per series and chunk,
    so even one endless series runs on many tasks.
    """
    chunk = F.trunc(F.col(order), "MONTH") if chunk is None else chunk
    chunked = df.withColumn("__chunk", chunk)
    inside = Window.partitionBy(*keys, "__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_in_chunk = chunked.groupBy(*keys, "__chunk").agg(
        *[
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__end_{c}")
            for c in columns
        ]
    )
    series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = series.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last_in_chunk.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.col("__chunk").alias("__c"),
        *[F.last(f"__end_{c}", ignorenulls=True).over(before).alias(f"__in_{c}") for c in columns],
    )
    filled = chunked.select(
        *[c for c in chunked.columns if c not in columns],
        *[F.last(c, ignorenulls=True).over(inside).alias(c) for c in columns],
    )
    condition = F.col("__chunk") == F.col("__c")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    joined = filled.join(carried, condition, "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"__in_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Position of every row in one total order, without a one-partition sort.

    Rows are range-partitioned and sorted; ``monotonically_increasing_id`` then
    holds partition and position. That frame is written out, since a second
    sampling could cut the ranges elsewhere. Only one count per partition is
    summed up to get the offsets.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stable(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("__place", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per range: at most ``partitions`` rows reach this window.
    ahead = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__offset"))
    position = F.col("__place") - F.shiftleft(part, 33) + 1
    return (
        placed.join(F.broadcast(offsets), part == F.col("__p"))
        .withColumn(name, F.col("__offset") + position)
        .drop("__place", "__p", "__offset")
    )


def global_dense_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Dense rank by descending value over all rows, NULL last: the distinct values are numbered and joined back."""
    numbered = global_row_number(df.select(F.col(column).alias("__value")).distinct(), [F.col("__value").desc_nulls_last()], name)
    return df.join(numbered, F.col(column).eqNullSafe(F.col("__value"))).select(*df.columns, F.col(name).cast("int").alias(name))


def ntile(df: DataFrame, buckets: int, order: Sequence[Column], name: str = "tile") -> DataFrame:
    """``ntile`` over all rows: the first ``n mod k`` buckets get one row more."""
    numbered = global_row_number(df, order, "__row")
    total = numbered.agg(F.max("__row").alias("__total"))
    sized = with_scalars(numbered, total)
    row, n, k = F.col("__row"), F.col("__total"), F.lit(buckets)
    extra = n % k
    small = F.floor(n / k).cast("bigint")
    in_large = row <= extra * (small + 1)
    tile = F.when(in_large, F.ceil(row / (small + 1))).otherwise(
        extra + F.ceil(F.try_divide(row - extra * (small + 1), small))
    )
    return sized.withColumn(name, tile.cast("int")).drop("__row", "__total")


def add_partials(
    partials: Sequence[DataFrame], keys: Sequence[str], sums: dict[str, str], greatest: dict[str, str] | None = None
) -> DataFrame:
    """Combine partial aggregates on their keys in one shuffle.

    Each partial holds the keys and some of the measures (name -> type); absent
    ones become typed NULLs. ``sums`` are added up, of ``greatest`` the largest is
    kept. A sum over only NULLs stays NULL, so a caller can still tell "no such
    partial" from zero.
    """
    greatest = greatest or {}
    aligned: DataFrame | None = None
    for part in partials:
        shaped = part.select(
            *keys,
            *[(F.col(m) if m in part.columns else F.lit(None)).cast(t).alias(m) for m, t in {**sums, **greatest}.items()],
        )
        aligned = shaped if aligned is None else aligned.unionByName(shaped)
    return aligned.groupBy(*keys).agg(
        *[F.sum(m).cast(t).alias(m) for m, t in sums.items()], *[F.max(m).alias(m) for m in greatest]
    )


def one_bounds(dated: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """First and last date over several (table, column) pairs, one aggregate per table."""
    bounds: DataFrame | None = None
    for df, column in dated:
        part = df.agg(F.min(column).alias("first_day"), F.max(column).alias("last_day"))
        bounds = part if bounds is None else bounds.unionByName(part)
    return bounds.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
