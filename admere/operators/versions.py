"""Latest version per key, duplicates and ordered picks.

``row_number() = 1`` is written as a filter right on the rank: Spark then cuts
each map partition down to one row per key *before* the shuffle (WindowGroupLimit),
so a key that owns a third of all rows sends one row per map task, not all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admere.functions.clean import col


def top_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """First row of every key under ``order``; NULL keys form one group."""
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") == 1).drop("__rank")


def latest_version(df: DataFrame, keys: Sequence[Column | str], newest: Sequence[str]) -> DataFrame:
    """Newest row per key, compared by the columns of ``newest`` in turn; NULL is oldest."""
    return top_per_key(df, keys, [F.col(c).desc_nulls_last() for c in newest])


def drop_exact_copies(df: DataFrame, business: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per distinct set of business values, with the newest lineage."""
    return latest_version(df, business, newest)


def two_stage_dedupe(
    df: DataFrame,
    fingerprint: str,
    newest: Sequence[str],
    once: Column,
    once_key: str,
    earliest: Sequence[Column],
) -> DataFrame:
    """Drop re-sent copies, then repeats of a once-only kind of event.

    ``once`` must depend on the fingerprint alone (all copies of an event agree), so
    the rows are split before the first shuffle: the bulk takes one shuffle, and only
    the once-only events take a second. A once-only event without a key stays.
    """
    once = F.coalesce(once, F.lit(False))
    bulk = latest_version(df.filter(~once), [fingerprint], newest)
    single = latest_version(df.filter(once), [fingerprint], newest)
    key = F.coalesce(F.concat(F.lit("once|"), F.col(once_key)), F.concat(F.lit("event|"), F.col(fingerprint)))
    return bulk.unionByName(top_per_key(single, [key], list(earliest)))


def latest_by(value: Column | str, *order: Column | str, ignore_nulls: bool = False) -> Column:
    """Aggregate: ``value`` of the row with the greatest ``order``; NULL counts as smallest."""
    value = col(value)
    key = F.struct(*[col(o) for o in order])
    return F.max_by(value, F.when(value.isNotNull(), key) if ignore_nulls else key)


def earliest_by(value: Column | str, *order: Column | str, ignore_nulls: bool = False) -> Column:
    """Aggregate: ``value`` of the row with the least ``order``."""
    value = col(value)
    key = F.struct(*[col(o) for o in order])
    return F.min_by(value, F.when(value.isNotNull(), key) if ignore_nulls else key)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def duplicate_excess(df: DataFrame, per: Sequence[str], business: Sequence[str], name: str = "duplicate_rows") -> DataFrame:
    """Rows minus distinct rows, per file.

    Copies are counted first, so a file with a third of all rows is spread over
    the tasks by its content.
    """
    copies = df.groupBy(*per, *business).agg(F.count(F.lit(1)).alias("__n"))
    return copies.groupBy(*per).agg((F.sum("__n") - F.count(F.lit(1))).alias(name))


def distinct_history(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted array of the distinct non-NULL values of each key."""
    pairs = df.select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(name))
