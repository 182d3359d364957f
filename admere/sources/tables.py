"""Writers: full refresh, append and keyed upsert on partitioned Parquet."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admere.operators.versions import latest_version
from admere.session import release, remove_folder, stable
from admere.sources.versioned import VersionedTable

#: Fixed value: the folder name of a partition without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


#: The mark of a table without rows.
START = datetime.date(1900, 1, 1)


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def existing(spark: SparkSession, path: str | VersionedTable) -> DataFrame | None:
    """The table at ``path``; None if nothing was written there, or only empty loads."""
    if isinstance(path, VersionedTable):
        return path.read()
    if not table_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def write_full(df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = ()) -> None:
    """Replace a table. ``cluster`` sorts rows inside files, so row groups can be skipped."""
    shaped = df.sortWithinPartitions(*cluster) if cluster else df
    # Hashed keys are hexadecimal text, which only an entropy coder makes shorter.
    writer = shaped.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def append_snapshot(df: DataFrame, path: str, partition: str = "run_date") -> None:
    df.write.mode("append").partitionBy(partition).parquet(path)


def upsert(
    batch: DataFrame,
    path: str | VersionedTable,
    keys: Sequence[str],
    partition: str,
    newest: Sequence[str] = (),
    cluster: Sequence[str] = (),
    rebuild: Callable[[DataFrame], DataFrame] | None = None,
    links: Sequence[tuple[Sequence[str], str | None]] | None = None,
) -> None:
    """Replace rows with the same key, insert the rest.

    Whole partitions are rebuilt from target and batch: those the batch falls in
    and those that hold a row with a key of the batch, since a new version may sit
    in another partition than the old one. If the partition is part of the key, the
    batch's own partitions are all of them and the target is not searched; else
    only its key columns are read. Rows whose partition value is NULL make up a
    partition like any other. ``links`` lists further ways in which a
    target row depends on the batch: equal key columns, looked for among the target
    rows that meet a condition (so row groups can be skipped). ``rebuild`` turns the
    union into the final rows (default: latest version of ``keys`` by ``newest``).

    Spark stages the new files and swaps partition folders when the job commits; a
    job that fails before leaves the table as it was. Partitions that lost their
    last row are removed after the commit. A driver lost in between leaves moved
    rows in both places; running the same batch again finds both and repairs it.
    Running a finished batch again changes nothing.

    A :class:`VersionedTable` in place of the path has neither gap nor search: readers see whole
    versions, and its index finds the partitions.
    """
    if isinstance(path, VersionedTable):
        if path.partition != partition:
            raise ValueError(f"the table is partitioned by {path.partition}, not {partition}")
        path.upsert(batch, keys, newest, rebuild, links)
        return
    spark = batch.sparkSession
    links = [(keys, None)] if links is None else links
    rebuild = rebuild or (lambda rows: latest_version(rows, keys, newest))
    target = existing(spark, path)
    if target is None:
        fresh = rebuild(batch)
        write_full(fresh.hint("rebalance", partition), path, partition, cluster)
        return
    batch = stable(batch)
    # ``rebalance`` keeps one partition's rows together but splits a very large one.
    touched = batch.select(partition)
    for key, condition in links:
        if partition in key:
            continue
        among = target if condition is None else target.filter(condition)
        columns = [partition, *[k for k in key if k != partition]]
        hit = among.select(*columns).join(batch.select(*key).distinct(), list(key), "left_semi")
        touched = touched.union(hit.select(partition))
    # The driver holds one date per touched partition, so folders are pruned by value.
    days = {row[0] for row in touched.distinct().collect()}
    before = target.filter(_among(F.col(partition), days))
    after = stable(rebuild(before.select(*batch.columns).unionByName(batch)))
    shaped = after.hint("rebalance", partition)
    if cluster:
        shaped = shaped.sortWithinPartitions(partition, *cluster)
    shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    # Overwriting never removes a partition that lost its last row.
    left = {row[0] for row in after.select(partition).distinct().collect()}
    for day in days - left:
        remove_folder(spark, f"{path.rstrip('/')}/{partition}={_NO_VALUE if day is None else day}")
    release(after)
    release(batch)


def _among(column: Column, values: set) -> Column:
    """Whether a column holds one of the values; NULL is a value here."""
    known = [v for v in values if v is not None]
    found = column.isin(known) if known else F.lit(False)
    return found | column.isNull() if None in values else found


def high_water_mark(target: DataFrame | None, column: str = "dt"):
    """Greatest delivery day already loaded; 1900-01-01 for an empty or missing target."""
    if target is None:
        return START
    return target.agg(F.max(column)).first()[0] or START


def lookback(df: DataFrame, mark, days: int = 3, column: str = "dt") -> DataFrame:
    """Deliveries from ``days - 1`` days before the mark on; a literal, so folders are pruned."""
    return df.filter(F.col(column) >= F.lit(mark - datetime.timedelta(days=days - 1)))
