"""Streams over delivered files.

State is bounded by the watermark: an event may be up to three days late, the
lookback of the batch run. Later ones are kept by :func:`late_sink`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from admere.sources.tables import existing, upsert
from admere.sources.versioned import VersionedTable

LATENESS = "3 days"


def file_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def dedupe_stream(events: DataFrame, at: str, keys: Sequence[str], lateness: str = LATENESS) -> DataFrame:
    """First arrival of every event key within the watermark."""
    return events.withWatermark(at, lateness).dropDuplicatesWithinWatermark(list(keys))


def session_stream(
    events: DataFrame, at: str, keys: Sequence[str], aggregates: dict[str, Column], lateness: str = LATENESS, span: str = "1 day"
) -> DataFrame:
    """Parts of sessions that carry an id: one row per session and time window.

    The window lets finished parts leave the state. A session that crosses a window
    has several parts; :func:`whole_sessions` adds them up.
    """
    parts = (
        events.withWatermark(at, lateness)
        .groupBy(F.window(at, span).alias("window"), *keys)
        .agg(*[c.alias(n) for n, c in aggregates.items()])
    )
    start = F.col("window.start")
    return parts.select(start.alias("window_start"), F.to_date(start).alias("window_day"), *keys, *aggregates)


def whole_sessions(parts: DataFrame, keys: Sequence[str], merges: dict[str, Column]) -> DataFrame:
    """Sessions from their parts; ``merges`` combines each aggregate (sum, min, max)."""
    return parts.groupBy(*keys).agg(*[c.alias(n) for n, c in merges.items()])


def gap_session_stream(events: DataFrame, at: str, keys: Sequence[str], gap: str, aggregates: dict[str, Column], lateness: str = LATENESS) -> DataFrame:
    """Roll-up of sessions cut by inactivity, for events that carry no session id."""
    return (
        events.withWatermark(at, lateness)
        .groupBy(F.session_window(at, gap), *keys)
        .agg(*[c.alias(n) for n, c in aggregates.items()])
    )


def late_sink(events: DataFrame, at: str, path: str, marks: str, checkpoint: str, lateness: str = LATENESS) -> StreamingQuery:
    """Keep the events that come after the watermark has passed them, which the other streams leave out.

    Run beside them on the same files. An event is late if it is not newer than the
    newest one of all earlier batches less ``lateness``. ``marks`` holds the newest
    instant of each batch; a replayed batch writes the same rows to the same folders.
    """

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = existing(spark, marks)
        newest = None if known is None else known.filter(F.col("batch") < number).agg(F.max("newest")).first()[0]
        if newest is not None:
            late = batch.filter(F.col(at) <= F.lit(newest) - F.expr(f"INTERVAL {lateness}"))
            late.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={number}")
        mark = batch.agg(F.max(at).alias("newest")).filter(F.col("newest").isNotNull())
        mark.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{marks}/batch={number}")

    return events.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_sink(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)


def upsert_sink(
    df: DataFrame,
    path: str | VersionedTable,
    checkpoint: str,
    keys: Sequence[str],
    partition: str,
    newest: Sequence[str],
    rebuild: Callable[[DataFrame], DataFrame] | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Keyed upsert per micro-batch. The upsert gives the same table when a batch is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, path, keys, partition, newest, rebuild=rebuild)

    writer = df.writeStream.foreachBatch(write).outputMode(output_mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
