"""Constraints, reconciliations, freshness and scans, each in as few passes as possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admere.operators.spread import with_scalars


class BrokenConstraint(Exception):
    """A blocking check found rows."""


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; rows with a NULL in the key count too."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def row_violations(df: DataFrame, not_null: Sequence[str] = (), conditions: dict[str, Column] | None = None) -> DataFrame:
    """Violations per constraint from one pass. A condition fails only where it is FALSE."""
    conditions = conditions or {}
    tallies = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    tallies |= {f"condition:{n}": F.count_if(~c) for n, c in conditions.items()}
    safe = {f"m{i}": n for i, n in enumerate(tallies)}
    row = df.agg(*[tallies[n].alias(m) for m, n in safe.items()])
    entries = [F.struct(F.lit(n).alias("constraint_name"), F.col(m).alias("violations")) for m, n in safe.items()]
    return row.select(F.inline(F.array(*entries)))


def constraint_report(
    df: DataFrame, unique: Sequence[str] = (), not_null: Sequence[str] = (), conditions: dict[str, Column] | None = None
) -> DataFrame:
    """One row per constraint with its violations: two passes, whatever their number."""
    report = None
    if not_null or conditions:
        report = row_violations(df, not_null, conditions)
    if unique:
        keys = unique_violations(df, unique).agg(
            F.lit(f"unique:{','.join(unique)}").alias("constraint_name"), F.count(F.lit(1)).alias("violations")
        )
        report = keys if report is None else report.unionByName(keys)
    return report


def assert_empty(violations: DataFrame, name: str, blocking: bool = True) -> bool:
    """True if there are no rows. A blocking check raises; one row is enough to know."""
    empty = not violations.limit(1).take(1)
    if not empty and blocking:
        raise BrokenConstraint(name)
    return empty


def checks(metrics: DataFrame, rules: dict[str, tuple[Column, str, Column]]) -> DataFrame:
    """Report rows ``check_name, observed, expected, status`` from a one-row metrics relation."""
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            observed.cast("string").alias("observed"),
            F.lit(expected).alias("expected"),
            F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        )
        for name, (observed, expected, passed) in rules.items()
    ]
    return metrics.select(F.inline(F.array(*entries)))


def one_row(*metrics: DataFrame) -> DataFrame:
    """Side-by-side join of one-row aggregates, one scan per table."""
    first, *rest = metrics
    for other in rest:
        first = with_scalars(first, other)
    return first


def ratio_outliers(df: DataFrame, reported: str, authoritative: str, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Rows whose reported value is out of proportion to the authoritative one."""
    quotient = F.try_divide(F.col(reported).cast("double"), F.col(authoritative).cast("double"))
    return df.filter(F.col(reported).isNotNull() & (F.col(authoritative) > 0) & ~quotient.between(low, high))


def delivery_freshness(sources: dict[str, tuple[DataFrame, str]], as_of: Column) -> DataFrame:
    """Latest delivery per source with FRESH, STALE or AVAILABLE.

    ``sources`` maps a name to (table with ``dt``, cadence); ``as_of`` is today in
    the reporting zone. An event-driven source only needs to exist.
    """
    report = None
    for name, (table, cadence) in sources.items():
        row = table.agg(
            F.max("dt").alias("latest_dt"), F.count_if(F.col("dt") == F.date_sub(as_of, 1)).alias("__due"), F.count(F.lit(1)).alias("__all")
        ).select(
            F.lit(name).alias("source_name"),
            F.lit(cadence).alias("cadence"),
            "latest_dt",
            (F.col("__all") if cadence == "EVENT_DRIVEN" else F.col("__due")).alias("qualifying_rows"),
        )
        report = row if report is None else report.unionByName(row)
    event_driven = F.col("cadence") == "EVENT_DRIVEN"
    expected = F.when(~event_driven, F.date_sub(as_of, 1))
    status = (
        F.when(event_driven & F.col("latest_dt").isNotNull(), "AVAILABLE")
        .when(F.col("latest_dt") >= F.date_sub(as_of, 1), "FRESH")
        .otherwise("STALE")
    )
    return report.select("source_name", "cadence", "latest_dt", expected.alias("expected_dt"), "qualifying_rows", status.alias("status"))


def delivery_reconciliation(expected: DataFrame, tables: dict[str, DataFrame], days: Column | None = None) -> DataFrame:
    """Rows and files per source and delivery day against an expected manifest.

    ``expected`` holds ``table_name, dt, expected_rows, expected_files``. A source
    or day with no rows shows as zero and fails.
    """
    actual = None
    for name, table in tables.items():
        part = table if days is None else table.filter(days)
        counted = (
            part.groupBy("dt", "source_file_name")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("dt")
            .agg(F.sum("n").alias("actual_rows"), F.count(F.lit(1)).alias("actual_files"))
            .withColumn("table_name", F.lit(name))
        )
        actual = counted if actual is None else actual.unionByName(counted)
    zero = F.lit(0).cast("bigint")
    passed = (F.col("expected_rows") == F.col("actual_rows")) & (F.col("expected_files") == F.col("actual_files"))
    return (
        expected.join(actual, ["table_name", "dt"], "left")
        .withColumn("actual_rows", F.coalesce("actual_rows", zero))
        .withColumn("actual_files", F.coalesce("actual_files", zero))
        .withColumn("status", F.when(passed, "PASS").otherwise("FAIL"))
        .select("table_name", "dt", "expected_rows", "actual_rows", "expected_files", "actual_files", "status")
    )


# Column names that must not leave the raw layer, and value patterns.
FORBIDDEN_COLUMNS = ("email", "phone", "first_name", "last_name", "normalized_email", "normalized_phone")
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"(^|[^0-9])\+[0-9]{7,15}($|[^0-9])"


def pii_scan(df: DataFrame, table: str) -> DataFrame:
    """Per column: is its name forbidden, and how many values hold an e-mail or phone number."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    row = df.agg(
        *[F.count_if(F.col(c).rlike(EMAIL_PATTERN)).alias(f"e{i}") for i, c in enumerate(texts)],
        *[F.count_if(F.col(c).rlike(PHONE_PATTERN)).alias(f"p{i}") for i, c in enumerate(texts)],
        F.count(F.lit(1)).alias("rows_seen"),
    )
    zero = F.lit(0).cast("bigint")
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(c.lower() in FORBIDDEN_COLUMNS).alias("name_forbidden"),
            (F.col(f"e{texts.index(c)}") if c in texts else zero).alias("email_values"),
            (F.col(f"p{texts.index(c)}") if c in texts else zero).alias("phone_values"),
        )
        for c in df.columns
    ]
    return row.select(F.inline(F.array(*entries)))


def snapshot(detected: DataFrame, history: DataFrame | None, run_at: Column, zone: str) -> DataFrame:
    """Detector rows with the rise since the latest earlier snapshot of each code."""
    stamped = detected.select(
        run_at.alias("run_id"), F.to_date(F.from_utc_timestamp(run_at, zone)).alias("run_date"), "*"
    ).withColumn("recorded_at", F.col("run_id"))
    if history is None:
        joined = stamped.withColumn("__before", F.lit(None).cast("bigint"))
    else:
        latest = history.groupBy("dq_code").agg(F.max_by("detected_count", F.struct("recorded_at", "detected_count")).alias("__before"))
        joined = stamped.join(latest, "dq_code", "left")
    before = F.coalesce("__before", F.lit(0).cast("bigint"))
    return joined.select(
        "run_id", "run_date", "dq_code", "source_name", "detection_unit", "detected_count",
        before.alias("previous_detected_count"),
        F.greatest(F.col("detected_count") - before, F.lit(0).cast("bigint")).alias("affected_rows_this_run"),
        "source_max_dt", "recorded_at",
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Planted issues per code from the truth manifest.

    Most codes count distinct record keys. DQ01 sums the row counts written in
    ``detail``, DQ08 those in ``record_key``, and DQ02 leaves out its daily
    summary lines.
    """
    code = F.col("issue_code")
    leading = lambda c: F.coalesce(F.regexp_extract(c, r"^(\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    summary = F.coalesce(F.col("record_key").startswith("event_date="), F.lit(False))
    keys = manifest.groupBy("issue_code", "record_key").agg(
        F.sum(F.when(code == "DQ01", leading("detail")).when(code == "DQ08", leading("record_key"))).alias("stated"),
        F.min("file_dt").alias("lo"),
        F.max("file_dt").alias("hi"),
    )
    counted = F.count_if(F.col("record_key").isNotNull() & ~((code == "DQ02") & summary))
    return keys.groupBy("issue_code").agg(
        F.coalesce(F.sum("stated"), counted).alias("planted_count"),
        F.min("lo").alias("first_planted_dt"),
        F.max("hi").alias("last_planted_dt"),
    ).withColumnRenamed("issue_code", "dq_code")


def scorecard(snapshots: DataFrame, manifest: DataFrame) -> DataFrame:
    """Latest detection of every planted code: MATCHED or MISMATCH."""
    fields = F.struct("source_name", "detection_unit", "detected_count", "source_max_dt", "recorded_at")
    latest = snapshots.groupBy("dq_code").agg(F.max_by(fields, F.struct("recorded_at", "detected_count")).alias("d"))
    detected = F.col("d.detected_count")
    return (
        manifest_totals(manifest)
        .join(latest, "dq_code", "left")
        .select(
            "dq_code", "d.source_name", "d.detection_unit", "d.detected_count", "planted_count",
            (detected - F.col("planted_count")).alias("difference"),
            F.when(detected == F.col("planted_count"), "MATCHED").otherwise("MISMATCH").alias("status"),
            "first_planted_dt", "last_planted_dt", "d.source_max_dt", "d.recorded_at",
        )
    )
