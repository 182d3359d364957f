"""Delivered files, read with fixed schemas and file lineage.

Files land in ``<root>/<source>/dt=YYYY-MM-DD/``; ``dt`` is the day of delivery.
A filter on ``dt`` prunes folders before any file is opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from admere.session import stable
from admere.sources import schemas


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the path of the file each row came from."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file_name"))


def _under(reader: DataFrameReader, root: str, pattern: str) -> DataFrameReader:
    return reader.option("basePath", root).option("pathGlobFilter", pattern)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", F.col("dt").cast("date"))


def read_delimited(spark: SparkSession, root: str, pattern: str, columns: Sequence[str]) -> DataFrame:
    """Comma-separated files with a header; every column stays text."""
    schema = ", ".join(f"`{c}` STRING" for c in columns) + ", dt DATE"
    reader = _under(spark.read.schema(schema), root, pattern).option("header", True).option("enforceSchema", True)
    return with_lineage(reader.csv(root))


def read_lines(spark: SparkSession, root: str, pattern: str, nested: bool = False) -> DataFrame:
    """One row per line, untouched, so no bad line can break the load.

    ``nested`` reads files in folders below the delivery day; ``dt`` then comes
    from the path.
    """
    if nested:
        lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root)
        found = with_lineage(lines.withColumnRenamed("value", "raw_line"))
        day = F.regexp_extract("source_file_name", r"/dt=(\d{4}-\d{2}-\d{2})/", 1)
        return found.select("raw_line", day.try_cast("date").alias("dt"), "source_file_name")
    lines = _under(spark.read, root, pattern).text(root)
    return _dated(with_lineage(lines.withColumnRenamed("value", "raw_line")))


def read_nested_json(spark: SparkSession, root: str, pattern: str, schema: str, partitions: int | None = None) -> DataFrame:
    """JSON lines with nested fields. A gzip file is one task; ``partitions`` spreads its rows after."""
    found = with_lineage(_under(spark.read.schema(schema + ", dt DATE"), root, pattern).json(root))
    return found.repartition(partitions) if partitions else found


def land(raw: DataFrame, day: str = "dt") -> DataFrame:
    """Parse once: the rows as Parquet in evenly filled files, for everything that reads them after.

    Compressed JSON can be neither split nor read by column, so each further reader
    would decompress and parse all of it.
    """
    return stable(raw.hint("rebalance", day))


def read_json_documents(spark: SparkSession, root: str, pattern: str, schema: str) -> DataFrame:
    """One JSON document per file, on one line or several."""
    reader = _under(spark.read.schema(schema + ", dt DATE"), root, pattern).option("multiLine", True)
    return with_lineage(reader.json(root))


def read_landing(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All ten delivered tables below a landing root."""
    tables: dict[str, DataFrame] = {}
    for name, (folder, pattern) in schemas.LOCATIONS.items():
        place = f"{root.rstrip('/')}/{folder}"
        if name in schemas.DELIVERED_TEXT:
            tables[name] = read_delimited(spark, place, pattern, schemas.DELIVERED_TEXT[name])
        elif name == "ga4_events":
            tables[name] = read_nested_json(spark, place, pattern, schemas.EVENT_SCHEMA)
        elif name == "weather_daily":
            tables[name] = read_json_documents(spark, place, pattern, schemas.WEATHER_SCHEMA)
        else:
            tables[name] = read_lines(spark, place, pattern, nested=name == "creative_copy_raw")
    return tables


def city_mapping(spark: SparkSession) -> DataFrame:
    rows = [(spelling, city) for city, spellings in schemas.CITY_SPELLINGS.items() for spelling in spellings]
    return spark.createDataFrame(rows, "city_raw_normalized string, city_standard string")


def internal_domains(spark: SparkSession, domains: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in domains], "email_domain string")
