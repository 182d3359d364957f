"""Registry of proof queries and the one column spec both engines print by.

A spec is a list of ``name[:kind]``; the kind says how a value is written so that
both engines agree: ``i`` whole number, ``n<k>`` number rounded to k places, ``d``
date as text, ``t`` instant as epoch microseconds, ``b`` boolean as text, nothing
for text as it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admere.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


class Tables:
    """Driver tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name == "events":
            df = df.withColumn("ts", F.col("ts").cast("timestamp"))
        self.__dict__[name] = df
        return df


def _kinds(spec: str) -> list[tuple[str, str]]:
    return [tuple((item + ":").split(":")[:2]) for item in spec.split()]


def _spark_column(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "i":
        return c.cast("bigint").alias(name)
    if kind.startswith("n"):
        return F.round(c.cast("double"), int(kind[1:])).alias(name)
    if kind in ("d", "b"):
        return c.cast("string").alias(name)
    if kind == "t":
        return F.unix_micros(c.cast("timestamp")).alias(name)
    return c


def _sql_column(name: str, kind: str) -> str:
    if kind == "i":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind.startswith("n"):
        return f"round(CAST({name} AS DOUBLE), {kind[1:]}) AS {name}"
    if kind == "d":
        return f"CAST(CAST({name} AS DATE) AS VARCHAR) AS {name}"
    if kind == "b":
        return f"CAST({name} AS VARCHAR) AS {name}"
    if kind == "t":
        return f"epoch_us({name}) AS {name}"
    return name


def _needed(sql: str, found: dict[str, str]) -> None:
    for name in sorted(CTES):
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(CTES[name], found)
            found[name] = CTES[name]


def compose(body: str) -> str:
    """SQL with every shared relation it names, directly or through others, put before it."""
    found: dict[str, str] = {}
    _needed(body, found)
    if not found:
        return body
    shared = ",\n".join(f"{name} AS ({sql})" for name, sql in found.items())
    return f"WITH {shared}\n{body}"


def proof(spec: str, sql: str | None = None, name: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under its own name, with the SQL that must agree."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or fn.__name__
        kinds = _kinds(spec)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Tables(spark, sf_dir))
            return df.select(*[_spark_column(n, k) for n, k in kinds])

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = compose(f"SELECT {', '.join(_sql_column(n, k) for n, k in kinds)} FROM ({sql}) AS result")
        return fn

    return add
