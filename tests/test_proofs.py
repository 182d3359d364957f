"""Every registered query against its SQL on the smallest driver tables."""

import pathlib

import duckdb
import pytest

import check
from admere.proofs import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert operator not in plan
    assert got
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert check.rows(got, df.columns) == check.rows(result.fetchall(), columns)


def test_only_the_trained_model_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"train_predict", "ml_customer_pltv_evaluation"}
