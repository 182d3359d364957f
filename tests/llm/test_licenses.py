import re

import pytest
from pyspark.sql import functions as F

from admere.llm import licenses


def runs(text):
    w = [x.lower() for x in re.findall("[A-Za-z0-9]+", text or "")]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, templates):
    out = set()
    for i, text in rows:
        for name, notice in templates.items():
            want = runs(notice)
            if want and len(runs(text) & want) >= 0.8 * len(want):
                out.add((i, name, len(want), len(runs(text) & want)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


MIT = licenses.NOTICES["MIT grant"]
LONG = " ".join(f"clause{i} of the terms number {i * i}" for i in range(300))


@pytest.fixture
def rows():
    filler = "some words that stand before and behind it all " * 20
    changed = MIT.replace("copy", "KOPIE")
    return [(1, filler + MIT + filler), (2, MIT.upper()), (3, changed), (4, None), (5, ""), (6, "short"), (7, filler * 500 + licenses.NOTICES["MIT"] + "." + MIT), (7, "Licensed under CC BY-NC 4.0."), (None, MIT), (8, filler), (9, "x " + LONG + " y"), (10, LONG[: len(LONG) // 2]), (11, "\n".join(licenses.NOTICES.values()))]


def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(licenses.scan_documents(docs)) == brute(rows, licenses.NOTICES)
    own = {"long": LONG, "tiny": "too short", "five": "licensed under cc by nc", "none": None}
    assert found(licenses.scan(docs, licenses.notices(spark, own))) == brute(rows, own)


def test_repeated_rows_clashing_columns_and_empty_tables(spark, rows):
    docs = spark.createDataFrame([*rows, *rows], "doc_id long, text string").withColumn("license_id", F.lit("x")).withColumn("id", F.lit(0)).withColumn("shingle", F.lit(1))
    assert found(licenses.scan_documents(docs)) == brute(rows, licenses.NOTICES)
    assert found(licenses.scan_documents(docs.limit(0))) == []
    assert found(licenses.scan(docs, licenses.notices(spark, {}))) == []


def test_only_dataframe_functions(spark, rows):
    plan = licenses.scan_documents(spark.createDataFrame(rows, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Cartesian", "NestedLoop"))


def test_a_window_twice_as_long_is_found_almost_surely():
    assert 1 - (1 - licenses.LEAST) ** licenses.BANDS > 0.9999


def test_bodies_and_other_wordings(spark):
    apache = " ".join((licenses._TEXTS / "Apache-2.0.txt").read_text().split("END OF TERMS")[0].split()[12:])
    mit = (licenses._TEXTS / "MIT.txt").read_text().replace("persons", "people").replace("sublicense", "sub-license")
    rows = [(1, "This project is licensed under the MIT License."), (2, "before " + apache + " after"), (3, mit), (4, "Licensed under CC BY-NC 4.0"), (5, "We deal in software.")]
    got = {(i, name) for i, name, *_ in found(licenses.scan_documents(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert {(1, "MIT licensed"), (2, "Apache-2.0 terms"), (3, "MIT terms")} <= got
    assert {x for x in got if x[0] in (4, 5)} == {(4, "CC-BY-NC-4.0")}
