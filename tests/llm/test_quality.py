import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from admere.llm import quality
from admere.llm.ship import ship
from admere.llm.text import WORD_PATTERN, pieces


def brute(text):
    text = text or ""
    found = re.findall(WORD_PATTERN, text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(WORD_PATTERN, line):
            repeated += line in seen
            seen.add(line)
    triples = list(zip(found, found[1:], found[2:], strict=False))
    often = collections.Counter(triples)
    covered = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab# |\n\té", max_size=40)), max_size=5))
def test_counts_equal_brute_force(texts):
    got = []
    for _, _, data, bounds in pieces(pa.array(texts, pa.string()), 25):
        got.extend(zip(*[quality.counts(data, bounds)[m].tolist() for m in quality.MEASURES], strict=True))
    assert got == [brute(t) for t in texts]


def prose(seed, n=80):
    return " ".join(np.random.default_rng(seed).choice("the a of word line text more some other long quite".split(), n)) + f" {seed}"


@pytest.fixture
def table(spark):
    good = [(i, prose(i)) for i in range(80)]
    bad = [(i, " ".join(f"{w}###" for w in prose(i).split())) for i in range(80, 120)]
    docs = ship(spark).createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_verdicts_follow_the_labels(table):
    docs, labels = table
    found = quality.judge_documents(docs, labels).collect()
    failed = {r.doc_id for r in found if r.base_failed}
    assert {r.doc_id for r in found if r.kept} == set(range(80)) - failed
    assert len(found) == 120 and not failed & set(range(80, 120))


def test_odd_rows_and_columns(spark, table):
    docs, labels = table
    odd = spark.createDataFrame([(None, prose(5)), (500, None), (501, ""), (502, "x " * 40_000), (502, prose(7)), (502, prose(7))], "doc_id long, text string")
    labels = labels.union(spark.createDataFrame([(None, 1, 0), (2, None, 0), (4, 0, 0), (500, 1, 0)], labels.schema))
    wide = docs.union(odd).select("doc_id", F.lit("x").alias("kept"), F.lit(1).alias("c0"), "text", F.lit(None).cast("int").alias("m_kept"))
    found = quality.judge(wide, quality.train(wide, labels), prefix="q_").collect()
    assert len(found) == 126 and all(r.kept == "x" and r.c0 == 1 and r.m_kept is None for r in found)
    empty = [r for r in found if r.doc_id in (500, 501)]
    assert all(r.q_base_failed and not r.q_kept and r.q_n_words == 0 for r in empty)
    long = next(r for r in found if r.q_n_words == 40_000)
    assert long.q_n_repeat_words == 40_000 and long.q_base_failed


def test_without_labels_the_base_rule_decides(table):
    docs, labels = table
    assert quality.train(docs, labels.limit(0)) is None
    assert quality.train(docs, labels.filter("quality = 1")) is None
    found = quality.judge_documents(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in found)
    assert quality.judge_documents(docs.limit(0), labels).collect() == []


def test_calibration_gives_the_share_of_good_rows():
    rng = np.random.default_rng(3)
    margin = rng.normal(0, 3, 4000)
    label = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * margin + 1)))).astype(float)
    model = quality.calibrated(quality.Model(np.zeros(1), 0.0), margin, label)
    assert abs(model.slope - 0.5) < 0.1 and abs(model.shift - 1) < 0.15
