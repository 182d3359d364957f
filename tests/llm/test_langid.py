import numpy as np
import pytest
from pyspark.sql import functions as F

from admere.llm import langid
from admere.llm.ship import ship

WORDS = {"en": "the and of with that from this are was for you have not they his her", "de": "der die und das nicht mit sich auf für ist ein eine dem wurde auch über", "es": "que de la los las por con una para está como más pero sus este ñoño"}


def rows(n=90):
    rng = np.random.default_rng(1)
    out = []
    for i in range(n):
        lang = list(WORDS)[i % 3]
        out.append((i, " ".join(rng.choice(WORDS[lang].split(), 40)), lang, f"s{i % 4}", 1))
    return out


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    return ship(spark).createDataFrame(rows(), COLUMNS)


def brute_bundle(text):
    """The bundle letter by letter, as the definition has it."""
    folded = [langid._folding()[min(ord(c), langid._LETTERS)] for c in text]
    letters = [0]
    for c in folded:
        if c or letters[-1]:
            letters.append(int(c))
    if letters[-1]:
        letters.append(0)
    total = np.zeros(langid.PLACES)
    for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
        if b:
            total += np.roll(langid._letter(a), 2) * np.roll(langid._letter(b), 1) * langid._letter(c)
    return total


def test_bundles_equal_the_definition():
    texts = ["Der Hund, die KATZE!", "", "123 ... 45", "日本 語x", "a", "Ñandú  \n\n ñ"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    assert np.array_equal(langid.bundles(data, bounds), np.array([brute_bundle(t) for t in texts], np.float32))


def test_held_out_languages_are_found(docs):
    found = langid.label_documents(docs).collect()
    truth = {r[0]: r[2] for r in rows()}
    assert len(found) == 90 and all(r.lang_pred == truth[r.doc_id] and 0 < r.score <= 1 for r in found)
    assert 15 < sum(r.held_out for r in found) < 45


def test_odd_rows_have_defined_results(spark, docs):
    odd = spark.createDataFrame([(1000, None, "en", None, None), (1001, "", "de", "s", 0), (1002, "12 !?", None, "s", 5), (None, "the and of", "en", "s", 5), (1003, "der und das " * 30_000, "de", "s", 5), (1003, "der und das", "de", "s", 5)], COLUMNS)
    found = {(r.doc_id, r.lang_pred): r for r in langid.label_documents(docs.union(odd)).collect()}
    assert all(found[i, "und"].score == 0 for i in (1000, 1001, 1002))
    assert not found[None, "en"].held_out and (1003, "de") in found
    kept = langid.keep_known(docs.union(odd))
    assert kept.columns == docs.columns and kept.count() == 93


def test_nothing_learnt_and_empty_tables(docs):
    assert {r.lang_pred for r in langid.label_documents(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.label_documents(docs.limit(0)).collect() == []


def test_clashing_columns_come_through(docs):
    clash = docs.select("text", F.lit(1).alias("pred"), F.lit(2).alias("c0"), F.lit(3).alias("cosine"), "lang")
    found = langid.identify(clash, langid.learn(docs, "text", "lang"))
    assert found.columns == [*clash.columns, "lang_pred", "score"]
    assert all((r.pred, r.c0, r.cosine, r.lang_pred) == (1, 2, 3, r.lang) for r in found.collect())
