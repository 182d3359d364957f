import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from admere.llm import langid, ngram_join, quality, source_mix

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage keeps, the documents first."""
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_are_the_operators(spark, kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "ngram_jaccard", "source_mix", "byte_bpe"]
    assert all(df.columns == COLUMNS for df in kept[:-1])
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    labelled = langid.label_documents(kept[0])
    learnt = kept[0].filter(langid.fold("doc_id", 3) != 1)
    floors = langid.floors(learnt, langid.learn(learnt, "text", "lang"))
    size = {r.doc_id: len(r.text or "").bit_length() - 1 for r in kept[0].collect()}
    assert ids(kept[1]) == sorted(r.doc_id for r in labelled.collect() if r.lang_pred != "und" and r.score >= floors.get((r.lang_pred, size[r.doc_id]), langid.FLOOR))
    assert ids(kept[2]) == ids(quality.judge_documents(kept[1], labels).filter("kept"))
    assert ids(kept[3]) == ids(ngram_join.classes(kept[2]).filter("doc_id = class_id"))
    taken = source_mix.mix_documents(kept[3]).filter("taken > 0").select("doc_id", F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))))
    assert ids(kept[4]) == ids(taken)
    assert ids(kept[5]) == ids(kept[4]) and kept[5].filter("NOT exact").count() == 0


def test_each_stage_decides_something(kept):
    counts = [df.count() for df in kept]
    assert counts[1] > counts[2] > counts[3] > 0 and counts[4] == counts[5] > 0


def test_run_gives_the_last_stage(spark, kept):
    run = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.n_tokens) for r in run.collect()) == sorted((r.doc_id, r.n_tokens) for r in kept[-1].collect())


def test_odd_rows_go_through_every_stage(spark):
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "12 34", "en", None, 5), (3, "the word and " * 30_000, "en", "s", 9), (3, "the word and " * 30_000, "en", "s", 9), (4, "a b c", "en", "s", 5)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows.withColumn("extra", F.lit(1)), SMALL).collect() is not None


def test_the_entry_works_without_this_package(tmp_path):
    root = Path(corpus_pipeline.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "admere", tmp_path / "admere", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'campaign_value' in q and 'pipeline' not in q and not any(k.startswith('op') and k[2].isdigit() for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' in q and sum(k.startswith('op') and k[2].isdigit() for k in q) == 13; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_removal_is_by_document_not_by_id(spark):
    from admere.llm.ship import ship

    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"x{i}" for i in range(40))
    rows = [(1, a), (7, a + " more"), (7, b), (9, b), (9, b + " end"), (5, "alone"), (None, a), (3, a), (3, a + " less"), (7, b)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, ngram_join.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(1, a), (7, b), (5, "alone"), (None, a)], key=str)
    # near copies under the smallest id itself: one of them stays
    twice = ship(spark).createDataFrame([(1, a), (1, a + " more"), (1, b)], "doc_id long, text string")
    texts = [r["text"] for r in ngram_join.one_of_each(twice).collect()]
    assert len(texts) == 2 and b in texts


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью",
    "qxzvk wjjpq zzxkw vqpjx kkwzq xvjqp zqxwk jvpzx qkwxj vzpqk xwjzv kqpxz wvjkq pzxqw vjkzp qxwvj kzpxq",
]


def test_the_language_stage_refuses_languages_it_did_not_learn(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    foreign = spark.createDataFrame([(10_000_000 + i, t, None, "s", len(t)) for i, t in enumerate(FOREIGN)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language(spark, docs.select(COLUMNS).union(foreign), SMALL)
    left = {r.doc_id: r.text for r in kept.collect()}
    assert not any(i >= 10_000_000 for i in left)
    # running text of the learnt languages stays; one word over and over is no language
    running = {r.doc_id for r in docs.filter("size(array_distinct(split(text, ' '))) >= 10").collect()}
    assert running <= set(left) and len(running) > 0.9 * docs.count()
