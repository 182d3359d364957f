import numpy as np
import pytest
from pyspark.sql import functions as F

from admere.llm import ngram_join
from admere.llm.ship import ship


def brute(rows):
    sets = []
    for _, text in rows:
        w = (text or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    link = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(ids, default=None), len(link[i])))
    return sorted(out, key=str)


def near_copies():
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for size in (1, 1, 2, 3, 5, 12, 40):
        text = [f"w{x}" for x in rng.integers(0, 10_000, 60)]
        for _ in range(size):
            own = list(text)
            for k in rng.integers(0, len(own), rng.integers(0, 3)):
                own[k] = f"x{rng.integers(1e6)}"
            rows.append((n, " ".join(own)))
            n += 1
    passage = " ".join(f"p{i}" for i in range(20))
    rows += [(n + i, passage + " " + " ".join(f"q{x}" for x in rng.integers(0, 10_000, 15))) for i in range(20)]
    return rows


def test_bands_reach_the_recall():
    bands, rows = ngram_join.plan(0.8, 0.99999, 100)
    assert bands * rows <= 100 and 1 - (1 - 0.8**rows) ** bands >= 0.99999
    with pytest.raises(ValueError):
        ngram_join.plan(0.01, 0.999, 10)


def test_classes_and_links_equal_brute_force(spark, monkeypatch):
    rows = near_copies()
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, ngram_join.classes(docs).collect()), key=str) == brute(rows)
    # several blocks to a bucket
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    assert sorted(map(tuple, ngram_join.classes(docs).collect()), key=str) == brute(rows)


def test_copies_nulls_short_and_long_texts(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (2, text), (2, text), (3, text.replace(" ", " \n")), (None, text), (4, None), (5, ""), (6, " \t"), (7, "a b"), (8, "a b"), (9, "a b c"), (10, "long " * 50_000), (11, "long " * 60_000), (None, "alone here")]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("bands", F.lit(2))
    found = sorted(map(tuple, ngram_join.classes(docs).collect()), key=str)
    want = [(i, i if i in (4, 5, 6) else c, n) for i, c, n in brute(rows)]
    assert found == sorted(want, key=str)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, None, 4, 5, 6, 7, 9, 10, None], key=str)


def test_empty_tables(spark):
    docs = ship(spark).createDataFrame([], "doc_id long, text string")
    assert ngram_join.classes(docs).collect() == [] and ngram_join.one_of_each(docs).collect() == []


def test_a_tile_counts_a_pair_in_its_first_bucket_only():
    grams = np.arange(50, dtype=np.uint64).tobytes()
    rows = [(0, b"a", 2, [3, 9], grams), (0, b"b", 5, [3, 9], grams)]
    assert list(ngram_join._tile(9, True, rows, 0.8)) == []
    assert sorted(ngram_join._tile(3, True, rows, 0.8)) == [(b"a", 5, None), (b"b", 2, b"a")]
