import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from admere.llm import divergence
from admere.llm.ship import ship

SPEC = "doc_id long, text string, lang string, source string, term string, n long, rank int"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]


def brute(docs, min_df=3, top=200):
    langs = defaultdict(lambda: (Counter(), defaultdict(Counter)))
    for _, text, lang, source in docs:
        df, groups = langs[lang or ""]
        found = words(text)
        df.update(set(found))
        groups[source or ""].update(found)
    out = []
    f = lambda p, q: (p - q) ** 2 // q
    for lang, (df, groups) in langs.items():
        kept = [t for t in df if df[t] >= min_df]

        def share(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: share(c) for s, c in groups.items()}
        q = share(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(-f(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", terms)):
                ranked = sorted(rows, key=lambda r: (r[0], r[1].encode()))
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def found(spark, docs, **more):
    df = divergence.audit(ship(spark).createDataFrame([(*d, "x", 1, 1) for d in docs], SPEC), **more)
    assert df.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(map(tuple, df.collect()))


def oracle(docs):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    for d in docs:
        duck.execute("INSERT INTO documents VALUES (?, ?, ?, ?)", d)
    return sorted(duck.execute(divergence.ORACLE).fetchall())


def corpus(n=200, sources=7, seed=3):
    rng = np.random.default_rng(seed)
    vocab = [f"w{chr(97 + i % 26)}{'äöß'[i % 3] * (i % 2)}{chr(65 + i // 26)}" for i in range(120)]
    return [
        (i, " ".join(rng.choice(vocab, rng.integers(0, 60), p=(w := (1 / np.arange(1, 121)) ** rng.uniform(0.3, 1.2)) / w.sum())) + ". 42-Ab_cD É", "en" if i % 3 else "fr", f"s{rng.integers(sources)}")
        for i in range(n)
    ]


ODD = [
    (1, None, None, None), (2, "", "", ""), (3, "A a\x00a", "xx", "one"), (4, "a b", "xx", "two"), (5, "a 1 2", "xx", None), (None, "b b b", "xx", "two"), (7, "b", "xx", "empty-handed"),
    (8, "only", "yy", "alone"), (8, "only", "yy", "alone"), (8, "only", "yy", "alone"), (9, "...", "xx", "none"), (10, "word " * 50_000 + "é" * 70_000, "xx", "one"), (11, "z", "zz", "p"), (12, "z", "zz", "q"),
]


def test_equals_brute_force_and_sql(spark, monkeypatch):
    docs = corpus()
    want = brute(docs)
    assert found(spark, docs) == want == oracle(docs)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "CHUNK_ROWS", 50)
    monkeypatch.setattr(divergence, "CHUNK_PAIRS", 20)
    monkeypatch.setattr(divergence, "BROADCAST_ROWS", 0)
    assert found(spark, docs) == want


def test_odd_rows(spark):
    assert found(spark, ODD) == brute(ODD) == oracle(ODD)
    assert found(spark, []) == []
    assert found(spark, corpus(60), min_df=1, top=2) == brute(corpus(60), 1, 2)


def test_large_counts_stay_exact(spark):
    counts = [(0, 2, 9), (10**14, 10**15, 2_000_000), (999_999_999, 10**10, 10**8)]
    df = spark.createDataFrame(counts, "a long, b long, c long").select(divergence.share(F.col("a"), F.col("b"), F.col("c")).alias("p"))
    assert [r["p"] for r in df.collect()] == [1 + 10**9 * (a + 1) // (b + c) for a, b, c in counts]


def test_vocabulary_and_vectors_equal_the_count_vectorizer(spark):
    docs = [d for d in corpus(80) if d[2] == "en"]
    df = ship(spark).createDataFrame([(*d, "x", 1, 1) for d in docs], SPEC)
    vocab = divergence.vocabulary(df)
    vectors = divergence.document_vectors(df, vocab)
    tokens = spark.createDataFrame([(d[0], words(d[1])) for d in docs], "doc_id long, w array<string>")
    model = CountVectorizer(inputCol="w", outputCol="v", minDF=3, vocabSize=2**31 - 1).fit(tokens)
    want = {(r["doc_id"], model.vocabulary[i], int(n)) for r in model.transform(tokens).collect() for i, n in zip(r["v"].indices, r["v"].values, strict=True)}
    assert {(r["id"], r["term"], r["n"]) for r in vectors.collect()} == want
    assert {r["term"] for r in vocab.collect()} == set(model.vocabulary)


@pytest.mark.parametrize("text", ["", "x", "É é_a\x7fb"])
def test_terms(text):
    import pyarrow as pa

    data, start, end, number, _ = divergence.terms(pa.array([None, text, text]))
    got = [bytes(data[a:b]).decode() for a, b in zip(start, end, strict=True)]
    assert got == words(text) * 2 and number.tolist() == [1] * len(words(text)) + [2] * len(words(text))
