import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from admere.llm import phrases
from admere.llm.ship import ship

SPEC = "doc_id long, text string, lang string, word string, n long, g string"
COLUMNS = [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(docs, support, part=100, top=2000):
    totals, counts = Counter(), defaultdict(Counter)
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 6):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, found in counts.items():
        n = totals[lang]
        rows = []
        many = {g: a for g, a in found.items() if a >= support and len(g) > 1}
        for g, a in many.items():
            around = [b for h, b in many.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if any(100 * b >= part * a for b in around):
                continue
            score, k = min((1000 * a * n // (found[g[:k]] * found[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), found[g[:k]], found[g[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def frame(spark, docs):
    return ship(spark).createDataFrame([(*d, "x", 1, "y") for d in docs], SPEC)


def found(spark, docs, **more):
    df = phrases.collocations(frame(spark, docs), **more)
    assert df.dtypes == COLUMNS
    return sorted(map(tuple, df.collect()))


def oracle(docs):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    for d in docs:
        duck.execute("INSERT INTO documents VALUES (?, ?, ?)", d)
    return sorted(duck.execute(phrases.ORACLE).fetchall())


def corpus(n=150, seed=5):
    rng = np.random.default_rng(seed)
    vocab = np.array([f"{'The' if i % 7 == 0 else 'wö'}{i}" for i in range(40)])
    out = []
    for i in range(n):
        w = rng.choice(vocab, 60, p=(1 / np.arange(1, 41)) / (1 / np.arange(1, 41)).sum()).tolist()
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(0, 60)] = "New york City of dreams"
        out.append((i, "".join(x + rng.choice([" ", "  ", "\t", ". ", ",", "\n"], p=[0.7, 0.1, 0.05, 0.05, 0.05, 0.05]) for x in w), ["en", "fr", None][i % 3]))
    return out


ODD = [
    (1, None, "en"), (2, "", None), (3, "a b a b a b a b", "xx"), (4, "A\tB  a;b", "xx"), (None, "a b", "xx"), (4, "A\tB  a;b", "xx"), (5, "x x x x x x x x", ""), (6, ". , ;", "en"),
    (7, "é" * 60_000 + " " + "to be " * 30_000, "long"), (8, "\x00 \x00 \x00 \x00 \x00", "nul"),
]


@pytest.mark.parametrize(("rate", "part"), [(2, 60), (1000, 100)])
def test_equals_brute_force(spark, rate, part):
    docs = corpus()
    assert found(spark, docs, support=8, part=part, rate=rate) == brute(docs, 8, part)


def test_sql_and_odd_rows(spark):
    docs = corpus(300)
    assert found(spark, docs) == brute(docs, 100) == oracle(docs)
    assert found(spark, ODD, support=4, rate=2) == brute(ODD, 4)
    short = [d for d in ODD if d[2] != "long"]  # the SQL copies a text's words once a place
    assert brute(short, 2) and brute(short, 100) == oracle(short) == []
    assert found(spark, []) == []
    with pytest.raises(ValueError):
        phrases.collocations(frame(spark, ODD), longest=6)


def test_border_failures_are_opened(spark):
    docs = corpus()
    texts = frame(spark, docs).selectExpr("coalesce(lang, 'und') AS lang", "text")
    nothing, everything = texts.limit(0), texts
    rows, failures = phrases.frequent(texts, nothing, 8)
    same, few = phrases.frequent(texts, everything, 8, rate=1)
    key = ["lang", "w1", "w2", "w3", "w4", "w5", "n"]
    assert sorted(map(tuple, rows.select(key).fillna(0).collect())) == sorted(map(tuple, same.select(key).fillna(0).collect()))
    assert failures > 50 and few <= sum(r["w5"] is not None for r in same.collect())  # runs of five words are never proposed


def test_the_sample_draws_whole_pieces_independently(spark):
    docs = [(i, "".join(f"w{k} x{k}{'.;\n'[k % 3]}" for k in range(400)), "en") for i in range(20)] + [(99, None, "fr"), (98, "", "fr"), (97, "é", "fr")]
    from pyspark.sql import functions as F

    df = frame(spark, docs).select("lang", "text", F.xxhash64("doc_id").alias("seed"))
    rows = [r["text"] for r in phrases.draw(df, F.col("seed"), 4).collect()]
    got = [[p for p in re.split(r"[.;\n]", t) if p] for t in rows]
    assert len(rows) == len(docs) and all(re.fullmatch(r"w(\d+) x\1|é", p) for t in got for p in t)
    sizes = [len(t) for t in got[:20]]
    assert len(set(map(tuple, got[:20]))) == 20 and 1700 < sum(sizes) < 2300
    long = spark.createDataFrame([("en", "to be " * 2000, 1)], "lang string, text string, seed long")
    parts = phrases.draw(long, F.col("seed"), 4).first()["text"].split("\n")
    assert max(map(len, parts)) <= 2 * phrases.SEGMENT and 10 < len(parts) < 32


def test_another_salt_gives_other_hashes(monkeypatch):
    real = phrases.hashes

    def clash(data, start, end):
        out = real(data, start, end)
        return np.where(out % np.uint64(5) == 0, np.uint64(7), out)

    texts = pa.array(["a b c d e f g h i j", "b c"])
    with monkeypatch.context() as patch:
        patch.setattr(phrases, "hashes", clash)
        assert len(set(phrases.words(texts)[3].tolist())) < 10
    plain, other = phrases.words(texts)[3], phrases.words(texts, 1)[3]
    assert len(set(plain.tolist())) == len(set(other.tolist())) == 10 and not (plain == other).any()


def test_bitmap_holds_all_and_little_else():
    rng = np.random.default_rng(1)
    keys, size = rng.integers(0, 2**63, 60_000, dtype=np.uint64), phrases.bitmap_size(60_000)
    bits = np.zeros(size // 8, np.uint8)
    for spot in phrases.Phrases.spots(keys, size):
        np.bitwise_or.at(bits, spot >> 3, (1 << (spot & 7)).astype(np.uint8))
    held = phrases.Phrases(bits)
    assert held.holds(keys).all() and held.holds(rng.integers(0, 2**63, 60_000, dtype=np.uint64)).mean() < 0.05
    assert phrases.bitmap_size(0) == phrases.LEAST_BITS and phrases.bitmap_size(10**12) == phrases.MOST_BITS


def test_score_passes_64_bits(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(10**13, 10**15, 10**13 + 7, 10**13 + 9)], "a long, n long, l long, r long")
    got = row.select(phrases.score(*map(F.col, ("a", "n", "l", "r"))).alias("s")).first()["s"]
    assert got == 1000 * 10**13 * 10**15 // ((10**13 + 7) * (10**13 + 9))


def test_the_second_pass_gives_back_each_frequent_word_once(spark):
    """However many tasks read a frequent phrase, it is spelt out from its key, and one task tells a word."""
    texts = spark.createDataFrame([("en", "to be or not to be"), ("fr", "Be to")] * 80, "lang string, text string").repartition(8)
    assert texts.rdd.getNumPartitions() == 8
    texts = phrases.stable(texts)
    given, real = [], phrases.stable
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(phrases, "stable", lambda df: given.append(real(df)) or given[-1])
        rows, _ = phrases.frequent(texts, texts, 80, rate=1)
    told = [r for df in given if df.columns[:3] == ["key", "trace", "lang"] and "w5" in df.columns and "word" in df.columns for r in df.filter("n IS NOT NULL").collect()]
    assert Counter((r["lang"], r["word"]) for r in told if r["w1"] and not r["w2"]).most_common(1)[0][1] <= 2  # as told, and with its count
    assert not any(r["w2"] for r in told)
    got = {(r["lang"], r["word"], r["n"]) for r in rows.collect() if r["w2"] is None}
    assert got == {("en", "to", 160), ("en", "be", 160), ("en", "or", 80), ("en", "not", 80), ("fr", "be", 80), ("fr", "to", 80), ("en", None, 480), ("fr", None, 160)}


def test_words_are_found_when_rows_are_dealt_anew(spark):
    """The task said to hold a word may not hold it in the next pass."""
    texts = frame(spark, corpus()).selectExpr("coalesce(lang, 'und') AS lang", "text")
    many = phrases.stable(phrases.hash_counts(texts, range(1, 2), 8).withColumn("part", phrases.F.lit(10_000)))
    none = spark.sparkContext.broadcast(np.zeros(phrases.LEAST_BITS // 8, np.uint8))
    rows = [r for r in phrases.exact_counts(texts, 1, 8, none, none, many).collect() if r["word"]]
    assert len(rows) == many.count() > 50 and len({(r["lang"], r["word"]) for r in rows}) == len(rows)


def test_keys_lead_back_to_the_first_words():
    rng = np.random.default_rng(3)
    keys, word = (rng.integers(0, 2**64, 1000, dtype=np.uint64) for _ in range(2))
    assert (phrases._first_words(phrases._next_keys(keys, word), word) == keys).all()


def test_a_key_that_leads_to_two_phrases_is_counted_again(spark, monkeypatch):
    """A row of a key and trace that comes twice, the first time, makes all be counted again with other hashes."""
    docs = corpus()
    real, salts = phrases.spelt, []
    monkeypatch.setattr(phrases, "spelt", lambda many, single, longest: salts.append(1) or real(many.unionByName(many.filter("trace & 7 = 2").limit(int(len(salts) == 1))), single, longest))
    assert found(spark, docs, support=8, rate=2) == brute(docs, 8)
    assert len(salts) == 2


def test_a_word_named_like_another_language(spark):
    docs = [(1, "de la " * 9, "en"), (2, "en la " * 7, "de"), (3, "de en " * 5, "de")]
    assert found(spark, docs, support=3, rate=1) == brute(docs, 3)
    keys = phrases._first_keys(phrases._lang_hashes(["de", "en"]), phrases._lang_hashes(["en", "de"]))
    assert keys[0] != keys[1]
