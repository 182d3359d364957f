import collections
import math
import re
import zlib

import numpy as np
import pytest

from admere.llm import lm, lm_model
from admere.llm.ship import ship


def tokens(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))


def corpus():
    rng = np.random.default_rng(9)
    names = "the of and to in that is was he for it with as his on be at by had".split()
    rows = [(i, " ".join(rng.choice(names, 30)) + f" Unique{i} ÉTÉ") for i in range(60)]
    return rows + [(100, None), (101, ""), (None, "the of nobody"), (102, "again " * 20_000), (103, "the rare pair"), (103, "the rare pair"), (104, "x\ty\nZ " * 3)]


@pytest.fixture(scope="module")
def scored(spark):
    return ship(spark).createDataFrame(corpus(), "doc_id long, text string")


def path(coding, byte):
    """Places in the code and bits taken there, on the way to a byte."""
    a = coding.start[byte]
    return [(int(coding.node[i]), int(coding.bit[i])) for i in range(a, a + coding.length[byte])]


def first_byte(model, after, every, byte):
    """Log10 of a first byte's probability, decision by decision, from what followed the word before."""
    total, start = 0.0, model.starts.mixer
    for node, bit in path(model.coding, byte):
        own, all_ = ([sum(n for b, n in c.items() if (node, x) in path(model.coding, b)) for x in (0, 1)] for c in (after, every))
        gate = int(np.searchsorted(lm_model._EDGES, sum(own), "right"))
        inputs = [math.log((c[1] + lm_model.PRIOR) / (c[0] + lm_model.PRIOR)) for c in (own, all_)]
        mixed = min(max(sum(w * x for w, x in zip(start.weights[gate], inputs, strict=True)), -lm_model.LIMIT), lm_model.LIMIT)
        spot = (mixed + lm_model.LIMIT) / (2 * lm_model.LIMIT) * (lm_model.STEPS - 1)
        low = min(int(spot), lm_model.STEPS - 2)
        ratio = start.hits[gate] / start.visits[gate]
        p = 0.5 * (1 / (1 + math.exp(-mixed)) + ratio[low] * (low + 1 - spot) + ratio[low + 1] * (spot - low))
        total += math.log10(p if bit else 1 - p)
    return total


def brute(rows, model):
    learnt = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    counts, after, every = collections.Counter(), collections.defaultdict(collections.Counter), collections.Counter()
    for yes, (_, text) in zip(learnt, rows, strict=True):
        if yes:
            found = [*tokens(text), "\n"]
            counts.update(found)
            every.update(w.encode()[0] for w in found)
            for u, w in zip(found, found[1:], strict=False):
                after[u][w.encode()[0]] += 1
    n, v = sum(counts.values()), len(counts)
    scorer = lm_model.Scorer(model.coding, model.table, model.mixer)
    words = sorted({w for _, t in rows for w in tokens(t)})
    rest = dict(zip(words, 10 ** scorer.words([w.encode() for w in words], rest=True), strict=True))
    known = {}
    out = []
    for i, text in rows:
        found, seen, alike, score = [*tokens(text), "\n"], collections.Counter(), collections.Counter(), 0.0
        for u, w in zip([None, *found], found, strict=False):
            b = w.encode()[0]
            if (u, b) not in known:
                known[u, b] = first_byte(model, after[u], every, b)
            score += known[u, b]
            if w != "\n":
                score += math.log10((1 - lm.CACHE) * rest[w] + lm.CACHE * seen[w] / alike[b] if alike[b] else rest[w])
            seen[w] += 1
            alike[b] += 1
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found)
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(found), sum(counts[w] > 0 for w in found), n, base, score))
    return sorted(out, key=str)


def test_scores_equal_brute_force(scored, monkeypatch):
    for common in (lm.COMMON, 40):
        monkeypatch.setattr(lm, "COMMON", common)
        found = lm.score_documents(scored)
        kept = {}
        monkeypatch.setattr(lm, "train", lambda vocab, ends, train=lm.train.__wrapped__ if hasattr(lm.train, "__wrapped__") else lm.train: kept.setdefault("model", train(vocab, ends)))
        got = sorted((tuple(r)[:7] for r in lm.score_documents(scored).collect()), key=str)
        monkeypatch.undo()
        want = brute(corpus(), kept["model"])
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
        assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=1e-5)
        assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]


def test_words_share_one_probability():
    rng = np.random.default_rng(10)
    coding = lm_model.code(rng.integers(0, 1000, 256))
    table = rng.integers(0, 50, lm_model.SLOTS * 2).astype(np.float32)
    scorer = lm_model.Scorer(coding, table, lm_model.Mixer.fresh())
    # all first bytes together, then all second bytes after one of them, add up to one
    first = lm_model.events([bytes([b]) for b in range(256) if b != 10], coding)
    total = 0.0
    for word in range(255):
        at = np.flatnonzero(first.word == word)
        own = [b for b in range(256) if b != 10][word]
        at = at[: coding.length[own]]
        gate = lm_model._gates(scorer.total[first.slots[4, at]], scorer.total[first.slots[3, at]])
        p = scorer.mixer.refine(scorer.mixer.mix(scorer.input[first.slots[:, at]], gate), gate)
        total += np.prod(np.where(first.bit[at] > 0, p, 1 - p))
    total += 10 ** scorer.words([b"\n"])[0]
    assert abs(total - 1) < 1e-4


def test_a_trained_model_prefers_what_it_has_read():
    known = [b"the", b"of", b"thing", b"offing", b"\n"]
    weight = np.array([500.0, 300, 40, 20, 100])
    coding = lm_model.code(np.bincount(np.frombuffer(b"".join(known), np.uint8), minlength=256))
    table = np.zeros(lm_model.SLOTS * 2, np.float32)
    mixer = lm_model.Mixer.fresh()
    for events, each in lm_model.parts(known, weight, coding):
        lm_model.count(events, each, table)
    for events, each in lm_model.parts(known, weight, coding):
        lm_model.learn(events, each, table, mixer)
    scores = lm_model.Scorer(coding, table, mixer).words([b"the", b"xqzw", b"thing"])
    assert scores[0] > scores[2] > scores[1]
    again = lm_model.Mixer.read(mixer.to_bytes())
    assert np.array_equal(again.weights, mixer.weights) and np.allclose(lm_model.Mixer.joined([mixer]).weights, mixer.weights)


def test_nothing_to_learn_from_and_empty_tables(spark):
    df = ship(spark).createDataFrame([(None, "a b a"), (None, None)], "doc_id long, text string")
    found = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in lm.score_documents(df).collect())
    assert found == [(1, 0, 0, 0.0), (4, 0, 0, 0.0)]
    assert lm.score_documents(df.limit(0)).collect() == []


def test_counts_past_float32_stay_whole():
    weight = [2**24, *[1] * 5, 2**40]
    batches = [lm.pa.RecordBatch.from_arrays([lm.pa.array(["a"]), lm.pa.array([w], lm.pa.int64())], names=["word", "own"]) for w in weight]
    coding = lm_model.code(np.ones(256, np.int64))
    sums = [b for _ in range(3) for b in lm._tables(iter(batches), coding)]
    table = np.zeros((lm_model.SLOTS // lm_model.BLOCK, lm_model.BLOCK * 2))
    for batch in lm._add_up(iter(sums)):
        table[batch.column(0)[0].as_py()] = lm._unpacked(batch.column(1)[0].as_py())
    found = lm_model.events([b"a"], coding)
    assert set(table.ravel()[found.slots[0] * 2 + found.bit.astype(np.int64)]) == {3.0 * (2**24 + 5 + 2**40)}


def test_text_ends_are_learnt_from_once(spark):
    """The map's decisions are those of all words and of every text end once, on any number of partitions."""
    rows = [(f"word{i}", i % 5 + 1, i % 5 + 1) for i in range(200)]
    vocab = ship(spark).createDataFrame(rows, "word string, own long, total long")
    start = lm_model.Mixer.fresh()
    for n in (1, 6):
        model = lm.train(vocab.repartition(n, "word"), 1000)
        words, weight = [*(r[0].encode() for r in rows), b"\n"], np.array([*(r[1] for r in rows), 1000.0])
        found = lm_model.events(words, model.coding)
        assert np.isclose((model.mixer.visits - start.visits).sum(), weight[found.word].sum())


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    rng = np.random.default_rng(4)
    names = [f"{a}{b}" for a in "abcdefgh" for b in range(40)]
    docs = ship(spark).createDataFrame([(i, " ".join(rng.choice(names, 60))) for i in range(120)], "doc_id long, text string")
    # several parts, and chunks that end inside them
    monkeypatch.setattr(lm, "PART", 50)
    monkeypatch.setattr(lm, "CHUNK", 20)
    kept, width = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 8, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            kept.append({r.doc_id: r.score for r in lm.score_documents(docs.repartition(n, "text")).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    for other in kept[1:]:
        assert all(np.isclose(other[i], s, rtol=1e-6) for i, s in kept[0].items())


def test_the_order_of_words_counts(spark):
    """Sentences of a fixed order, held out, score above the same words shuffled."""
    rng = np.random.default_rng(5)
    kinds = [[f"{c}{i}" for i in range(12)] for c in "dnvap"]
    rows = [(i, " ".join(" ".join(rng.choice(k) for k in kinds) for _ in range(12))) for i in range(300)]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 2]
    mixed = [(i, " ".join(rng.permutation(t.split()))) for i, (_, t) in zip(held_out_ids(1000, len(held)), held, strict=True)]
    found = {r.doc_id: r for r in lm.score_documents(ship(spark).createDataFrame(rows + mixed, "doc_id long, text string")).collect()}
    assert len(held) > 20
    assert all(found[a].held_out and found[b].held_out and found[a].score > found[b].score for (a, _), (b, _) in zip(held, mixed, strict=True))


def held_out_ids(first, n):
    out = [i for i in range(first, first + 20 * n) if zlib.crc32(str(i).encode()) % 7 == 2]
    return out[:n]


def test_first_bytes_after_a_word_share_one_probability():
    rng = np.random.default_rng(6)
    coding = lm_model.code(rng.integers(0, 1000, 256))
    starts = lm_model.Starts(coding, rng.integers(0, 500, 256), lm_model.Mixer.starts())
    before, byte, count = np.repeat([0, 1], [256, 256]), np.tile(np.arange(256), 2), rng.integers(0, 9, 512)
    starts.learn(before, byte, count)
    p = 10 ** starts.score(before, byte, count)
    assert np.allclose(np.bincount(before, weights=p), 1, atol=1e-4) and np.isclose((10 ** starts.first()).sum(), 1, atol=1e-4)


def test_a_common_words_rarer_followers_travel_with_it(spark, monkeypatch):
    """A first byte of a share below that of common words, after one of them, makes no rows for a join; scores stay."""
    docs = ship(spark).createDataFrame([(i, "the " * 40 + f"of {chr(97 + i % 10)}x") for i in range(200)], "doc_id long, text string")
    monkeypatch.setattr(lm, "COMMON", 100)
    shared, scores, real = [], [], spark.sparkContext.broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: shared.append(value) or real(value))
    for pairs in (1, lm.PAIRS):
        monkeypatch.setattr(lm, "PAIRS", pairs)
        scores.append({r.doc_id: r.score for r in lm.score_documents(docs).collect()})
    few, more = (len(v[3]) for v in shared if isinstance(v, tuple) and len(v) == 5)
    assert few < more  # "of" before each of 10 letters: 20 times in 8,400 words
    assert scores[0].keys() == scores[1].keys() and all(np.isclose(scores[1][k], v, rtol=1e-9) for k, v in scores[0].items())


def test_learning_from_narrow_counts_is_the_same():
    words, weight = [b"the", b"of", b"thing", b"once", b"offing"], np.array([500.0, 300, 40, 1, 20])
    coding = lm_model.code(np.bincount(np.frombuffer(b"".join(words), np.uint8), minlength=256))
    table = np.zeros(lm_model.SLOTS * 2)
    found = [(e, w) for e, w in lm_model.parts(words, weight, coding)]
    for events, each in found:
        lm_model.count(events, each, table)
    mixers = [lm_model.Mixer.fresh() for _ in range(2)]
    for mixer, counts in zip(mixers, (table, lm._narrow(table)), strict=True):
        for events, each in found:
            lm_model.learn(events, each, counts, mixer)
    assert mixers[0].to_bytes() == mixers[1].to_bytes()


def test_vocabulary_counts_what_follows_in_one_shuffle(spark, monkeypatch):
    """Pieces and batches of any size give each word once, with every first byte after it; one row a word and piece is shuffled."""
    docs = ship(spark).createDataFrame(corpus(), "doc_id long, text string").repartition(3)
    own, every = collections.Counter(), collections.Counter()
    for i, text in corpus():
        found = [w.encode() for w in tokens(text)]
        for word, after in zip(found, [w[0] for w in found[1:]] + [lm_model.END], strict=True) if found else ():
            every[word.decode(), after] += 1
            own[word.decode(), after] += i is not None and i > 50
    learnt = lm.F.coalesce(lm.F.col("doc_id") > 50, lm.F.lit(False))
    for piece in (64, lm.PIECE):
        monkeypatch.setattr(lm, "PIECE", piece)
        vocab = lm.vocabulary(docs, "text", learnt)
        found = vocab.toArrow().combine_chunks()
        words = found.column("word").to_pylist()
        size, (byte, mine, total) = lm._unpack(found.column("after"))
        keys = [(words[w], int(b)) for w, b in zip(np.repeat(np.arange(len(words)), size), byte, strict=True)]
        assert len(set(words)) == len(words) and len(set(keys)) == len(keys)
        assert dict(zip(keys, total.tolist(), strict=True)) == every and dict(zip(keys, mine.tolist(), strict=True)) == dict(own)
        assert found.column("total").to_pylist() == [sum(n for (v, _), n in every.items() if v == w) for w in words]
        # docs has one shuffle of its own
        plan = vocab._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    batch = next(lm._count(iter([lm.pa.record_batch([lm.pa.array(["a b a c a d"]), lm.pa.array([True])], names=["text", "learnt"])])))
    assert sorted(batch.column(0).to_pylist()) == ["a", "b", "c", "d"]


def test_words_of_one_hash_stay_apart():
    """Rows of two words under one hash, mixed and over several batches, add up by word."""
    words = ["x", "y", "x", "y", "y", "z"]
    after = lm._pack(np.arange(7), np.array([97, 97, 98, 97, 99, 97]), np.arange(6), np.full(6, 2**40))
    rows = lm.pa.record_batch([lm.pa.array(words), after, lm.pa.array([5, 5, 5, 5, 5, 9])], names=["word", "after", "name"])
    for step in (1, 2, 4, 6):
        found = lm.pa.Table.from_batches(list(lm._add_words(rows.slice(i, step) for i in range(0, 6, step))))
        size, (byte, own, total) = lm._unpack(found.column("after"))
        names = np.array(found.column("word").to_pylist())
        assert sorted(zip(names.tolist(), found.column("own").to_pylist(), found.column("total").to_pylist(), strict=True)) == [("x", 2, 2**41), ("y", 8, 3 * 2**40), ("z", 5, 2**40)]
        entries = sorted(zip(np.repeat(names, size).tolist(), byte.tolist(), own.tolist(), total.tolist(), strict=True))
        assert entries == [("x", 97, 0, 2**40), ("x", 98, 2, 2**40), ("y", 97, 4, 2**41), ("y", 99, 4, 2**40), ("z", 97, 5, 2**40)]


def test_equal_numbers_stand_together(monkeypatch):
    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 9, 500), rng.integers(0, 2**64, 40, dtype=np.uint64)[rng.integers(0, 40, 500)], np.array([2**63, 2**63 + 1] * 50, np.uint64), np.zeros(0, np.int64)):
        order = lm.together(values)
        assert sorted(order.tolist()) == list(range(len(values)))
        runs = np.flatnonzero(lm._fresh(values[order]))
        assert len(runs) == len(np.unique(values))
        assert all(np.all(np.diff(part) > 0) for part in np.split(order, runs[1:]) if len(part))


def test_small_batches_are_counted_together():
    """Batches below the limit give one row a word, not one a batch; the rest of a word is scored without its first byte."""
    batch = lm.pa.record_batch([lm.pa.array(["the same words", None]), lm.pa.array([True, False])], names=["text", "learnt"])
    rows = lm.pa.Table.from_batches(list(lm._count(iter([batch] * 5))))
    assert sorted(rows.column(0).to_pylist()) == ["same", "the", "words"] and lm._unpack(rows.column(1))[1][2].tolist() == [5, 5, 5]
    assert [t.num_rows for t in lm._gathered(iter([batch] * 5), 2 * batch.nbytes)] == [4, 4, 2]
    coding = lm_model.code(np.ones(256, np.int64))
    whole, rest = (lm_model.events([b"ab", b"c"], coding, rest) for rest in (False, True))
    assert len(rest.bit) == len(whole.bit) - int(coding.length[97] + coding.length[99]) and rest.word.tolist() == sorted(rest.word.tolist())
