import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from admere.llm import bpe, merges, token_count
from admere.llm.ship import ship
from admere.llm.text import pieces

LETTERS = [*"ab the's 'll 12 ..!! \n\t  \r\x0b\x1c\x1f\x85 　 éßñ日本語 العربية 😀²½ǅ'''rvdmeLσΣς", "<|endoftext|>", "<|startoftext|>", "İ", "́", "ﬁ", "'re", "'LL"]
FIXED = ["", "a" * 5000, "日本語" * 3000, " " * 3000 + "x", "the quick " * 2000, "abcdefgh" * 1000, "\n" * 500 + " a", None, "'", "'s", "x's", "x 's", " ", "'r", "'l", "x'v"]


def texts(n=8000):
    draw = random.Random(7)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 30))) for _ in range(n)] + FIXED


@pytest.fixture(scope="module")
def byte_bpe():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return bpe.vocabulary_file(path, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word_bpe():
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_count.tokenizer_file(path), Tokenizer.from_file(path)


def test_ids_equal_the_library_and_decode_to_the_text(byte_bpe):
    file, library = byte_bpe
    found = []
    for _, _, data, bounds in pieces(pa.array(texts(), pa.string()), 20_000):
        ids, edges = file.vocabulary().encode(data, bounds)
        found += [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)]
        back, ends = file.vocabulary().decode(ids, edges)
        assert back.tobytes() == data.tobytes() and (ends == bounds).all()
    assert found == [library.encode_ordinary(t or "") for t in texts()]


def test_any_pattern_goes_through_its_expression(byte_bpe):
    file, _ = byte_bpe
    own = bpe.Vocabulary(file.content, public_tokenizers.PATTERN + "|never")
    for _, _, data, bounds in pieces(pa.array(texts(500), pa.string())):
        assert np.array_equal(own.encode(data, bounds)[0], file.vocabulary().encode(data, bounds)[0])


def test_both_folds_agree(byte_bpe):
    table = byte_bpe[0].vocabulary()
    for text in (b"internationalisation", b"zzzzzzzzz", "日本".encode()):
        word = table.single[np.frombuffer(text, np.uint8)]
        rows, left = merges.fold(table.merges, word[None, :].astype(np.int32), np.array([len(word)]))
        assert rows[0, : left[0]].tolist() == merges.fold_long(table.merges, word.tolist())


def test_digests_of_documents(spark, byte_bpe):
    file, library = byte_bpe
    rows = [(1, "The end's near."), (2, None), (3, ""), (None, "x"), (4, "wörd " * 40_000), (4, "wörd " * 40_000)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").withColumn("added", F.lit(1)).withColumn("ids", F.lit(2))
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.digest_documents(docs, file).collect()), key=str) == sorted(want, key=str)
    coded = bpe.encode(docs, file, name="coded")
    assert coded.columns == [*docs.columns, "coded"]
    apart = bpe.decode(coded, file, "coded").select("coded", "decoded")
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, bpe.round_trip(docs.select("text"), file).select("ids", "decoded").collect()))
    assert bpe.digest_documents(docs.limit(0), file).collect() == []


def test_counts_equal_the_library(word_bpe):
    file, library = word_bpe
    found = []
    for _, _, data, bounds in pieces(pa.array(texts(), pa.string()), 20_000):
        found += file.tokenizer().count(data, bounds).tolist()
    assert found == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts()]


def test_counts_of_documents(spark, word_bpe):
    file, library = word_bpe
    rows = [(1, "The end's near."), (2, None), (3, ""), (None, "x"), (4, "wörd " * 40_000), (4, "wörd " * 40_000), (5, "a " * 2048), (6, "a " * 2049)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").withColumn("added", F.lit(1))
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in rows]
    assert sorted(map(tuple, token_count.count_documents(docs, file).collect()), key=str) == sorted(want, key=str)
    assert token_count.count_documents(docs.limit(0), file).collect() == []


def test_chunks_are_run_as_one_stream(monkeypatch):
    symbols = np.random.default_rng(8).integers(0, token_count._CLASSES, 5000)
    symbols[-1] = 0
    whole = token_count.run(symbols)
    for size in (1, 3, 64):
        monkeypatch.setattr(token_count, "CHUNK", size)
        assert np.array_equal(token_count.run(symbols), whole)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_count.tokenizer_file(public_tokenizers.path("byte_bpe_50k.json"))
