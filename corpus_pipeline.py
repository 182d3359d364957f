"""From raw documents to tokenized training data, in stages.

``STAGES`` lists (name, function) pairs; each function takes the session, the documents
its predecessor kept and the folder of the tables, and returns the documents it keeps.
Between stages the rows are written as Parquet below ``spark.checkpoint.dir`` and read
again, so that a lost executor costs a stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from admere.llm import bpe, langid, ngram_join, quality, source_mix
from admere.llm.ship import ship
from admere.session import prepare, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    ship(prepare(spark))
    return langid.keep_known(docs)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality."""
    labels = ship(prepare(spark)).read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.keep_good(docs, labels)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal ones."""
    ship(prepare(spark))
    return ngram_join.one_of_each(docs).select("doc_id", "text", "lang", "source", "n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    prepare(spark)
    return source_mix.draw(docs).select("doc_id", "text", "lang", "source", "n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    ship(prepare(spark))
    file = bpe.vocabulary_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.tokenize(docs, file)


STAGES = [
    ("language_id", language),
    ("quality_rules", good),
    ("ngram_jaccard", distinct),
    ("source_mix", mixed),
    ("byte_bpe", tokens),
]

#: Models are learnt on the way, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the table of documents."""
    docs = ship(prepare(spark)).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
