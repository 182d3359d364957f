"""The queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admere.llm import bpe, divergence, html_text, langid, licenses, lm, ngram_join, phrases, quality, reputation, source_mix, token_count, topk
from admere.llm.ship import ship
from admere.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(prepare(spark)).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.label_documents(table(spark, sf_dir, "documents"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digest_documents(docs, bpe.vocabulary_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


ORACLES["op2_ngram_jaccard"] = r"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE c >= 0.8 * (a.n + b.n - c) - 1e-9),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(least(d.doc_id, r.low), d.doc_id) AS class_id, coalesce(k.n, 0) AS n_links
FROM documents d
LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY 1) r ON r.x = d.doc_id
LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY 1) k ON k.x = d.doc_id
"""


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_documents(table(spark, sf_dir, "documents"))


ORACLES["op8_source_mix"] = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
  FROM documents
),
grouped AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM grouped),
weighed AS (SELECT *, (place - 1) % 3 + 1 AS weight, sum(source_size) OVER () AS budget FROM placed),
levels AS (
  SELECT budget - coalesce(sum(3 * source_size) OVER before, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open
  FROM weighed
  WINDOW before AS (ORDER BY source_size * 3.0 / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
filled AS (
  SELECT w.*, least(CAST(3 * source_size AS DOUBLE), weight * (SELECT max(CAST(rest AS DOUBLE) / CAST(open AS DOUBLE)) FROM levels)) AS target FROM weighed w
),
queued AS (
  SELECT s.*, f.place, f.source_size, f.target, f.budget,
    sum(size) OVER (PARTITION BY f.place ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) AS queue
  FROM sizes s JOIN filled f ON s.source IS NOT DISTINCT FROM f.source
),
entries AS (
  SELECT doc_id, turn, place, size, budget, CAST(queue + source_size * t AS DOUBLE) / target AS finish, queue
  FROM queued, range(3) r(t) WHERE size > 0
),
cut AS (SELECT *, sum(size) OVER (ORDER BY finish, place ROWS UNBOUNDED PRECEDING) AS total FROM entries),
kept AS (SELECT place, queue, count(*) AS copies FROM cut WHERE total <= budget GROUP BY 1, 2)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, q.source_size, q.target, CAST(q.size * coalesce(k.copies, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN kept k ON k.place = q.place AND k.queue = q.queue AND q.size > 0
"""


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_documents(table(spark, sf_dir, "documents"), token_count.tokenizer_file(public_tokenizers.path("word_bpe_49k.json")))


@query
def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLES["op5_topk_search"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLES["op1_license_scan"] = f"""
WITH templates(license_id, text) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in licenses.NOTICES.items())}),
split AS (
  SELECT license_id, NULL AS doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM templates
  UNION ALL SELECT NULL, doc_id, list_transform(regexp_extract_all(text, '[A-Za-z0-9]+'), lambda x: lower(x)) FROM documents
),
runs AS (
  SELECT DISTINCT license_id, doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT license_id, doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)
),
sizes AS (SELECT license_id, count(*) AS n FROM runs WHERE license_id IS NOT NULL GROUP BY 1),
shared AS (
  SELECT d.doc_id, t.license_id, count(*) AS c FROM runs d JOIN runs t ON d.g = t.g
  WHERE d.license_id IS NULL AND t.license_id IS NOT NULL GROUP BY 1, 2
)
SELECT doc_id, license_id, n AS n_shingles, c AS n_found, c / n AS containment FROM shared JOIN sizes USING (license_id) WHERE c >= 0.8 * n
"""


@query
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


@query
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


ORACLES["op11_url_filters"] = reputation.ORACLE


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = divergence.ORACLE


@query
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_phrase_mining"] = phrases.ORACLE
