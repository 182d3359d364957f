"""Every query of the package on the smallest driver tables: its columns, and its SQL where there is one."""

import pathlib

import duckdb
import pytest

import check
from admere.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no driver tables here")

COLUMNS = {
    "op1_license_scan": "doc_id license_id n_shingles n_found containment",
    "op2_ngram_jaccard": "doc_id class_id n_links",
    "op3_html_extraction": "page_id url text n_chars",
    "op4_lm_scores": "doc_id held_out n_tokens n_known train_tokens base_score score bits_per_byte",
    "op5_topk_search": "query_id rank vec_id score",
    "op6_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed quality kept",
    "op7_language_id": "doc_id held_out lang_pred score",
    "op8_source_mix": "doc_id size source_size target taken",
    "op9_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op11_url_filters": "page_id host path rule verdict",
    "op12_phrase_mining": "lang rank phrase a l r n score",
    "op13_source_divergence": "lang source part item value rank",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    assert df.columns == COLUMNS[name].split() and (got or name == "op12_phrase_mining")
    if name in ORACLES:
        duck = duckdb.connect()
        for table in check.TABLES:
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        result = duck.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert check.rows(got, df.columns) == check.rows(result.fetchall(), columns)
    elif not name.startswith(("op3_", "op11_", "op12_", "op13_")):
        assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_all_operators_are_registered():
    assert set(QUERIES) == set(COLUMNS)
