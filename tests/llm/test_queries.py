"""The registered queries: result columns, and SQL where there is some."""

import pytest

import __spark_entry__ as entry
from ledgerlens.llm.queries import ORACLES, QUERIES
from oracle import compare, duck

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_ngram_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op2_deleted_interpolation": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op3_benchmark_containment": "doc_id bigint, item_id bigint",
    "op4_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op5_personal_data": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op6_line_spread": "doc_id bigint, n_lines bigint, n_removed bigint, kept boolean, text string",
    "op7_knn_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op9_sentencepiece": "doc_id bigint, token_ids array<int>, n_tokens bigint, round_trip boolean, parity boolean",
    "op12_merkle_manifest": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13_vector_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op11_near_vectors": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10_secret_links": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert [f"{c} {t}" for c, t in df.dtypes][: COLUMNS[name].count(",") + 1] == COLUMNS[name].split(", ")
    read = "embeddings" if name in ("op11_near_vectors", "op13_vector_codes") else "documents"
    assert df.count() == spark.read.parquet(f"{SMALL}/{read}.parquet").count() or name == "op3_benchmark_containment"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name])


def test_digests_are_of_the_base_spans(spark):
    import hashlib

    from ledgerlens.llm.pii_crf import personal_data
    from ledgerlens.llm.secret_links import secret_spans

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, df in (("op5_personal_data", personal_data(docs)), ("op10_secret_links", secret_spans(docs))):
        base = {r.doc_id: r.base_spans for r in df.collect()}
        for r in QUERIES[name](spark, SMALL).collect():
            assert r.base_sha256 == hashlib.sha256(base[r.doc_id].encode()).hexdigest()
