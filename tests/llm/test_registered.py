"""The registered corpus queries: names, columns, whole results, and agreement with their SQL."""

import duckdb
import pytest

from quern.llm import queries

COLUMNS = {
    "op1_toxicity": "doc_id held_out score predicted",
    "op2_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op3_token_output": "sequence_id ids cu_seqlens positions doc_ids pieces",
    "op4_lm_scoring": "doc_id n_words log_score mean_log_score",
    "op5_html_extraction": "page_id url text n_chars",
    "op6_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op7_exact_topk": "query_id rank vec_id score",
    "op8_near_duplicates": "doc_id n_shingles component_id kept",
    "op9_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_conversation_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_embedding_whitening": "vec_id component n deviation whitened explained identity_error",
    "op13_url_filters": "page_id host path rule verdict",
    "quality_ablation": "rule bit n_failed n_failed_alone n_kept_without n_kept",
    "op10_quality_ledger": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    rows = got.collect()
    assert rows
    if name in queries.oracle_sql():
        con = duckdb.connect()
        for t in ("documents", "embeddings", "conversations"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        want = con.sql(queries.oracle_sql()[name])
        assert set(want.columns) == set(got.columns)
        assert sorted(tuple(str(r[c]) for c in want.columns) for r in rows) == sorted(tuple(map(str, r)) for r in want.fetchall())


def test_all_are_listed():
    assert set(queries.queries()) == {*COLUMNS, "pipeline"}
