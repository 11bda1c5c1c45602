"""Every registered text query: against its DuckDB oracle where there is one, by shape otherwise."""

import pytest

from ratingsmith.llm import queries
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op2_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op4_quality_fm": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op6_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                          "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op8_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                         "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op10_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op11_prefix_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
                         "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op12_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
                      "grown_shard": "int"},
    "op13_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                       "explained": "double", "identity_error": "double"},
}
#: Rows of a result, where they are not those of ``documents``.
ROWS = {"op3_url_filter": "SELECT count(*) FROM pages", "op13_whitening": "SELECT 4 * count(*) FROM embeddings"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_all_are_registered():
    assert set(COLUMNS) == set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, con, name):
    info = compare(spark, con, name, queries.QUERIES[name], queries.ORACLE.get(name), SF)
    assert info["ok"] in (True, None), info
    types = dict(queries.QUERIES[name](spark, SF).dtypes)
    assert {c: types[c] for c in COLUMNS[name]} == COLUMNS[name]
    if name == "op11_prefix_trie":           # nodes; compared with SQL
        return
    rows = con.execute(ROWS.get(name, "SELECT count(*) FROM documents")).fetchone()[0]
    assert (info["rows"][0] if isinstance(info["rows"], tuple) else info["rows"]) == rows
