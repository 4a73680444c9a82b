"""Columns and types of the numbered queries, and those with SQL against DuckDB."""

import pytest

from gridmart.llm.oracle import SQL
from gridmart.llm.queries import QUERIES
from gridmart.plans.verify import compare_one, duckdb_connection

COLUMNS = {
    "op1": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2": "doc_id bigint, fingerprint string, component_id bigint",
    "op3": "page_id bigint, url string, text string, n_chars bigint",
    "op4": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op5": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op6": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op7": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op9": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op10": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op11": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op12": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
    "op13": "item_id bigint, rank int, doc_id bigint, score bigint",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, sf001, name):
    got = dict(QUERIES[name](spark, sf001).dtypes)
    for column in COLUMNS[name.split("_")[0]].split(", "):
        key, kind = column.split()
        assert got.get(key) == kind


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_sql(spark, name, size):
    base = f"/root/testdata/{size}"
    result = compare_one(spark, base, name, QUERIES[name], SQL[name], duckdb_connection(base))
    assert result["match"], result
