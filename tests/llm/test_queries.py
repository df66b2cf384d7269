"""Queries with SQL against DuckDB, and the columns of all."""

import pytest

from millrace.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connection

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op2": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4": ["query_id", "rank", "vec_id", "score"],
    "op5": ["page_id", "url", "text", "n_chars"],
    "op6": ["page_id", "host", "path", "rule", "verdict"],
    "op7": ["doc_id", "size", "source_size", "target", "taken"],
    "op8": ["doc_id", "n_shingles", "component_id"],
    "op9": ["doc_id", "start", "length"],
    "op10": ["doc_id", "held_out", "lang_pred", "score"],
    "op11": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13": ["query_id", "rank", "vec_id", "score"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection(SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    wanted = COLUMNS[name.split("_")[0]]
    assert QUERIES[name](spark, SF_DIR).columns[: len(wanted)] == wanted
