"""The registered queries against their SQL and against what the contract says of their columns."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from textjury.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["page_id", "url", "text", "n_chars"],
    "op2": ["doc_id", "fingerprint", "component_id"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op6": ["doc_id", "size", "source_size", "target", "taken"],
    "op7": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op8": ["doc_id", "held_out", "lang_pred", "score"],
    "op9": ["query_id", "rank", "vec_id", "score"],
    "op11": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op13": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations", "labels"):
        path = f"{SF_DIR}/{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return connection


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    assert got.num_rows > 0
    assert got.column_names == COLUMNS.get(name.split("_")[0], got.column_names)
    if name in SQL:
        expected = sql.sql(SQL[name]).to_arrow_table().select(got.column_names)
        assert sorted(map(repr, got.to_pylist())) == sorted(map(repr, expected.to_pylist()))
