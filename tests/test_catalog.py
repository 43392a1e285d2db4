"""Registered queries against their SQL on the smallest supplied tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

from bidscope import catalog  # noqa: E402
from tools.compare import TABLES, multiset  # noqa: E402

FOLDER = os.environ.get("BIDSCOPE_TEST_TABLES", "/root/testdata/sf0.001")
# The others are checked by tools/compare.py, which runs them all.
SAMPLE = [
    "coverage_30d_open",
    "top_public_buyer_open",
    "response_window_public_buyer",
    "short_response_windows_all_time",
    "list_after",
    "upsert_tenders",
    "rejected_updates",
    "text_dates_backfill",
    "export_json",
    "knn_batch",
    "knn_approximate",
    "chunk_blocks",
    "chunk_blocks_unplaced",
    "chunk_blocks_by_tokens",
    "hash_embed",
    "file_outcomes",
    "page_h1",
    "page_text",
    "stream_status_twice",
    "zip_expand_files",
]

needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no supplied tables")


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).columns == ["label", "tender_count", "share"]


@needs_tables
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = entry.queries()[name](spark, FOLDER)
    result = db.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert multiset(df.columns, [tuple(r) for r in df.collect()]) == multiset(names, result.fetchall())


@needs_tables
def test_no_query_pairs_all_rows(spark):
    for name in ("knn_batch", "chunk_blocks", "short_response_windows", "status_updates", "zip_expand"):
        text = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
