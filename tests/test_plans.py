"""The plans Spark picks: what is pushed down, pruned, shuffled and broadcast."""

import pytest
from helpers import at, tender_rows
from pyspark.sql import functions as F

from bidscope.operators import insights, lookup
from bidscope.operators.filters import InsightsFilter
from bidscope.operators.search import nearest
from bidscope.operators.writes import dedupe_last
from bidscope.sources import tables

NOW = at(2041, 6, 15)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "tenders")
    days = [at(2041, 1 + n % 6, 1 + n % 28).date() for n in range(60)]
    rows = tender_rows(spark, [{"publication_date": d, "category": f"c{n % 5}", "status": "UPLOADED"} for n, d in enumerate([*days, None])])
    tables.write_tenders(rows, path)
    return tables.tenders(spark, path)


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_period_reaches_the_scan(stored):
    text = plan(insights.coverage(stored, NOW, InsightsFilter("30d", True)))
    assert "GreaterThan(publication_date,2041-05-16)" in text
    assert "LessThanOrEqual(publication_date,2041-06-15)" in text
    assert "ReadSchema: struct<publication_date:date,deadline:timestamp>" in text
    # One pass; the only shuffle carries one row of partial counts per task.
    assert text.count("FileScan") == 1 and "Exchange SinglePartition" in text


def test_month_folders_hold_every_row(stored):
    assert stored.count() == 61 and stored.filter("publication_date IS NULL").count() == 1


def test_top_prunes_and_takes_the_top(stored):
    text = plan(insights.top(stored, NOW, "category"))
    assert "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<category:string,publication_date:date>" in text
    assert text.count("Exchange hashpartitioning") == 2 and "partial_count" in text


def test_top_spelling_per_group_limits_before_the_shuffle(stored):
    assert "WindowGroupLimit [key" in plan(insights.top_spellings(stored, "category"))


def test_pages_are_top_k(stored):
    text = plan(lookup.list_tenders(stored, 10, 5))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    text = plan(lookup.list_tenders(stored, 10, closing_soon_at=NOW))
    assert "GreaterThan(deadline,2041-06-15" in text


def test_medians_share_their_counts(stored):
    text = plan(insights.response_window_groups(stored, NOW, "category"))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_repeats_collapse_before_the_shuffle(stored):
    text = plan(dedupe_last(stored.withColumn("seq", F.col("id"))))
    assert text.count("Exchange") == 1 and "partial_max_by" in text


def test_nearest_scans_once_and_keeps_a_few_rows_per_task(spark):
    chunks = spark.range(10).select(
        F.col("id").alias("dce_file_id"),
        F.lit(0).alias("chunk_index"),
        F.lit("t").alias("text"),
        F.array(F.lit(1)).alias("page_numbers"),
        F.array(F.lit("h")).alias("heading_path"),
        F.lit("m").alias("embedding_model"),
        F.array(F.rand(1), F.rand(2)).alias("embedding"),
    )
    text = plan(nearest(chunks, [1.0, 0.0], "m", 3))
    assert "TakeOrderedAndProject(limit=3" in text and "Exchange" not in text
    assert text.count("ArrowEvalPython") == 1
