import json
from pathlib import Path

import pytest
from helpers import at, column, tender_rows
from pyspark.sql import functions as F

from bidscope.errors import NotFoundError
from bidscope.operators.embedding import HashEmbedder
from bidscope.operators.filters import resolve_all
from bidscope.schemas import TENDER_FIELDS
from bidscope.session import prepare, release, run_folder, shared_dir, spread, staged
from bidscope.sources import export, tables
from bidscope.sources.store import FileStore


def test_json_export(spark, tmp_path):
    day = at(2026, 1, 5).date()
    rows = tender_rows(spark, [{"publication_date": day, "deadline": at(2026, 10, 20, 10), "location": 'Fès "1"'}])
    export.write_json(rows, str(tmp_path / "out"))
    written = [json.loads(line) for f in (tmp_path / "out").glob("*.json") for line in f.read_text("utf-8").splitlines()]
    assert list(written[0]) == TENDER_FIELDS.fieldNames()
    assert (written[0]["publication_date"], written[0]["deadline"]) == ("2026-01-05", "2026-10-20T11:00:00+01:00")
    assert written[0]["location"] == 'Fès "1"' and written[0]["category"] is None
    shown = export.export_rows(rows)
    assert json.loads(shown.select(export.export_json(shown)).first()[0]) == written[0]


def test_pages_as_text_files(spark, tmp_path):
    (tmp_path / "1.html").write_text("<p>a\nb</p>")
    found = tables.result_page_files(spark, str(tmp_path)).first()
    assert found.html == "<p>a\nb</p>" and found.url.endswith("1.html")


def test_zoneless_timestamps_are_utc(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP_NTZ '2026-10-20 10:00:00' AS deadline").write.parquet(str(tmp_path / "t"))
    rows = tables.read_table(spark, str(tmp_path / "t"))
    assert dict(rows.dtypes)["deadline"] == "timestamp"
    assert rows.select(F.unix_timestamp("deadline")).first()[0] == at(2026, 10, 20, 10).timestamp()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    rows = staged(spark.range(5), "test")
    assert sorted(column(rows, "id")) == list(range(5))


def test_staged_tables_can_be_released(spark):
    staged(spark.range(5), "test")
    folder = Path(run_folder(spark).removeprefix("file:"))
    assert any(folder.iterdir()) and str(folder).startswith(shared_dir(spark).removeprefix("file:"))
    release(spark)
    assert not folder.exists()
    assert staged(spark.range(3), "test").count() == 3


def test_settings_on_a_foreign_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Africa/Casablanca")
    prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_spread_follows_the_session(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows in (spark.range(10, numPartitions=1), spark.range(1000, numPartitions=40)):
        assert spread(rows).rdd.getNumPartitions() == parts


def test_resolving_a_batch(spark):
    tenders = tender_rows(spark, [{}, {}])
    known = tenders.select("tender_id", "organization_acronym")
    assert sorted(column(resolve_all(tenders, known.union(known)), "tender_record_id")) == [1, 2]
    with pytest.raises(NotFoundError):
        resolve_all(tenders, known.withColumn("tender_id", F.lit("T9")))


def test_scope_reaches_the_scan_of_the_store(spark, tmp_path):
    store = FileStore(spark, str(tmp_path))
    kind = "array<struct<chunk_index:int,text:string,embedding_text:string,page_numbers:array<int>,heading_path:array<string>>>"
    files = spark.range(1, 40).select(
        F.col("id").alias("tender_record_id"),
        F.lit(0).alias("position"),
        F.lit("f").alias("path"),
        F.lit("txt").alias("file_type"),
        F.lit("chunked").alias("status"),
        F.lit(None).cast("string").alias("reason"),
        F.from_json(F.lit('[{"chunk_index":0,"text":"a","embedding_text":"a","page_numbers":[1],"heading_path":[]}]'), kind).alias("chunks"),
    )
    for _ in range(2):  # twice, so that there are stale rows to leave out
        store.replace(files.select("tender_record_id"), files, HashEmbedder(4))
    chunks = store.chunks()
    assert chunks.count() == 39 and chunks.select("id").distinct().count() == 39
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    text = chunks.filter("tender_record_id = 7")._jdf.queryExecution().toString()
    assert "EqualTo(tender_record_id,7)" in text and "PartitionFilters: [isnotnull(version" in text


def test_first_replacement_may_be_empty(spark, tmp_path):
    store = FileStore(spark, str(tmp_path))
    kind = "array<struct<chunk_index:int,text:string,embedding_text:string,page_numbers:array<int>,heading_path:array<string>>>"
    none = spark.createDataFrame(
        [], f"tender_record_id long, position int, path string, file_type string, status string, reason string, chunks {kind}"
    )
    outcome = store.replace(spark.range(1, 3).select(F.col("id").alias("tender_record_id")), none, HashEmbedder(4))
    assert outcome.count() == 2 and store.version() == 1
    assert store.files().isEmpty() and store.chunks().isEmpty()


def test_a_cluster_needs_a_shared_folder():
    from bidscope.session import _shared

    assert _shared("/w", "file", "local[8]") == "/w" and _shared("hdfs://w", "hdfs", "yarn") == "hdfs://w"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            _shared("/w", "file", master)


def test_schemes_of_storage():
    from bidscope.functions import paths

    assert paths.known_uri("s3a://bucket/a/b.zip") == "s3://bucket/a/b.zip"
    assert paths.known_uri("wasbs://c@h/a:/b") == "abfss://c@h/a:/b" and paths.known_uri("/a/b:/c") == "/a/b:/c"
    for local in ("/tmp/a.zip", "file:/tmp/a.zip", "file:///tmp/a.zip"):
        kind, path = paths.filesystem(local)
        assert kind.type_name == "local" and path == "/tmp/a.zip"
    with pytest.raises(ValueError, match="dbfs"):
        paths.filesystem("dbfs:/a.zip")
