import random
from datetime import date, timedelta

import pytest
from helpers import at, column, tender_rows, updates
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.errors import InvalidRowsError
from bidscope.operators import contract, insights, writes
from bidscope.operators.filters import InsightsFilter
from bidscope.operators.numbering import dense_ids, running_totals
from bidscope.schemas import CHUNKS, DCE_FILES, IDENTITY, STATUS_UPDATES, TENDER_FIELDS
from bidscope.sources.store import TenderStore
from bidscope.streaming.status import TRACKED_TENDERS

NOW = at(2026, 2, 1)
D1, D2 = at(2026, 3, 1), at(2026, 4, 1)


def batch(spark, *rows):
    names = [*TENDER_FIELDS.fieldNames(), "seq"]
    full = [tuple({"seq": n, **row}.get(name) for name in names) for n, row in enumerate(rows)]
    return spark.createDataFrame(full, T.StructType([*TENDER_FIELDS, T.StructField("seq", T.LongType())]))


@pytest.fixture(scope="module")
def old(spark):
    return tender_rows(
        spark,
        [
            {
                "id": 7,
                "tender_object": "a",
                "public_buyer": "b",
                "publication_date": date(2026, 1, 1),
                "deadline": D1,
                "category": "Travaux",
                "status": "UPLOADED",
                "updated_at": at(2026, 1, 1),
            }
        ],
    )


def known(**fields):
    return {"tender_id": "T1", "organization_acronym": "ORG", **fields}


def new_rows(spark):
    return batch(
        spark,
        known(tender_object="x"),
        {"tender_id": "T2", "organization_acronym": "ORG"},
        known(tender_object="y", publication_date=date(2026, 1, 2), deadline=D2, category="Services"),
        {"tender_id": "T0", "organization_acronym": "ORG"},
        {"tender_id": "T2", "organization_acronym": "ORG", "location": "last"},
    )


def test_upsert(spark, old):
    rows = {r.tender_id: r for r in writes.upsert(old, new_rows(spark), NOW).collect()}
    one = rows["T1"]
    assert (one.id, one.deadline, one.category, one.status) == (7, D1.replace(tzinfo=None), "Travaux", "UPLOADED")
    assert (one.tender_object, one.public_buyer, one.publication_date) == ("y", None, date(2026, 1, 2))
    assert one.updated_at == NOW.replace(tzinfo=None)
    # New tenders are numbered by first appearance and hold their last values.
    assert [(rows[t].id, rows[t].status, rows[t].location) for t in ("T2", "T0")] == [(8, "DISCOVERED", "last"), (9, "DISCOVERED", None)]


def test_upsert_twice_changes_nothing(spark, old):
    once = writes.upsert(old, new_rows(spark), NOW)
    twice = writes.upsert(once, new_rows(spark), NOW)
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()}


def test_upsert_into_nothing(spark):
    rows = writes.upsert(tender_rows(spark, []), new_rows(spark), NOW).orderBy("id")
    assert [(r.id, r.tender_id) for r in rows.collect()] == [(1, "T1"), (2, "T2"), (3, "T0")]


def test_one_row_without_identity_refuses_the_batch(spark, old, tmp_path):
    store = TenderStore(spark, str(tmp_path))
    store.write(old)
    bad = batch(spark, known(), {"tender_id": " ", "organization_acronym": ""})
    with pytest.raises(InvalidRowsError):
        store.write(writes.upsert(store.read(), bad, NOW))
    assert store.version() == 1 and store.read().collect() == old.collect()


def test_empty_batch(spark, old):
    assert writes.upsert(old, batch(spark), NOW).collect() == old.collect()


def test_dense_ids_in_any_order(spark):
    """However the values lie: close together, far apart, texts, equal or null."""
    rows = spark.range(1000).select((F.col("id") * 37 % 1009).alias("seq"), "id")
    for order in ("seq", "seq * 1000000000", "lpad(seq, 9, '0')", "seq - 2000"):
        numbered = dense_ids(rows.withColumn("o", F.expr(order)), ["o"], F.lit(5)).orderBy("seq")
        assert column(numbered, "id") == list(range(6, 1006))
    tied = rows.withColumn("o", F.when(F.col("id") >= 500, 7))
    numbered = dense_ids(tied, ["o", "seq"], F.lit(0), "n").orderBy("o", "seq")
    assert column(numbered, "n") == list(range(1, 1001))


def test_only_one_row_per_range_meets_in_one_task(spark):
    rows = spark.range(20_000).select((F.col("id") * 1_000_003).alias("seq"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = dense_ids(rows, ["seq"], F.lit(0))
        assert numbered.agg(F.max("id"), F.countDistinct("id")).first()[:] == (20_000, 20_000)
        text = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    # The window over everything stands above the counts per range.
    assert text.count("SinglePartition") == 1
    assert text.index("SinglePartition") < text.index("hashpartitioning(_range")


def test_null_order_values_lose_no_tender(spark):
    rows = batch(spark, known(tender_id="A"), known(tender_id="B")).withColumn(
        "seq", F.when(F.col("tender_id") == "A", 1)
    )
    saved = writes.upsert(tender_rows(spark, []), rows, NOW).orderBy("id").collect()
    assert [(r.id, r.tender_id) for r in saved] == [(1, "B"), (2, "A")]


def test_equal_order_values_are_decided_by_content(spark):
    def last(*objects):
        rows = batch(spark, *[known(tender_object=o) for o in objects]).withColumn("seq", F.lit(1))
        return writes.upsert(tender_rows(spark, []), rows.coalesce(1), NOW).first().tender_object

    assert last("a", "b") == last("b", "a") == "b"


def test_running_totals_of_a_hot_group(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id", (F.col("id") % 5).alias("v"))
    total = running_totals(rows, ["k"], F.floor(F.col("id") / 100), ["id"], before=F.col("v"))
    expected = 0
    for row in total.filter("k = 0").orderBy("id").collect():
        assert row.before == expected
        expected += row.v
    assert total.filter("k <> 0 AND before <> 0").isEmpty() and total.count() == 3000


def tracked(spark):
    return tender_rows(spark, [{"status": "UPLOADED"}, {"status": "FAILED", "last_status": "CHUNKED"}, {"status": "DISCOVERED"}])


def states(df):
    return [(r.status, r.last_status) for r in df.orderBy("id").collect()]


def test_status_updates(spark):
    changed = writes.apply_status_updates(
        tracked(spark),
        updates(
            spark,
            (3, "T1", "ORG", "FAILED", "DOWNLOADING"),
            (1, "T1", "ORG", "DOWNLOADING", None),
            (2, "T2", "ORG", "DOWNLOADING", None),
        ),
        NOW,
    )
    assert states(changed) == [("FAILED", "DOWNLOADING"), ("DOWNLOADING", None), ("DISCOVERED", None)]
    assert column(changed.filter("updated_at IS NOT NULL").orderBy("id"), "id") == [1, 2]


@pytest.mark.parametrize(
    ("tender", "status", "last"),
    [
        ("T1", "FAILED", None),
        ("T1", "FAILED", "FAILED"),
        ("T1", "UPLOADED", "DOWNLOADING"),
        ("T1", "SENT", None),
        ("T1", "FAILED", "SENT"),
        ("T9", "UPLOADED", None),
    ],
)
def test_rejected_updates(spark, tender, status, last):
    one = updates(spark, (1, tender, "ORG", status, last))
    with pytest.raises(InvalidRowsError):
        writes.apply_status_updates(tracked(spark), one, NOW)
    assert states(writes.apply_status_updates(tracked(spark), one, NOW, strict=False)) == states(tracked(spark))
    reason = column(writes.rejected_updates(tracked(spark), one), "reason")
    assert reason == ["unknown tender" if tender == "T9" else "status rule"]


def test_late_updates_change_nothing(spark):
    rows = tracked(spark).withColumn("status_seq", F.when(F.col("id") == 1, 10).cast("bigint"))
    late = updates(spark, (9, "T1", "ORG", "INDEXED", None), (9, "T3", "ORG", "INDEXED", None))
    changed = writes.apply_status_updates(rows, late, NOW).orderBy("id")
    assert column(changed, "status") == ["UPLOADED", "FAILED", "INDEXED"]
    assert column(changed, "status_seq") == [10, None, 9]


def test_status_remaps(spark):
    rows = tender_rows(
        spark,
        [
            {"status": "INDEXED"},
            {"status": "EMBEDDING"},
            {"status": "FAILED", "last_status": "CHUNKED"},
            {"status": "UPLOADING"},
            {"status": "FAILED", "last_status": "DOWNLOADED"},
        ],
    )
    assert states(writes.reopen_indexed(rows))[0] == ("UPLOADED", None)
    assert states(writes.close_indexed(rows))[:3] == [("INDEXED", None), ("INDEXED", None), ("FAILED", "UPLOADED")]
    assert states(writes.merge_download_statuses(rows))[3:] == [("DOWNLOADING", None), ("FAILED", "DOWNLOADING")]


def test_text_dates_round_trip(spark):
    texts = spark.createDataFrame(
        [(1, "15/01/2026", "20/10/2026 11:00"), (2, "31/02/2026", "à préciser"), (3, None, " ")],
        "id long, published string, closes string",
    )
    typed = writes.type_dates(texts, "published", "closes")
    back = writes.untype_dates(typed).orderBy("id")
    assert [tuple(r) for r in back.collect()] == [(1, "15/01/2026", "20/10/2026 11:00"), (2, None, None), (3, None, None)]
    assert tuple(writes.unreadable_dates(texts, "published", "closes").first()) == (3, 1, 1)
    rows = tender_rows(spark, [{}, {"publication_date": date(2020, 1, 1)}, {"publication_date": date(2020, 1, 1)}])
    changed = writes.set_dates(rows, typed.filter("id < 3")).orderBy("id")
    assert column(changed, "publication_date") == [date(2026, 1, 15), None, date(2020, 1, 1)]


def stored(spark):
    files = [(i, owner, f"f{i}", "txt", "chunked", None, None) for i, owner in ((1, 1), (2, 1), (3, 2), (4, 3))]
    chunks = [(i, f, n, "t", [1], [], "m", [1.0], None) for i, (f, n) in enumerate([(1, 0), (1, 1), (3, 0)])]
    return spark.createDataFrame(files, DCE_FILES), spark.createDataFrame(chunks, CHUNKS)


def test_deletes_cascade(spark):
    doomed = spark.createDataFrame([("T1", "ORG"), ("T9", "ORG")], "tender_id string, organization_acronym string")
    tenders, files, chunks = writes.cascade_delete(tracked(spark), *stored(spark), doomed)
    assert sorted(column(tenders, "id")) == [2, 3]
    assert sorted(column(files, "id")) == [3, 4]
    assert column(chunks, "dce_file_id") == [3]


def test_stored_rows_show_files_without_chunks(spark):
    rows = writes.stored_rows(tracked(spark), *stored(spark)).orderBy("path", "chunk_index")
    assert [(r.tender_id, r.path, r.chunk_index) for r in rows.collect()] == [
        ("T1", "f1", 0),
        ("T1", "f1", 1),
        ("T1", "f2", None),
        ("T2", "f3", 0),
        ("T3", "f4", None),
    ]


def test_contract(spark):
    good = tracked(spark)
    assert contract.verify(good)
    with pytest.raises(InvalidRowsError, match="deadline"):
        contract.verify(good.drop("deadline"))
    assert contract.verify(good.drop("last_status"))
    with pytest.raises(InvalidRowsError):
        contract.verify(good.union(good))
    broken = tender_rows(
        spark,
        [
            {"status": "UPLOADED"},
            {"status": "SENT", "tender_id": "T1"},
            {"status": "FAILED", "tender_id": ""},
            {"status": "INDEXED", "last_status": "CHUNKED"},
        ],
    )
    report = contract.contract_report(broken).first().asDict()
    assert report == {
        "row_count": 4,
        "repeated_identities": 1,
        "without_identity": 1,
        "unknown_status": 1,
        "last_status_rule": 2,
    }


def test_store_versions(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path / "tenders"))
    assert store.version() == 0 and store.read().isEmpty()
    store.write(tracked(spark), batch=5, stream="s")
    assert store.has_batch(5, "s") and not store.has_batch(6, "s") and not store.has_batch(5, "t")
    # A write that fails leaves what was there; its leftovers are replaced by the next one.
    with pytest.raises(Exception, match="boom"):
        store.write(store.read().withColumn("status", F.raise_error(F.lit("boom")).cast("string")))
    assert store.version() == 1 and store.read().count() == 3
    store.write(store.read().filter("id = 1"))
    assert store.version() == 2 and column(store.read(), "id") == [1]


def test_deadline_survives_the_store(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path / "tenders"))
    store.write(tender_rows(spark, [{"deadline": D1 + timedelta(minutes=1)}]))
    assert column(store.read(), "deadline") == [(D1 + timedelta(minutes=1)).replace(tzinfo=None)]


def test_changes_are_stored_alone_and_the_newest_counts(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path / "tenders"))
    rows = [{"publication_date": D1.date().replace(month=1 + n % 12), "status": "DISCOVERED"} for n in range(36)]
    store.write(tender_rows(spark, rows))
    for status in ("DOWNLOADING", "UPLOADED"):
        changed = store.read().filter("id IN (3, 5)").withColumn("status", F.lit(status))
        store.apply(changed)
    store.apply(store.read().filter("id = 5").withColumn("status", F.lit("CHUNKING")))
    added = tender_rows(spark, [{"status": "DISCOVERED"}]).withColumn("id", F.lit(99).cast("bigint"))
    store.apply(added)
    expected = {n: "DISCOVERED" for n in range(1, 37)} | {3: "UPLOADED", 5: "CHUNKING", 99: "DISCOVERED"}
    assert {r.id: r.status for r in store.read().collect()} == expected
    written = [spark.read.parquet(f"{tmp_path}/tenders/changes/version={v}").count() for v in (2, 3, 4, 5)]
    assert written == [2, 2, 1, 1]
    store.compact()
    assert {r.id: r.status for r in store.read().collect()} == expected and store.version() == 6


def test_a_period_reads_its_months_only(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path / "tenders"))
    rows = [{"publication_date": D1.date().replace(month=1 + n % 12, day=1 + n % 28)} for n in range(60)]
    store.write(tender_rows(spark, [*rows, {"publication_date": None}]))
    now = D1.replace(month=6, day=20)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    for name in ("7d", "30d", "90d", "all"):
        which = InsightsFilter(name)
        near, whole = store.read(which.days(now)), store.read()
        assert insights.coverage(near, now, which).collect() == insights.coverage(whole, now, which).collect()
        text = near._jdf.queryExecution().toString()
        assert ("PartitionFilters: [isnotnull(month" in text) == (name != "all")


def states(store):
    names = ["id", "tender_object", "publication_date", "status", "last_status"]
    return sorted(tuple(r) for r in store.read().select(*names).collect())


def test_batches_lie_over_the_whole_state(spark, old, tmp_path):
    store = TenderStore(spark, str(tmp_path))
    store.write(tender_rows(spark, [{"publication_date": date(2026, 1, 1), "tender_object": "a"} for _ in range(4)]))
    found = [{"tender_id": t, "organization_acronym": "ORG", "tender_object": "n", "publication_date": date(2026, 5, 2)} for t in ("T2", "N1", "N0")]
    store.upsert(batch(spark, *found), NOW)
    assert [r[:3] for r in states(store) if r[0] in (1, 2, 5, 6)] == [
        (1, "a", date(2026, 1, 1)), (2, "n", date(2026, 5, 2)), (5, "n", date(2026, 5, 2)), (6, "n", date(2026, 5, 2)),
    ]
    assert {r.id: r.tender_id for r in store.read().filter("id > 4").collect()} == {5: "N1", 6: "N0"}
    updates = [(1, "T2", "ORG", "UPLOADED", None), (2, "N1", "ORG", "FAILED", "CHUNKED"), (3, "N9", "ORG", "INDEXED", None)]
    updates = spark.createDataFrame(updates, STATUS_UPDATES)
    with pytest.raises(InvalidRowsError):
        store.update_status(updates, NOW)
    store.update_status(updates, NOW, strict=False)
    store.upsert(batch(spark, {**found[1], "tender_object": "again"}), NOW)
    assert [r for r in states(store) if r[0] in (2, 5)] == [
        (2, "n", date(2026, 5, 2), "UPLOADED", None), (5, "again", date(2026, 5, 2), "FAILED", "CHUNKED"),
    ]
    # A whole row that comes later counts alone; a compacted store holds the same.
    store.apply(store.read().filter("id = 5").withColumn("tender_object", F.lit("whole")))
    store.update_status(spark.createDataFrame([(1, "N1", "ORG", "INDEXED", None)], STATUS_UPDATES), NOW)
    before = states(store)
    assert before[4][1:] == ("whole", date(2026, 5, 2), "INDEXED", None)
    store.compact()
    assert states(store) == before
    store.upsert(batch(spark, {**found[0], "tender_id": "N2"}), NOW)
    assert column(store.read().filter("tender_id = 'N2'"), "id") == [7]


def test_a_tender_that_moved_into_a_period_is_read(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path))
    days = [date(2026, 1, 3), date(2026, 2, 3), None, date(2026, 6, 10)]
    store.write(tender_rows(spark, [{"publication_date": d} for d in days]))
    moved = [{"tender_id": f"T{n}", "organization_acronym": "ORG", "publication_date": date(2026, 6, 12)} for n in (1, 3)]
    store.upsert(batch(spark, *moved), NOW)
    near = store.read((date(2026, 6, 1), date(2026, 6, 30)))
    assert sorted(column(near.filter("publication_date >= '2026-06-01'"), "id")) == [1, 3, 4]
    assert sorted(column(near, "id")) == [1, 3, 4]  # February is not read


def test_a_batch_opens_its_buckets_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("bidscope.sources.store.BUCKET_ROWS", 10)
    store = TenderStore(spark, str(tmp_path))
    store.write(tender_rows(spark, [{} for _ in range(200)]))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    met = store._with_keys(spark.createDataFrame([("T7", "ORG"), ("X", "ORG")], IDENTITY), store._state())
    assert {r.tender_id: r.id for r in met.collect()} == {"T7": 7, "X": None}
    text = met._jdf.queryExecution().executedPlan().toString()
    assert "/full" not in text.split("keys")[0] and "bucket" in text and "IN (" in text
    assert len([p for p in (tmp_path / "keys" / "full=1" / "version=1").iterdir() if p.name.startswith("bucket=")]) == 20


def test_what_a_failed_batch_left_is_not_read(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path))
    store.write(tender_rows(spark, [{"tender_object": "a"}]))
    one = {"tender_id": "T1", "organization_acronym": "ORG", "tender_object": "lost"}
    store._write("refreshed", 2, store._with_keys(batch(spark, one), store._state()).selectExpr(
        "id", "tender_object", "public_buyer", "publication_date", "current_timestamp() AS updated_at", "month"))
    store.update_status(spark.createDataFrame([(1, "T1", "ORG", "INDEXED", None)], STATUS_UPDATES), NOW)
    store.upsert(batch(spark, {**one, "tender_id": "T2"}), NOW)
    assert sorted((r.tender_object, r.status) for r in store.read().collect()) == [("a", "INDEXED"), ("lost", "DISCOVERED")]


def test_status_batches_in_any_cut_and_order(spark, tmp_path):
    rng = random.Random(3)
    events = []
    for seq in range(60):
        status = rng.choice(["DOWNLOADING", "UPLOADED", "FAILED", "INDEXED"])
        last = rng.choice(["CHUNKED", "FAILED"]) if status == "FAILED" else None
        events.append((seq, f"T{rng.randint(1, 5)}", "ORG", status, last))
    ends = []
    for cuts in (1, 4):
        rng.shuffle(events)
        store = TenderStore(spark, str(tmp_path / str(cuts)), TRACKED_TENDERS)
        store.write(tender_rows(spark, [{} for _ in range(4)]).withColumn("status_seq", F.lit(None).cast("bigint")))
        for k in range(cuts):
            store.update_status(spark.createDataFrame(events[k::cuts], STATUS_UPDATES), NOW, strict=False)
            if k == 1:
                store.compact()
        ends.append(sorted((r.id, r.status, r.last_status, r.status_seq) for r in store.read().collect()))
    sound = [e for e in events if e[4] != "FAILED"]
    last = {t: max(e for e in sound if e[1] == t) for t in ("T1", "T2", "T3", "T4")}
    assert ends[0] == ends[1] == [(int(t[1:]), e[3], e[4], e[0]) for t, e in sorted(last.items())]
