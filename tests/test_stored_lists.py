"""Pages and keyword searches of stored tenders, against the plain operators over all rows."""

import random
from datetime import date

import pytest
from helpers import at, tender_rows
from pyspark.sql import functions as F

from bidscope.operators.filters import SearchCriteria
from bidscope.plans.paging import list_page, page_days
from bidscope.schemas import TENDERS
from bidscope.sources import keywords
from bidscope.sources.keywords import KeywordIndex
from bidscope.sources.store import TenderStore

NOW = at(2033, 2, 1)


def found(spark, rows):
    batch = tender_rows(spark, rows)
    return batch.select(*[c for c in TENDERS.names if c not in ("id", "status", "last_status", "created_at", "updated_at")], F.col("id").alias("seq"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """40 tenders of five months, four a day, and eight without a date."""
    days = [date(2032, 1 + n % 5, 1 + n % 2) for n in range(40)] + [None] * 8
    store = TenderStore(spark, str(tmp_path_factory.mktemp("paging")))
    store.write(tender_rows(spark, [{"publication_date": d, "status": "UPLOADED"} for d in days]))
    return store


def check(store, limit, offsets):
    """Every page against a slice of the whole list, sorted here."""
    first = lambda row: (row.publication_date is None, -(row.publication_date or date.min).toordinal(), row.id)
    rows = [row.id for row in sorted(store.read().collect(), key=first)]
    for offset in offsets:
        assert [row.id for row in list_page(store, limit, offset).collect()] == rows[offset : offset + limit], offset
        assert page_days(store, limit, offset).has_next == (len(rows) > offset + limit)


def test_pages_at_any_offset(stored):
    check(stored, 7, (0, 36, 41, 48))


def test_a_deep_page_reads_its_month_and_sorts_its_days(stored):
    page = page_days(stored, 2, 21)
    assert len(page.days) == 1 and page.skipped == 1
    text = list_page(stored, 2, 21)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    month = str(page.days[0].replace(day=1))
    assert "month#" in text and f">= {month}" in text and f"<= {month}" in text
    assert f"GreaterThanOrEqual(publication_date,{page.days[0]})" in text


def test_pages_of_a_store_with_batches(spark, tmp_path):
    """New tenders, and old ones whose date moved to another month, to none, or from none."""
    store = TenderStore(spark, str(tmp_path / "s"))
    days = [date(2032, 1, 5), date(2032, 3, 5), date(2032, 5, 5), None, None]
    store.write(tender_rows(spark, [{"publication_date": d, "status": "UPLOADED"} for d in days]))
    moved = [date(2032, 5, 6), None, date(2032, 5, 5), date(2032, 2, 1), None, date(2032, 5, 5), None]
    store.upsert(found(spark, [{"publication_date": d} for d in moved]), NOW)
    assert store.days().agg(F.sum("n")).first()[0] == 7
    check(store, 3, (0, 2, 4))
    store.compact()
    check(store, 2, (3,))


def test_pages_of_an_empty_store(spark, tmp_path):
    store = TenderStore(spark, str(tmp_path / "s"))
    assert list_page(store).collect() == []
    store.write(tender_rows(spark, []))
    assert list_page(store, 5, 5).collect() == [] and not page_days(store).has_next


@pytest.fixture
def texts():
    random.seed(5)
    words = ["Réseau", "eau", "works", "\U0001f600\U0001f601x", "WORKS", "ab", "a", "", "road", "roads", "oads"]
    return [None if n % 17 == 0 else " ".join(random.choices(words, k=n % 6)) for n in range(120)]


def same(index, tenders, *criteria):
    holds = lambda text, part: not part or part.lower() in (text or "").lower()
    rows = tenders.collect()
    for wanted in criteria:
        expected = [r.id for r in rows if holds(r.tender_object, wanted.keyword) and holds(r.public_buyer, wanted.buyer)]
        assert sorted(row.id for row in index.search(tenders, wanted).collect()) == expected, wanted


def test_searches_by_postings(spark, tmp_path, texts, monkeypatch):
    monkeypatch.setattr(keywords, "BUCKET_POSTINGS", 600)
    tenders = tender_rows(spark, [{"tender_object": a, "public_buyer": b} for a, b in zip(texts, reversed(texts))])
    index = KeywordIndex(spark, str(tmp_path / "k"))
    same(index, tenders.limit(0), SearchCriteria("works"))  # before anything is indexed
    index.build(tenders)
    same(
        index,
        tenders,
        SearchCriteria("road works", "eau"),
        SearchCriteria(buyer="RÉSEAU"),
        SearchCriteria("\U0001f600\U0001f601x"),
        SearchCriteria("nowhere"),
        SearchCriteria("a"),
    )
    text = index.candidates("tender_object", "road works")._jdf.queryExecution().toString()
    partitions = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "bucket" in partitions and "In(gram" in text


def test_postings_follow_changed_and_new_texts(spark, tmp_path, texts):
    old = tender_rows(spark, [{"tender_object": a, "public_buyer": "b"} for a in texts[:20]])
    index = KeywordIndex(spark, str(tmp_path / "k"))
    index.add(old)
    now = tender_rows(spark, [{"tender_object": a, "public_buyer": "b"} for a in [*texts[20:40], "road of silk", "works"]])
    index.add(now)
    index.add(now)
    same(index, now, SearchCriteria("works"), SearchCriteria("road"))
    # A write without its commit does not count, and the next one replaces it.
    spark.createDataFrame([("tender_object", "zzz", 1)], "field string, gram string, id long").write.parquet(
        f"{index.root}/postings/version=4/bucket=0"
    )
    assert index.candidates("tender_object", "zzz").isEmpty()
    index.build(now)
    same(index, now, SearchCriteria("works"))


def test_equal_pieces_of_one_text_count_once(spark, tmp_path):
    tenders = tender_rows(spark, [{"tender_object": "aaaaaaa"}, {"tender_object": "aa"}, {"tender_object": ""}])
    index = KeywordIndex(spark, str(tmp_path / "k"))
    index.build(tenders)
    same(index, tenders, SearchCriteria("aaaa"))


def test_a_text_of_many_tenders_is_cut_once(spark, tmp_path):
    tenders = tender_rows(spark, [{"tender_object": ["Road works", "ROAD works"][n % 2], "public_buyer": f"b{n}"} for n in range(50)])
    index = KeywordIndex(spark, str(tmp_path / "k"))
    index.build(tenders)
    assert spark.read.parquet(f"{index.root}/postings").filter("field = 'tender_object'").count() == 8
    same(index, tenders, SearchCriteria("ad wor"), SearchCriteria("roads"))
