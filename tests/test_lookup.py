from datetime import date

import pytest
from helpers import column, tender_rows

from bidscope.errors import InvalidRowsError, NotFoundError
from bidscope.operators import filters, lookup


@pytest.fixture(scope="module")
def tenders(spark):
    days = [date(2026, 1, 2), None, date(2026, 1, 3), date(2026, 1, 2), None, date(2026, 1, 1)]
    return tender_rows(spark, [{"publication_date": d, "status": "DISCOVERED"} for d in days])


def test_newest_first_undated_last(tenders):
    assert column(lookup.list_tenders(tenders), "id") == [3, 1, 4, 6, 2, 5]
    assert column(lookup.list_tenders(tenders, 2, 1), "id") == [1, 4]


def test_paging_by_key_gives_the_same_pages(tenders):
    assert column(lookup.list_after(tenders, date(2026, 1, 2), 1, 2), "id") == [4, 6]
    assert column(lookup.list_after(tenders, date(2026, 1, 1), 6), "id") == [2, 5]
    assert column(lookup.list_after(tenders, None, 2), "id") == [5]


def test_more_pages(tenders):
    assert tuple(lookup.has_next_page(tenders, 3, 0).first()) == (3, True)
    assert tuple(lookup.has_next_page(tenders, 3, 3).first()) == (3, False)
    assert tuple(lookup.has_next_page(tenders, 4, 4).first()) == (2, False)


@pytest.mark.parametrize(("limit", "offset"), [(0, 0), (201, 0), (10, -1), ("5", 0), (True, 0)])
def test_page_arguments(tenders, limit, offset):
    with pytest.raises(ValueError):
        lookup.list_tenders(tenders, limit, offset)


def test_one_tender(tenders):
    assert lookup.get_tender(tenders, 3).first().tender_id == "T3"
    assert lookup.get_tender(tenders, 99).isEmpty()
    assert lookup.get_tender(tenders, 3).columns == lookup.DETAIL


STATUSES = [
    ("DISCOVERED", None, False, False),
    ("DOWNLOADING", None, False, False),
    ("FAILED", "DOWNLOADING", False, False),
    ("UPLOADED", None, True, True),
    ("INDEXED", None, True, False),
    ("CHUNKING", None, True, False),
    ("FAILED", "UPLOADED", True, True),
    ("FAILED", "EMBEDDING", True, True),
    ("FAILED", None, False, False),
]


def test_archive_flag_and_readiness(spark):
    rows = tender_rows(spark, [{"status": s, "last_status": p} for s, p, _, _ in STATUSES])
    flagged = rows.withColumn("flag", filters.has_archive()).orderBy("id")
    assert column(flagged, "flag") == [flag for _, _, flag, _ in STATUSES]
    ready = [i for i, (_, _, _, r) in enumerate(STATUSES, 1) if r]
    assert column(lookup.find_for_indexing(rows, 100), "id") == ready
    assert column(lookup.find_for_indexing(rows, 2), "id") == ready[:2]


def test_search_criteria(spark):
    rows = tender_rows(
        spark,
        [
            {"tender_object": "Travaux de VOIRIE", "public_buyer": "Commune", "publication_date": date(2026, 1, 1)},
            {"tender_object": "voirie", "public_buyer": "ONEE", "publication_date": date(2026, 1, 31)},
            {"tender_object": None, "public_buyer": "Commune", "publication_date": None},
        ],
    )

    def found(**criteria):
        return sorted(column(filters.search_tenders(rows, filters.SearchCriteria(**criteria)), "id"))

    assert found() == [1, 2, 3]
    assert found(keyword="Voirie") == [1, 2]
    assert found(buyer="commune") == [1, 3]
    assert found(organization="ORG", published_from=date(2026, 1, 1), published_to=date(2026, 1, 30)) == [1]
    with pytest.raises(ValueError):
        filters.SearchCriteria(published_from=date(2026, 1, 2), published_to=date(2026, 1, 1))


def test_identity(spark, tenders):
    assert filters.exists(tenders, "T1", "ORG") and not filters.exists(tenders, "T1", "X")
    assert filters.tender_key(tenders, "T4", "ORG") == 4
    with pytest.raises(NotFoundError):
        filters.tender_key(tenders, "T4", "X")
    batch = spark.createDataFrame([("T1", "ORG"), ("T1", ""), (None, "ORG")], "tender_id string, organization_acronym string")
    with pytest.raises(InvalidRowsError):
        filters.identified(batch)
    valid, invalid = filters.identified(batch, strict=False)
    assert (valid.count(), invalid.count()) == (1, 2)
    found, unknown = filters.resolve(tenders, batch)
    assert column(found, "tender_record_id") == [1] and unknown.count() == 2
