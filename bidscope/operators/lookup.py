"""Paged lists and single tenders."""

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.dates import iso_local
from bidscope.operators.filters import (
    LIST_LIMIT,
    closing_soon,
    has_archive,
    in_range,
    ready_to_index,
)

SUMMARY = ["id", "reference_number", "tender_object", "public_buyer", "deadline", "has_dce_archive"]
DETAIL = [
    "id",
    "tender_id",
    "organization_acronym",
    "reference_number",
    "tender_object",
    "public_buyer",
    "location",
    "category",
    "procurement_type",
    "publication_date",
    "deadline",
    "has_dce_archive",
]


def _newest_first():
    return [F.col("publication_date").desc_nulls_last(), F.col("id")]


def _nearest_deadline_first():
    return [F.col("deadline"), F.col("id")]


def list_tenders(
    tenders: DataFrame,
    limit: int = LIST_LIMIT[0],
    offset: int = 0,
    closing_soon_at: datetime | None = None,
) -> DataFrame:
    """One page: newest first, undated last; or those closing soon, nearest deadline first."""
    in_range("limit", limit, 1, LIST_LIMIT[1])
    return _page(tenders, limit, offset, closing_soon_at)


def _page(tenders, limit, offset, closing_soon_at):
    in_range("offset", offset, 0)
    if closing_soon_at is None:
        chosen, order = tenders, _newest_first()
    else:
        chosen, order = tenders.filter(closing_soon(closing_soon_at)), _nearest_deadline_first()
    return (
        chosen.withColumn("has_dce_archive", has_archive())
        .orderBy(*order)
        .offset(offset)
        .limit(limit)
        .select(*SUMMARY)
    )


def has_next_page(
    tenders: DataFrame, limit: int = LIST_LIMIT[0], offset: int = 0, closing_soon_at: datetime | None = None
) -> DataFrame:
    """One row: how many tenders the page shows, and whether another page follows."""
    in_range("limit", limit, 1, LIST_LIMIT[1])
    fetched = _page(tenders, limit + 1, offset, closing_soon_at).agg(F.count("*").alias("n"))
    return fetched.select(
        F.least(F.col("n"), F.lit(limit)).alias("shown"), (F.col("n") > limit).alias("has_next")
    )


def list_after(
    tenders: DataFrame, last_date: date | None, last_id: int, limit: int = LIST_LIMIT[0]
) -> DataFrame:
    """The page after a given row. Deep pages cost no more than the first one."""
    in_range("limit", limit, 1, LIST_LIMIT[1])
    published, key = F.col("publication_date"), F.col("id")
    if last_date is None:
        after = published.isNull() & (key > last_id)
    else:
        last = F.lit(last_date)
        after = (published < last) | ((published == last) & (key > last_id)) | published.isNull()
    return _page(tenders.filter(after), limit, 0, None)


def get_tender(tenders: DataFrame, key: int) -> DataFrame:
    """Detail of one tender; no row when there is none."""
    return tender_details(tenders.filter(F.col("id") == key))


def tender_details(tenders: DataFrame) -> DataFrame:
    return tenders.withColumn("has_dce_archive", has_archive()).select(*DETAIL)


def with_local_deadline(rows: DataFrame) -> DataFrame:
    """Show the deadline as ISO text in Moroccan time, with its offset."""
    return rows.withColumn("deadline", iso_local(F.col("deadline")))


def find_for_indexing(tenders: DataFrame, limit: int | None = None) -> DataFrame:
    """Tenders ready to index, oldest id first; all of them without a limit."""
    ready = tenders.filter(ready_to_index())
    if limit is None:
        return ready
    in_range("limit", limit, 1)
    return ready.orderBy("id").limit(limit)
