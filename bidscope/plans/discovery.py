"""Result pages to stored tenders."""

from datetime import datetime

from pyspark.sql import DataFrame

from bidscope.operators.pages import page_tenders, parse_pages, strict_pages
from bidscope.session import staged
from bidscope.sources.store import TenderStore


def discover(
    pages: DataFrame,
    store: TenderStore,
    now: datetime,
    page: str = "page_id",
    strict: bool = True,
    batch: int | None = None,
    stream: str | None = None,
) -> DataFrame:
    """Save the tenders of all pages, in the order of page and row, and return them.

    ``page`` orders the pages: a number, or the ``url`` of page files. Only the rows that change
    are written. Strict: an empty page, or a tender without identity, stops the run before anything is saved.
    """
    parsed = staged(parse_pages(pages), "parsed-pages")
    if strict:
        strict_pages(parsed)
    found = page_tenders(parsed, page)
    if not found.isEmpty():
        store.upsert(found, now, (page, "row_no"), strict, batch, stream)
    return found
