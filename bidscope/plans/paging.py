"""Pages of a stored list at any offset, read by the days they show."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.operators.filters import LIST_LIMIT, in_range
from bidscope.operators.lookup import list_tenders
from bidscope.sources.store import TenderStore


@dataclass(frozen=True)
class PageDays:
    """Which days hold a page, how many tenders of these come before it, and whether more follow."""

    days: tuple[date | None, ...]
    skipped: int
    has_next: bool

    def test(self) -> Column:
        dated = [day for day in self.days if day is not None]
        found = F.lit(False)
        if dated:
            found = F.col("publication_date").between(min(dated), max(dated))
        return found | F.col("publication_date").isNull() if None in self.days else found


def page_days(store: TenderStore, limit: int = LIST_LIMIT[0], offset: int = 0) -> PageDays:
    """Find a page of the list, newest first and undated last, by the tenders of each day.

    One row a day reaches the driver, however many tenders there are.
    """
    in_range("limit", limit, 1, LIST_LIMIT[1])
    in_range("offset", offset, 0)
    counts = store.days().orderBy(F.col("publication_date").desc_nulls_last()).collect()
    begin, skipped, days = 0, 0, []
    for row in counts:
        end = begin + row.n
        if end > offset and begin < offset + limit:
            if not days:
                skipped = offset - begin
            days.append(row.publication_date)
        begin = end
    return PageDays(tuple(days), skipped, begin > offset + limit)


def list_page(store: TenderStore, limit: int = LIST_LIMIT[0], offset: int = 0) -> DataFrame:
    """``list_tenders`` of what is stored, at any offset.

    Only the months of the page's days are read, and of them only these days are sorted, so a page
    far down the list costs what the first one costs.
    """
    page = page_days(store, limit, offset)
    dated = [day for day in page.days if day is not None]
    if not page.days:
        return list_tenders(store.read().filter(F.lit(False)), limit)
    rows = store.read((min(dated), max(dated)) if dated else None, undated=None in page.days)
    return list_tenders(rows.filter(page.test()), limit, page.skipped)
