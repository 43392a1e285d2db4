"""Predicates over tenders, as Columns, and argument rules."""

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.errors import InvalidRowsError, NotFoundError
from bidscope.functions.dates import MOROCCO, instant, local_date
from bidscope.schemas import ARCHIVED_STATUSES, IDENTITY

# Periods and the calendar days each covers; "all" has no bounds.
PERIODS = {"7d": 7, "30d": 30, "90d": 90, "all": None}
# Page and report limits, as (default, largest).
LIST_LIMIT = (50, 200)
TOP_LIMIT = (10, 50)
TOP_DIMENSIONS = ("public_buyer", "category", "location")
WINDOW_DIMENSIONS = ("category", "public_buyer")


def is_open(now: datetime) -> Column:
    return F.col("deadline") > instant(now)


def closing_soon(now: datetime) -> Column:
    """Open, with the deadline at most 14 days after now. Compares instants, never dates."""
    deadline = F.col("deadline")
    return (deadline > instant(now)) & (deadline <= instant(now) + F.expr("INTERVAL 14 DAYS"))


@dataclass(frozen=True)
class InsightsFilter:
    """Which tenders an insight counts."""

    period: str = "30d"
    open_only: bool = False

    def __post_init__(self) -> None:
        one_of("period", self.period, PERIODS)

    def in_period(self, now: datetime) -> Column:
        """Published in the N Moroccan calendar days ending today; any date for ``all``.

        The bounds fold to literals, so the test reaches the file scan.
        """
        published = F.col("publication_date")
        days = PERIODS[self.period]
        if days is None:
            return published.isNotNull()
        today = local_date(instant(now))
        return (published > F.date_sub(today, days)) & (published <= today)

    def days(self, now: datetime) -> tuple[date, date] | None:
        """First and last day of the period, for scans laid out by month; None for ``all``."""
        length = PERIODS[self.period]
        if length is None:
            return None
        today = now.astimezone(ZoneInfo(MOROCCO)).date()
        return today - timedelta(days=length - 1), today

    def predicate(self, now: datetime) -> Column:
        return self.in_period(now) & is_open(now) if self.open_only else self.in_period(now)


def failed_after_upload() -> Column:
    return (F.col("status") == "FAILED") & F.col("last_status").isin(*ARCHIVED_STATUSES)


def has_archive() -> Column:
    """Whether the archive is in storage; a FAILED tender without a last status has none."""
    known = F.col("status").isin(*ARCHIVED_STATUSES) | failed_after_upload()
    return F.coalesce(known, F.lit(False))


def ready_to_index() -> Column:
    return (F.col("status") == "UPLOADED") | failed_after_upload()


def same_model(model: str) -> Column:
    return F.col("embedding_model") == model


def has_identity() -> Column:
    present = [F.coalesce(F.col(name) != "", F.lit(False)) for name in IDENTITY]
    return present[0] & present[1]


def identified(tenders: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split into tenders with and without identity; strict refuses the whole batch."""
    invalid = tenders.filter(~has_identity())
    if strict and not invalid.isEmpty():
        raise InvalidRowsError("every tender needs a tender_id and an organization_acronym")
    return tenders.filter(has_identity()), invalid


@dataclass(frozen=True)
class SearchCriteria:
    """Criteria of a discovery search, applied to stored tenders."""

    keyword: str | None = None
    buyer: str | None = None
    organization: str | None = None
    published_from: date | None = None
    published_to: date | None = None

    def __post_init__(self) -> None:
        if self.published_from and self.published_to and self.published_from > self.published_to:
            raise ValueError("published_from must not be after published_to")

    def predicate(self) -> Column:
        tests = [F.lit(True)]
        if self.keyword:
            tests.append(F.lower("tender_object").contains(self.keyword.lower()))
        if self.buyer:
            tests.append(F.lower("public_buyer").contains(self.buyer.lower()))
        if self.organization:
            tests.append(F.col("organization_acronym") == self.organization)
        if self.published_from:
            tests.append(F.col("publication_date") >= F.lit(self.published_from))
        if self.published_to:
            tests.append(F.col("publication_date") <= F.lit(self.published_to))
        combined = tests[0]
        for test in tests[1:]:
            combined = combined & test
        return combined


def search_tenders(tenders: DataFrame, criteria: SearchCriteria) -> DataFrame:
    return tenders.filter(criteria.predicate())


def exists(tenders: DataFrame, tender_id: str, organization: str) -> bool:
    return not tenders.filter(_is(tender_id, organization)).isEmpty()


def tender_key(tenders: DataFrame, tender_id: str, organization: str) -> int:
    """The id of one tender, by identity."""
    found = tenders.filter(_is(tender_id, organization)).select("id").take(1)
    if not found:
        raise NotFoundError(f"no tender {tender_id!r} of organisation {organization!r}")
    return found[0].id


def _is(tender_id: str, organization: str) -> Column:
    return (F.col("tender_id") == tender_id) & (F.col("organization_acronym") == organization)


def resolve(tenders: DataFrame, identities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch form: identities with their ``tender_record_id``, and those that match no tender."""
    keys = tenders.select(*IDENTITY, F.col("id").alias("tender_record_id"))
    return identities.join(keys, IDENTITY), identities.join(keys, IDENTITY, "left_anti")


def resolve_all(tenders: DataFrame, identities: DataFrame) -> DataFrame:
    """``tender_record_id`` of every identity; an unknown one is an error."""
    found, unknown = resolve(tenders, identities.select(*IDENTITY).distinct())
    if not unknown.isEmpty():
        raise NotFoundError("some tenders do not exist")
    return found.select("tender_record_id")


def one_of(name: str, value: str, allowed) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}")
    return value


def in_range(name: str, value: int, low: int, high: int | None = None) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < low:
        raise ValueError(f"{name} must be a whole number of at least {low}")
    if high is not None and value > high:
        raise ValueError(f"{name} must be at most {high}")
    return value
