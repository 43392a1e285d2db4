"""Dates and deadlines. Instants are UTC; what people read is Moroccan local time."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidscope.functions.text import SPACE, has_text

MOROCCO = "Africa/Casablanca"

# The platform's date forms, groups day, month, year, hour, minute. Year 0000 is none.
_DATE = rf"^{SPACE}*(\d{{2}})/(\d{{2}})/((?!0000)\d{{4}})"
DAY = rf"{_DATE}{SPACE}*$"
DAY_AND_TIME = rf"(?i){_DATE}(?:{SPACE}|<br{SPACE}*/?>)*(\d{{2}}):(\d{{2}}){SPACE}*$"
# A deadline without a time closes at the end of its day.
END_OF_DAY = "23:59"


def instant(now: datetime) -> Column:
    """A literal for the caller's clock, which must carry a time zone."""
    if now.tzinfo is None:
        raise ValueError("now must carry a time zone")
    return F.lit(now)


def local_time(value: Column) -> Column:
    """The Moroccan wall-clock time of an instant (the session time zone is UTC)."""
    return F.from_utc_timestamp(value, MOROCCO)


def local_date(value: Column) -> Column:
    return F.to_date(local_time(value))


def parse_publication_date(text: Column) -> Column:
    """``DD/MM/YYYY`` to a date; anything else, or a day that does not exist, is null."""
    return F.to_date(_moment(text, DAY, "00:00"))


def parse_deadline(text: Column) -> Column:
    """``DD/MM/YYYY`` with an optional ``HH:mm`` to an instant; anything else is null."""
    local = F.coalesce(_moment(text, DAY_AND_TIME, "$4:$5"), _moment(text, DAY, END_OF_DAY))
    return F.to_utc_timestamp(local, MOROCCO)


def _moment(text: Column, pattern: str, time: str) -> Column:
    """Text of one form as a time without zone; one pass to test it and one to rearrange it."""
    rearranged = F.regexp_replace(text, pattern, f"$3-$2-$1 {time}")
    return F.when(text.rlike(pattern), F.try_to_timestamp(rearranged, F.lit("yyyy-MM-dd HH:mm")))


def unreadable(text: Column, parsed: Column) -> Column:
    """True where there was text but no value could be read from it."""
    return has_text(text) & parsed.isNull()


def format_date(value: Column) -> Column:
    return F.date_format(value, "dd/MM/yyyy")


def format_time(deadline: Column) -> Column:
    return F.date_format(local_time(deadline), "HH:mm")


def format_deadline(deadline: Column) -> Column:
    return F.date_format(local_time(deadline), "dd/MM/yyyy HH:mm")


def iso_local(deadline: Column) -> Column:
    """ISO 8601 text in Moroccan time with its offset, e.g. ``2040-03-10T14:00:00+01:00``."""
    shown = local_time(deadline)
    minutes = F.timestamp_diff("MINUTE", deadline, shown)
    fraction = F.date_format(shown, ".SSSSSS")
    return F.concat(
        F.date_format(shown, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == ".000000", "").otherwise(fraction),
        F.when(minutes < 0, "-").otherwise("+"),
        F.format_string("%02d:%02d", F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60),
    )


def response_window(deadline: Column, publication_date: Column) -> Column:
    """Days from publication to the deadline's Moroccan date; may be negative."""
    return F.date_diff(local_date(deadline), publication_date)


def days_left(deadline: Column, now: datetime) -> Column:
    """Whole days until the deadline, null once it has passed."""
    seconds = F.timestamp_diff("MICROSECOND", instant(now), deadline)
    return F.when(seconds > 0, F.floor(seconds / 86_400_000_000))


def urgency(days: Column) -> Column:
    return F.when(days < 3, "urgent").when(days < 7, "soon").when(days.isNotNull(), "later")


def days_left_label(days: Column) -> Column:
    # The words of the label.
    return (
        F.when(days == 0, "Under 1 day left")
        .when(days == 1, "1 day left")
        .otherwise(F.concat(days.cast("string"), F.lit(" days left")))
    )
