from datetime import date, datetime

import pytest
from helpers import UTC, at, column
from pyspark.sql import functions as F

from bidscope.functions import dates, text


def one(spark, expression, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "shown",
    ["20/10/2026 11:00", "20/10/2026<br>11:00", "20/10/2026\n  11:00", "20/10/202611:00", " 20/10/2026 <BR /> 11:00 "],
)
def test_every_deadline_form(spark, shown):
    assert one(spark, lambda c: dates.iso_local(dates.parse_deadline(c)), shown) == "2026-10-20T11:00:00+01:00"


def test_deadline_without_time_closes_at_end_of_day(spark):
    assert one(spark, lambda c: dates.iso_local(dates.parse_deadline(c)), "20/10/2026") == "2026-10-20T23:59:00+01:00"


def test_deadline_in_ramadan_has_no_offset(spark):
    assert one(spark, lambda c: dates.iso_local(dates.parse_deadline(c)), "01/03/2026 10:00") == "2026-03-01T10:00:00+00:00"


@pytest.mark.parametrize(
    ("shown", "unreadable"),
    [("à préciser", True), ("31/02/2026 10:00", True), ("30/01/2026 25:00", True), ("01/01/0000", True), ("20/10/2026 11:00 x", True), ("", False), ("  ", False), (None, False)],
)
def test_unreadable_deadlines_are_null(spark, shown, unreadable):
    df = spark.createDataFrame([(shown,)], "x string")
    parsed = dates.parse_deadline(F.col("x"))
    assert df.select(parsed, dates.unreadable(F.col("x"), parsed)).first() == (None, unreadable)


@pytest.mark.parametrize(
    ("shown", "day"),
    [("15/01/2026", date(2026, 1, 15)), (" 15/01/2026\n", date(2026, 1, 15)), ("31/02/2026", None), ("15/01/26", None), (None, None)],
)
def test_publication_dates(spark, shown, day):
    assert one(spark, dates.parse_publication_date, shown) == day


def test_dates_are_written_back(spark):
    moment = at(2026, 10, 20, 10)
    assert one(spark, dates.format_deadline, moment, "timestamp") == "20/10/2026 11:00"
    assert one(spark, dates.format_date, date(2026, 1, 5), "date") == "05/01/2026"
    precise = datetime(2026, 10, 20, 10, 0, 0, 250000, tzinfo=UTC)
    assert one(spark, dates.iso_local, precise, "timestamp") == "2026-10-20T11:00:00.250000+01:00"


def test_now_needs_a_zone():
    with pytest.raises(ValueError):
        dates.instant(datetime(2026, 1, 1))


def test_days_left(spark):
    now = at(2040, 3, 10)
    rows = [at(2040, 3, 10), at(2040, 3, 10, 13), at(2040, 3, 11), at(2040, 3, 13), at(2040, 3, 17), at(2040, 3, 9), None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, deadline timestamp")
    days = dates.days_left(F.col("deadline"), now)
    shown = df.orderBy("i").select(days.alias("d"), dates.urgency(days).alias("u"), dates.days_left_label(days).alias("l"))
    assert [tuple(r) for r in shown.collect()] == [
        (None, None, None),
        (0, "urgent", "Under 1 day left"),
        (1, "urgent", "1 day left"),
        (3, "soon", "3 days left"),
        (7, "later", "7 days left"),
        (None, None, None),
        (None, None, None),
    ]


def test_text_rules(spark):
    assert one(spark, text.spelling, "  COMMUNE   de\n Rabat ") == "COMMUNE de Rabat"
    assert one(spark, text.group_key, " Rabat ") == "rabat"
    assert one(spark, text.clean, "  a  \n b ") == "a b"
    assert one(spark, text.clean, "   ") is None
    assert [one(spark, text.file_type, p) for p in ("a/X.PdF", ".bashrc", "a.zip/b", "x.tar.gz")] == ["pdf", "", "", "gz"]
    assert one(spark, text.short_title, "x" * 119 + " yz") == "x" * 119 + "…"
    assert one(spark, text.short_title, "x" * 120) == "x" * 120
    assert one(spark, text.short_title, "") == one(spark, text.short_title, None) == "Untitled tender"
    assert one(spark, text.days_text, 11.5, "double") == "11.5 days"
    assert one(spark, text.days_text, 1.0, "double") == "1 day"
    assert one(spark, text.days_text, 12.0, "double") == "12 days"


def test_download_url_is_form_encoded(spark):
    df = spark.createDataFrame([("1 2&é*~", "g3h")], "a string, b string")
    url = df.select(text.download_url(F.col("a"), F.col("b"))).first()[0]
    assert url == "?page=entreprise.EntrepriseDownloadCompleteDce&reference=1+2%26%C3%A9%2A~&orgAcronym=g3h"


def test_failure_reasons_hide_details(spark):
    messages = [
        'could not translate host name "db.internal" to address',
        "Name or service not known",
        "connection to 10.0.0.1 failed: Connection refused",
        "timeout expired",
        'FATAL: password authentication failed for user "u"',
        "secret",
    ]
    df = spark.createDataFrame([(m,) for m in messages], "m string").coalesce(1)
    shown = df.select(text.failure_reason(F.col("m"), F.lit("OperationalError")).alias("r"))
    assert column(shown, "r") == [
        "host does not resolve",
        "host does not resolve",
        "connection refused",
        "connection timed out",
        "authentication failed",
        "connection failed (OperationalError)",
    ]
