"""Small builders shared by the tests."""

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from bidscope.schemas import STATUS_UPDATES, TENDERS

UTC = timezone.utc
MOROCCO = ZoneInfo("Africa/Casablanca")


def tender_rows(spark, rows):
    """Tenders from dicts; missing fields are null, ids ascend from 1."""
    names = TENDERS.fieldNames()
    full = []
    for number, row in enumerate(rows, start=1):
        values = {"id": number, "tender_id": f"T{number}", "organization_acronym": "ORG", **row}
        full.append(tuple(values.get(name) for name in names))
    return spark.createDataFrame(full, TENDERS)


def updates(spark, *rows):
    return spark.createDataFrame(list(rows), STATUS_UPDATES)


def at(year, month, day, hour=12, minute=0, zone=UTC):
    return datetime(year, month, day, hour, minute, tzinfo=zone)


def column(df, name):
    return [row[name] for row in df.collect()]
