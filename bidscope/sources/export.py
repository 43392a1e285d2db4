"""JSON export of tenders, dates in ISO form."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.dates import iso_local
from bidscope.schemas import TENDER_FIELDS


def export_rows(tenders: DataFrame) -> DataFrame:
    """The ten tender fields, dates as ISO text and deadlines in Moroccan time."""
    shown = {
        "publication_date": F.date_format("publication_date", "yyyy-MM-dd"),
        "deadline": iso_local(F.col("deadline")),
    }
    return tenders.select(
        *[shown.get(c, F.col(c)).alias(c) for c in TENDER_FIELDS.fieldNames()]
    )


def export_json(tenders: DataFrame) -> Column:
    """One JSON text per tender; missing values are written as null."""
    names = TENDER_FIELDS.fieldNames()
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def write_json(tenders: DataFrame, path: str) -> None:
    export_rows(tenders).write.option("ignoreNullFields", "false").json(path)
