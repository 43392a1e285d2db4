"""Scans. A given schema spares the footer reads of inference and prunes at the file."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope import schemas


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; timestamps stored without a zone are taken as UTC instants."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return as_instants(reader.parquet(path))


def as_instants(df: DataFrame) -> DataFrame:
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in plain}) if plain else df


def tenders(spark: SparkSession, path: str, published: tuple | None = None) -> DataFrame:
    """Tenders as ``write_tenders`` lays them out, or in any other way.

    With ``published`` (first and last day, as ``InsightsFilter.days`` gives them), only the
    folders of those months are read; the days themselves are left to the filter.
    """
    if published is None:
        return read_table(spark, path, schemas.TENDERS)
    dated = T.StructType([*schemas.TENDERS, T.StructField("month", schemas.DAY)])
    rows = read_table(spark, path, dated).filter(in_months(F.col("month"), published))
    return rows.select(*schemas.TENDERS.fieldNames())


def in_months(month: Column, published: tuple) -> Column:
    """Whether a month, a folder's name, lies between those of the first and the last day."""
    first, last = (day.replace(day=1) for day in published)
    return (month >= F.lit(first)) & (month <= F.lit(last))


def dce_files(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.DCE_FILES)


def chunks(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.CHUNKS)


def result_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved result pages, one per row."""
    return spark.read.schema(schemas.RESULT_PAGES).parquet(path)


def result_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Saved result pages, one per text file; ``url`` is the file's, and its order is theirs.

    Pages of a run should have names that sort as they were fetched: ``discover(page="url")``.
    """
    pages = spark.read.text(path, wholetext=True)
    return pages.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def by_month(tenders: DataFrame) -> DataFrame:
    """Add the publication month and lay rows out by it, sorted by day and id.

    Ranges of (month, date, id) are of equal size, so a busy month fills several files and a
    quiet one shares its task with others.
    """
    order = ["month", "publication_date", "id"]
    rows = tenders.withColumn("month", F.trunc("publication_date", "month"))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def write_tenders(tenders: DataFrame, path: str) -> None:
    """Partitioned by publication month and sorted inside, for skipping files and row groups."""
    by_month(tenders).write.mode("errorifexists").partitionBy("month").parquet(path)
