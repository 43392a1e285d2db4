"""Aggregate questions over tenders at the caller's ``now``."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bidscope.functions.dates import format_date, instant, response_window
from bidscope.functions.text import group_key, plural, share_percent, spelling
from bidscope.operators.filters import (
    TOP_DIMENSIONS,
    TOP_LIMIT,
    WINDOW_DIMENSIONS,
    InsightsFilter,
    closing_soon,
    in_range,
    is_open,
    one_of,
)


def coverage(tenders: DataFrame, now: datetime, which: InsightsFilter = InsightsFilter()) -> DataFrame:
    """Count, date range and number without deadline, in one pass.

    A tender without a deadline is never open, so that count ignores ``open_only``.
    """
    counted = is_open(now) if which.open_only else F.lit(True)
    published = F.when(counted, F.col("publication_date"))
    return tenders.filter(which.in_period(now)).agg(
        F.count_if(counted).alias("tender_count"),
        F.min(published).alias("earliest_publication_date"),
        F.max(published).alias("latest_publication_date"),
        F.count_if(F.col("deadline").isNull()).alias("without_deadline_count"),
    )


def closing_soon_buckets(tenders: DataFrame, now: datetime) -> DataFrame:
    """Open tenders closing within 14 days, with their bucket, nearest deadline first."""
    deadline = F.col("deadline")
    bucket = (
        F.when(deadline < instant(now) + F.expr("INTERVAL 3 DAYS"), "lt3")
        .when(deadline < instant(now) + F.expr("INTERVAL 7 DAYS"), "3to7")
        .otherwise("7to14")
    )
    return (
        tenders.filter(closing_soon(now))
        .select("id", "reference_number", "tender_object", "public_buyer", "deadline", bucket.alias("bucket"))
        .orderBy("deadline", "id")
    )


def new_this_week(tenders: DataFrame, now: datetime, open_only: bool = False) -> DataFrame:
    """Tenders published in the last seven days, newest first, then newest id first."""
    return (
        tenders.filter(InsightsFilter("7d", open_only).predicate(now))
        .select("id", "reference_number", "tender_object", "public_buyer", "publication_date", "deadline")
        .orderBy(F.desc("publication_date"), F.desc("id"))
    )


def spelling_counts(tenders: DataFrame, dimension: str) -> DataFrame:
    """Tenders per (key, spelling); blank and missing values are left out."""
    value = F.col(dimension)
    return (
        tenders.select(group_key(value).alias("key"), spelling(value).alias("spelling"))
        .filter(F.col("key") != "")
        .groupBy("key", "spelling")
        .agg(F.count("*").alias("n"))
    )


def label_by_key(counts: DataFrame, *aggregates) -> DataFrame:
    """Per key: the most frequent spelling (ties: the smallest), the total, and ``aggregates``.

    ``counts`` has key, spelling and n. An ordinary aggregate, so it combines map-side and one
    key with very many spellings needs no sort of its group.
    """
    order = F.struct(-F.col("n"), F.col("spelling"))
    return counts.groupBy("key").agg(
        F.min_by("spelling", order).alias("label"), F.sum("n").alias("tender_count"), *aggregates
    )


def ranked_spellings(tenders: DataFrame, dimension: str) -> DataFrame:
    """Every spelling with its group's total and its rank in the group."""
    group = W.partitionBy("key")
    return spelling_counts(tenders, dimension).select(
        "key",
        "spelling",
        F.col("n").alias("spelling_count"),
        F.sum("n").over(group).alias("tender_count"),
        F.row_number().over(group.orderBy(F.desc("n"), "spelling")).cast("bigint").alias("rank"),
    )


def top_spellings(tenders: DataFrame, dimension: str) -> DataFrame:
    """The rank-one spelling of every group; the window keeps one row per key and task."""
    best = W.partitionBy("key").orderBy(F.desc("n"), "spelling")
    return (
        spelling_counts(tenders, dimension)
        .withColumn("rank", F.row_number().over(best))
        .filter("rank = 1")
        .select("key", "spelling", F.col("n").alias("spelling_count"))
    )


def top(
    tenders: DataFrame,
    now: datetime,
    dimension: str,
    which: InsightsFilter = InsightsFilter(),
    limit: int = TOP_LIMIT[0],
) -> DataFrame:
    """The values with the most tenders, most first, ties by label."""
    one_of("dimension", dimension, TOP_DIMENSIONS)
    in_range("limit", limit, 1, TOP_LIMIT[1])
    counts = spelling_counts(tenders.filter(which.predicate(now)), dimension)
    return most_tenders(label_by_key(counts)).limit(limit)


def most_tenders(groups: DataFrame, *others: str) -> DataFrame:
    """Groups as a report: most tenders first, ties by label."""
    return groups.select("label", *others, "tender_count").orderBy(F.desc("tender_count"), "label")


def with_shares(top_values: DataFrame) -> DataFrame:
    """Add each value's bar length; the input is a top-k report, so one window task is enough."""
    largest = F.max("tender_count").over(W.partitionBy())
    return top_values.withColumn("share", share_percent(F.col("tender_count"), largest))


def response_windows(
    tenders: DataFrame, now: datetime, which: InsightsFilter = InsightsFilter()
) -> DataFrame:
    """The filtered tenders that have a deadline, with their response window in days."""
    return with_window(tenders.filter(which.predicate(now) & F.col("deadline").isNotNull()))


def with_window(tenders: DataFrame, counted: Column | None = None) -> DataFrame:
    """Tenders with their response window in days; null where they do not count."""
    days = response_window(F.col("deadline"), F.col("publication_date")).cast("bigint")
    return tenders.withColumn("response_window_days", days if counted is None else F.when(counted, days))


def median_windows(windowed: DataFrame, dimension: str) -> DataFrame:
    """Per key: label, exact median window and tender count.

    Rows are first counted per (key, spelling, window), so a group of any size reaches the
    median as a short list of (days, count) pairs.
    """
    value = F.col(dimension)
    pairs = (
        windowed.select(
            group_key(value).alias("key"), spelling(value).alias("spelling"), "response_window_days"
        )
        .filter(F.col("key") != "")
        .groupBy("key", "spelling", "response_window_days")
        .agg(F.count("*").alias("pair_count"))
    )
    return _median_labels(pairs)


def _median_labels(pairs: DataFrame) -> DataFrame:
    spellings = pairs.groupBy("key", "spelling").agg(F.sum("pair_count").alias("n"))
    medians = pairs.groupBy("key").agg(
        F.percentile("response_window_days", F.lit(0.5), F.col("pair_count")).alias("median_days")
    )
    return label_by_key(spellings).join(medians, "key")


def response_window_groups(
    tenders: DataFrame,
    now: datetime,
    dimension: str,
    which: InsightsFilter = InsightsFilter(),
) -> DataFrame:
    """Median response window per value, most tenders first, ties by label."""
    one_of("dimension", dimension, WINDOW_DIMENSIONS)
    return most_tenders(median_windows(response_windows(tenders, now, which), dimension), "median_days")


def short_response_windows(
    tenders: DataFrame, now: datetime, which: InsightsFilter = InsightsFilter()
) -> DataFrame:
    """Tenders whose window is under half their category's median, shortest first, then by id.

    The medians are one row per category, which Spark broadcasts when they are small; beyond
    that the join is a shuffle whose hot categories adaptive execution splits.
    """
    windowed = response_windows(tenders, now, which)
    medians = category_medians(median_windows(windowed, "category"))
    keyed = windowed.withColumn("category_key", group_key(F.col("category")))
    return shorter_than_half(keyed.join(medians, "category_key").filter(is_short()))


def category_medians(medians: DataFrame) -> DataFrame:
    return medians.select(
        F.col("key").alias("category_key"), F.col("median_days").alias("category_median_days")
    )


def is_short() -> Column:
    return F.col("response_window_days") < F.col("category_median_days") / 2


def shorter_than_half(short: DataFrame) -> DataFrame:
    """The short windows as a report: shortest first, then by id."""
    return short.select(
        "id",
        "reference_number",
        "tender_object",
        "public_buyer",
        "category",
        "response_window_days",
        "category_median_days",
    ).orderBy("response_window_days", "id")


def page_counts(
    tenders: DataFrame, now: datetime, which: InsightsFilter = InsightsFilter()
) -> DataFrame:
    """Counts of every dimension in one scan and one shuffle.

    One row per (dimension, key, spelling, response window), the last null without a deadline, and
    one row without a dimension that counts the period. Each task combines its rows first, so a
    value held by very many tenders reaches the shuffle as a few rows of each task.
    """
    counted = is_open(now) if which.open_only else F.lit(True)
    days = F.col("response_window_days")

    def group(dimension: str) -> Column:
        # Windows do not matter where no median is asked for, and would only make more groups.
        window = days if dimension in WINDOW_DIMENSIONS else F.lit(None).cast("bigint")
        value = F.col(dimension)
        return F.struct(
            F.lit(dimension).alias("dimension"),
            group_key(value).alias("key"),
            spelling(value).alias("spelling"),
            window.alias("response_window_days"),
        )

    void = F.lit(None).cast("string")
    period = F.struct(
        void.alias("dimension"),
        void.alias("key"),
        void.alias("spelling"),
        F.lit(None).cast("bigint").alias("response_window_days"),
    )
    groups = [F.when(F.col("counted"), group(dimension)) for dimension in TOP_DIMENSIONS]
    published = F.when(F.col("counted"), F.col("publication_date"))
    exploded = (
        with_window(tenders.filter(which.in_period(now)))
        .withColumn("counted", F.coalesce(counted, F.lit(False)))
        .select("counted", "publication_date", "deadline", F.explode(F.array(period, *groups)).alias("g"))
    )
    return (
        exploded.filter(F.col("g").isNotNull() & (F.col("g.dimension").isNull() | (F.col("g.key") != "")))
        .groupBy("g.dimension", "g.key", "g.spelling", "g.response_window_days")
        .agg(
            F.count_if("counted").alias("n"),
            F.min(published).alias("earliest_publication_date"),
            F.max(published).alias("latest_publication_date"),
            F.count_if(F.col("deadline").isNull()).alias("without_deadline_count"),
        )
    )


def counted_coverage(counts: DataFrame) -> DataFrame:
    """``coverage`` from ``page_counts``; one row even if nothing was counted."""
    return counts.filter(F.col("dimension").isNull()).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tender_count"),
        F.min("earliest_publication_date").alias("earliest_publication_date"),
        F.max("latest_publication_date").alias("latest_publication_date"),
        F.coalesce(F.sum("without_deadline_count"), F.lit(0)).alias("without_deadline_count"),
    )


def counted_spellings(counts: DataFrame, dimension: str) -> DataFrame:
    """``spelling_counts`` from ``page_counts``."""
    chosen = counts.filter(F.col("dimension") == dimension)
    return chosen.groupBy("key", "spelling").agg(F.sum("n").alias("n"))


def counted_medians(counts: DataFrame, dimension: str) -> DataFrame:
    """``median_windows`` from ``page_counts``."""
    one_of("dimension", dimension, WINDOW_DIMENSIONS)
    windowed = (F.col("dimension") == dimension) & F.col("response_window_days").isNotNull()
    return _median_labels(counts.filter(windowed).withColumnRenamed("n", "pair_count"))


def status_report(tenders: DataFrame) -> DataFrame:
    """Tenders per status and last status."""
    return tenders.groupBy("status", "last_status").agg(F.count("*").alias("tender_count"))


def file_report(dce_files: DataFrame) -> DataFrame:
    """Files per outcome and type."""
    return dce_files.groupBy("status", "file_type").agg(F.count("*").alias("file_count"))


def coverage_text(coverage: DataFrame, open_only: bool) -> DataFrame:
    """The coverage row as the sentence and the note people read."""
    # The words of the sentence and the note.
    noun = "open tender" if open_only else "tender"
    earliest, latest = F.col("earliest_publication_date"), F.col("latest_publication_date")
    based = F.concat(
        F.lit("Based on "),
        plural(F.col("tender_count"), noun),
        F.lit(" published between "),
        format_date(earliest),
        F.lit(" and "),
        format_date(latest),
        F.lit("."),
    )
    without = F.col("without_deadline_count")
    shown = earliest.isNotNull()
    note = F.when(shown & (without > 0), F.concat(plural(without, "tender"), F.lit(" without a deadline.")))
    nothing = f"No {noun} was published in this period."
    return coverage.select(F.when(shown, based).otherwise(nothing).alias("sentence"), note.alias("note"))
