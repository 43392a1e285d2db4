"""All sections of the insights page, from two scans of the tenders."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.text import group_key
from bidscope.operators import insights
from bidscope.operators.filters import (
    TOP_DIMENSIONS,
    TOP_LIMIT,
    WINDOW_DIMENSIONS,
    InsightsFilter,
    closing_soon,
)
from bidscope.session import staged


def insights_page(
    tenders: DataFrame, now: datetime, which: InsightsFilter = InsightsFilter()
) -> dict[str, DataFrame]:
    """Every section by name, with the rows and the order of its own operator.

    The first scan counts all dimensions at once; the counts are written down and give coverage,
    tops and medians. The second one keeps the tenders that some list shows. Sections read only
    what was written, not the tenders.
    """
    counts = staged(insights.page_counts(tenders, now, which), "insight-counts")
    sections = {"coverage": insights.counted_coverage(counts)}
    for dimension in TOP_DIMENSIONS:
        spellings = insights.counted_spellings(counts, dimension)
        best = insights.most_tenders(insights.label_by_key(spellings)).limit(TOP_LIMIT[0])
        sections[f"top_{dimension}"] = insights.with_shares(best)
    for dimension in WINDOW_DIMENSIONS:
        sections[f"response_windows_{dimension}"] = insights.most_tenders(
            insights.counted_medians(counts, dimension), "median_days"
        )
    listed = staged(_listed(tenders, counts, now, which), "insight-lists")
    soon = listed.filter(closing_soon(now))
    sections["closing_soon"] = insights.closing_soon_buckets(soon, now)
    sections["new_this_week"] = insights.new_this_week(listed, now, which.open_only)
    sections["short_response_windows"] = insights.shorter_than_half(listed.filter("is_short"))
    return sections


def _listed(tenders, counts, now, which) -> DataFrame:
    """The tenders that some list shows, with their window where it is a short one."""
    medians = insights.category_medians(insights.counted_medians(counts, "category"))
    shown = closing_soon(now) | InsightsFilter("7d", which.open_only).predicate(now) | F.col("is_short")
    return (
        insights.with_window(tenders, which.predicate(now))
        .withColumn("category_key", group_key(F.col("category")))
        .join(medians, "category_key", "left")
        .withColumn("is_short", F.coalesce(insights.is_short(), F.lit(False)))
        .filter(shown)
        .select(
            "id",
            "reference_number",
            "tender_object",
            "public_buyer",
            "category",
            "publication_date",
            "deadline",
            "response_window_days",
            "category_median_days",
            "is_short",
        )
    )
