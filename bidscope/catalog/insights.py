"""Insight queries over the tender view."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bidscope.catalog.base import (
    NOW,
    NOW_SQL,
    ORACLES,
    WINDOW_SQL,
    WITH_TENDERS,
    key_sql,
    period_sql,
    query,
    spelling_sql,
    tenders,
)
from bidscope.functions.dates import days_left, days_left_label, urgency
from bidscope.functions.text import days_text
from bidscope.operators import insights
from bidscope.operators.filters import PERIODS, InsightsFilter
from bidscope.plans.insights_page import insights_page


def _variants():
    for open_only in (False, True):
        yield open_only, "_open" if open_only else ""


def _coverage(period, open_only):
    counted = f"deadline > {NOW_SQL}" if open_only else "true"
    sql = f"""{WITH_TENDERS}
    SELECT count(*) FILTER (WHERE {counted}) AS tender_count,
      min(publication_date) FILTER (WHERE {counted}) AS earliest_publication_date,
      max(publication_date) FILTER (WHERE {counted}) AS latest_publication_date,
      count(*) FILTER (WHERE deadline IS NULL) AS without_deadline_count
    FROM tenders WHERE {period_sql(period)}"""

    @query(f"coverage_{period}{'_open' if open_only else ''}", sql)
    def run(spark, sf_dir):
        return insights.coverage(tenders(spark, sf_dir), NOW, InsightsFilter(period, open_only))


def _top(dimension, open_only):
    sql = f"""{WITH_TENDERS}, counts AS (
      SELECT {key_sql(dimension)} AS key, {spelling_sql(dimension)} AS spelling, count(*) AS n
      FROM tenders WHERE {period_sql('30d', open_only)} AND {key_sql(dimension)} <> ''
      GROUP BY 1, 2
    ), ranked AS (
      SELECT spelling, sum(n) OVER (PARTITION BY key) AS total,
        row_number() OVER (PARTITION BY key ORDER BY n DESC, spelling) AS place FROM counts
    ), best AS (
      SELECT spelling AS label, CAST(total AS BIGINT) AS tender_count FROM ranked
      WHERE place = 1 ORDER BY tender_count DESC, label LIMIT 10
    )
    SELECT label, tender_count,
      round(tender_count * 100.0 / greatest(1, max(tender_count) OVER ()), 6) AS share FROM best"""

    @query(f"top_{dimension}{'_open' if open_only else ''}", sql)
    def run(spark, sf_dir):
        which = InsightsFilter("30d", open_only)
        best = insights.top(tenders(spark, sf_dir), NOW, dimension, which)
        return insights.with_shares(best).withColumn("share", F.round("share", 6))


def _groups(dimension, open_only):
    sql = f"""{WITH_TENDERS}, windowed AS (
      SELECT {key_sql(dimension)} AS key, {spelling_sql(dimension)} AS spelling,
        {WINDOW_SQL} AS days
      FROM tenders WHERE {period_sql('all', open_only)} AND deadline IS NOT NULL
    ), labels AS (
      SELECT key, spelling AS label FROM (SELECT key, spelling, row_number() OVER (
        PARTITION BY key ORDER BY count(*) DESC, spelling) AS place
        FROM windowed WHERE key <> '' GROUP BY key, spelling) WHERE place = 1
    )
    SELECT label, CAST(median(days) AS DOUBLE) AS median_days, count(*) AS tender_count
    FROM windowed JOIN labels USING (key) GROUP BY label"""

    @query(f"response_window_{dimension}{'_open' if open_only else ''}", sql)
    def run(spark, sf_dir):
        which = InsightsFilter("all", open_only)
        return insights.response_window_groups(tenders(spark, sf_dir), NOW, dimension, which)


for _open, _suffix in _variants():
    for _period in PERIODS:
        _coverage(_period, _open)
    for _dimension in ("category", "location", "public_buyer"):
        _top(_dimension, _open)
    for _dimension in ("category", "public_buyer"):
        _groups(_dimension, _open)

    @query(
        f"new_this_week{_suffix}",
        f"""{WITH_TENDERS}
        SELECT id, reference_number, tender_object, public_buyer, publication_date, deadline
        FROM tenders WHERE {period_sql('7d', _open)}""",
    )
    def new_this_week(spark, sf_dir, open_only=_open):
        return insights.new_this_week(tenders(spark, sf_dir), NOW, open_only)


@query(
    "top_public_buyer_all_time",
    f"""{WITH_TENDERS}, counts AS (
      SELECT {key_sql('public_buyer')} AS key, {spelling_sql('public_buyer')} AS spelling,
        count(*) AS n FROM tenders WHERE {period_sql('all')} GROUP BY 1, 2
    ), ranked AS (
      SELECT spelling, sum(n) OVER (PARTITION BY key) AS total,
        row_number() OVER (PARTITION BY key ORDER BY n DESC, spelling) AS place FROM counts
      WHERE key <> ''
    )
    SELECT spelling AS label, CAST(total AS BIGINT) AS tender_count FROM ranked
    WHERE place = 1 ORDER BY tender_count DESC, label LIMIT 50""",
)
def top_public_buyer_all_time(spark, sf_dir):
    which = InsightsFilter("all")
    return insights.top(tenders(spark, sf_dir), NOW, "public_buyer", which, limit=50)


_COUNTS = f"""{WITH_TENDERS}, counts AS (
      SELECT {key_sql('location')} AS key, {spelling_sql('location')} AS spelling, count(*) AS n
      FROM tenders GROUP BY 1, 2 HAVING key <> ''
    )"""


@query("spelling_counts", f"{_COUNTS} SELECT key, spelling, n FROM counts")
def spelling_counts(spark, sf_dir):
    return insights.spelling_counts(tenders(spark, sf_dir), "location")


@query(
    "ranked_spellings",
    f"""{_COUNTS} SELECT key, spelling, n AS spelling_count,
      CAST(sum(n) OVER (PARTITION BY key) AS BIGINT) AS tender_count,
      row_number() OVER (PARTITION BY key ORDER BY n DESC, spelling) AS rank FROM counts""",
)
def ranked_spellings(spark, sf_dir):
    return insights.ranked_spellings(tenders(spark, sf_dir), "location")


@query(
    "top_spellings",
    f"""{_COUNTS} SELECT key, spelling, n AS spelling_count FROM counts
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, spelling) = 1""",
)
def top_spellings(spark, sf_dir):
    return insights.top_spellings(tenders(spark, sf_dir), "location")


_SOON = f"deadline > {NOW_SQL} AND deadline <= {NOW_SQL} + INTERVAL 14 DAY"


@query(
    "closing_soon_buckets",
    f"""{WITH_TENDERS}
    SELECT id, reference_number, tender_object, public_buyer, deadline,
      CASE WHEN deadline < {NOW_SQL} + INTERVAL 3 DAY THEN 'lt3'
        WHEN deadline < {NOW_SQL} + INTERVAL 7 DAY THEN '3to7' ELSE '7to14' END AS bucket
    FROM tenders WHERE {_SOON}""",
)
def closing_soon_buckets(spark, sf_dir):
    return insights.closing_soon_buckets(tenders(spark, sf_dir), NOW)


def _short(period):
    return f"""{WITH_TENDERS}, windowed AS (
      SELECT *, {key_sql('category')} AS key, {WINDOW_SQL} AS response_window_days
      FROM tenders WHERE {period_sql(period)} AND deadline IS NOT NULL
    ), medians AS (
      SELECT key, CAST(median(response_window_days) AS DOUBLE) AS category_median_days
      FROM windowed WHERE key <> '' GROUP BY key
    )
    SELECT id, reference_number, tender_object, public_buyer, category, response_window_days,
      category_median_days
    FROM windowed JOIN medians USING (key) WHERE response_window_days < category_median_days / 2"""


@query("short_response_windows", _short("30d"))
def short_response_windows(spark, sf_dir):
    return insights.short_response_windows(tenders(spark, sf_dir), NOW)


@query("short_response_windows_all_time", _short("all"))
def short_response_windows_all_time(spark, sf_dir):
    return insights.short_response_windows(tenders(spark, sf_dir), NOW, InsightsFilter("all"))


@query(
    "response_window_days_text",
    f"""{WITH_TENDERS}, g AS (
      SELECT {key_sql('category')} AS key, CAST(median({WINDOW_SQL}) AS DOUBLE) AS m FROM tenders
      WHERE {period_sql('all')} AND deadline IS NOT NULL GROUP BY 1 HAVING key <> ''
    )
    SELECT key, CASE WHEN m = floor(m) THEN CAST(CAST(m AS BIGINT) AS VARCHAR)
      ELSE CAST(m AS VARCHAR) END || CASE WHEN m = 1 THEN ' day' ELSE ' days' END AS shown
    FROM g""",
)
def response_window_days_text(spark, sf_dir):
    windowed = insights.response_windows(tenders(spark, sf_dir), NOW, InsightsFilter("all"))
    medians = insights.median_windows(windowed, "category")
    return medians.select("key", days_text(F.col("median_days")).alias("shown"))


@query(
    "coverage_sentence",
    f"""{WITH_TENDERS}, c AS (
      SELECT count(*) AS n, min(publication_date) AS a, max(publication_date) AS b,
        count(*) FILTER (WHERE deadline IS NULL) AS without FROM tenders
      WHERE {period_sql('30d')}
    )
    SELECT CASE WHEN a IS NULL THEN 'No tender was published in this period.'
      ELSE 'Based on ' || n || CASE WHEN n = 1 THEN ' tender' ELSE ' tenders' END
        || ' published between ' || strftime(a, '%d/%m/%Y') || ' and ' || strftime(b, '%d/%m/%Y')
        || '.' END AS sentence,
      CASE WHEN without > 0 THEN without || CASE WHEN without = 1 THEN ' tender' ELSE ' tenders'
        END || ' without a deadline.' END AS note
    FROM c""",
)
def coverage_sentence(spark, sf_dir):
    return insights.coverage_text(insights.coverage(tenders(spark, sf_dir), NOW), open_only=False)


@query(
    "days_left",
    f"""{WITH_TENDERS}, t AS (
      SELECT id, CASE WHEN deadline > {NOW_SQL}
        THEN CAST(floor(epoch(deadline - {NOW_SQL}) / 86400) AS BIGINT) END AS days
      FROM tenders
    )
    SELECT id, days, CASE WHEN days < 3 THEN 'urgent' WHEN days < 7 THEN 'soon'
        WHEN days IS NOT NULL THEN 'later' END AS urgency,
      CASE WHEN days = 0 THEN 'Under 1 day left' WHEN days = 1 THEN '1 day left'
        ELSE days || ' days left' END AS label FROM t""",
)
def days_left_query(spark, sf_dir):
    rows = tenders(spark, sf_dir).select("id", days_left(F.col("deadline"), NOW).alias("days"))
    days = F.col("days")
    return rows.select(
        "id", "days", urgency(days).alias("urgency"), days_left_label(days).alias("label")
    )


@query(
    "status_report",
    f"""{WITH_TENDERS} SELECT status, last_status, count(*) AS tender_count FROM tenders
    GROUP BY ALL""",
)
def status_report(spark, sf_dir):
    return insights.status_report(tenders(spark, sf_dir))


def _all_time_top(dimension):
    return f"""{WITH_TENDERS}, counts AS (
      SELECT {key_sql(dimension)} AS key, {spelling_sql(dimension)} AS spelling, count(*) AS n
      FROM tenders WHERE {period_sql('all')} GROUP BY 1, 2 HAVING key <> ''
    ), best AS (
      SELECT key, arg_min(spelling, (-n, spelling)) AS label, CAST(sum(n) AS BIGINT) AS tender_count
      FROM counts GROUP BY key ORDER BY tender_count DESC, label LIMIT 10
    )
    SELECT label, tender_count, tender_count * 100.0 / greatest(1, max(tender_count) OVER ()) AS share,
      row_number() OVER (ORDER BY tender_count DESC, label) AS place FROM best"""


# Every section of the page: its SQL, and its fields in the order in which the row is written out.
_SECTIONS = {
    "coverage": (
        ORACLES["coverage_all"],
        "tender_count earliest_publication_date latest_publication_date without_deadline_count",
    ),
    "closing_soon": (
        ORACLES["closing_soon_buckets"],
        "id reference_number tender_object public_buyer deadline bucket",
    ),
    "new_this_week": (
        ORACLES["new_this_week"],
        "id reference_number tender_object public_buyer publication_date deadline",
    ),
    "short_response_windows": (
        ORACLES["short_response_windows_all_time"],
        "id reference_number tender_object public_buyer category response_window_days category_median_days",
    ),
    "response_windows_category": (ORACLES["response_window_category"], "label median_days tender_count"),
    "response_windows_public_buyer": (
        ORACLES["response_window_public_buyer"],
        "label median_days tender_count",
    ),
    **{
        f"top_{dimension}": (_all_time_top(dimension), "place label tender_count share")
        for dimension in ("category", "location", "public_buyer")
    },
}
# Numbers with a fraction are written with six decimals.
_FRACTIONS = ("median_days", "category_median_days", "share")


def _written_sql(fields):
    texts = [
        f"coalesce(CAST({f'CAST({name} AS DECIMAL(18, 6))' if name in _FRACTIONS else name} AS VARCHAR), '-')"
        for name in fields.split()
    ]
    return "concat_ws('|', " + ", ".join(texts) + ")"


def _written(fields):
    values = [F.col(name).cast("decimal(18,6)") if name in _FRACTIONS else F.col(name) for name in fields.split()]
    return F.concat_ws("|", *[F.coalesce(value.cast("string"), F.lit("-")) for value in values])


@query(
    "insights_page",
    " UNION ALL ".join(
        f"SELECT '{section}' AS section, {_written_sql(fields)} AS fields FROM ({sql}) AS s"
        for section, (sql, fields) in _SECTIONS.items()
    ),
)
def insights_page_query(spark, sf_dir):
    """All rows of every section of the all-time page, fields as text; tops with their place."""
    sections = insights_page(tenders(spark, sf_dir), NOW, InsightsFilter("all"))
    combined = None
    for section, rows in sections.items():
        if section.startswith("top_"):  # a report of ten rows
            place = F.row_number().over(W.orderBy(F.desc("tender_count"), "label"))
            rows = rows.withColumn("place", place)
        written = rows.select(F.lit(section).alias("section"), _written(_SECTIONS[section][1]).alias("fields"))
        combined = written if combined is None else combined.unionByName(written)
    return combined
