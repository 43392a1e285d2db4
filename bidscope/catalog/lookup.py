"""Lookup, filter and text-rule queries over the tender view."""

from datetime import date

from pyspark.sql import functions as F

from bidscope.catalog.base import (
    HAS_ARCHIVE_SQL,
    LOCAL_DEADLINE,
    NOW,
    NOW_SQL,
    READY_SQL,
    WITH_TENDERS,
    query,
    table,
    tenders,
)
from bidscope.functions import dates, text
from bidscope.operators import filters, lookup
from bidscope.plans import paging
from bidscope.schemas import TENDERS
from bidscope.session import scratch_path
from bidscope.sources import export
from bidscope.sources.keywords import KeywordIndex
from bidscope.sources.store import TenderStore

_SUMMARY = f"""id, reference_number, tender_object, public_buyer, deadline,
  {HAS_ARCHIVE_SQL} AS has_dce_archive"""
_SOON = f"deadline > {NOW_SQL} AND deadline <= {NOW_SQL} + INTERVAL 14 DAY"


@query(
    "list_page",
    f"""{WITH_TENDERS} SELECT {_SUMMARY} FROM tenders
    ORDER BY publication_date DESC NULLS LAST, id LIMIT 50 OFFSET 100""",
)
def list_page(spark, sf_dir):
    return lookup.list_tenders(tenders(spark, sf_dir), offset=100)


@query(
    "closing_soon_page",
    f"""{WITH_TENDERS} SELECT {_SUMMARY} FROM tenders WHERE {_SOON}
    ORDER BY deadline, id LIMIT 20 OFFSET 20""",
)
def closing_soon_page(spark, sf_dir):
    return lookup.list_tenders(tenders(spark, sf_dir), 20, 20, closing_soon_at=NOW)


@query(
    "list_after",
    f"""{WITH_TENDERS} SELECT {_SUMMARY} FROM tenders
    WHERE publication_date < DATE '1995-01-05' OR publication_date IS NULL
      OR (publication_date = DATE '1995-01-05' AND id > 500)
    ORDER BY publication_date DESC NULLS LAST, id LIMIT 200""",
)
def list_after(spark, sf_dir):
    return lookup.list_after(tenders(spark, sf_dir), date(1995, 1, 5), 500, 200)


@query(
    "list_has_next",
    f"""{WITH_TENDERS}, page AS (SELECT id FROM tenders WHERE {_SOON} ORDER BY deadline, id
      LIMIT 51 OFFSET 40)
    SELECT least(count(*), 50) AS shown, count(*) > 50 AS has_next FROM page""",
)
def list_has_next(spark, sf_dir):
    return lookup.has_next_page(tenders(spark, sf_dir), 50, 40, closing_soon_at=NOW)


_DEEP = f"""{WITH_TENDERS}, placed AS (SELECT {_SUMMARY},
      row_number() OVER (ORDER BY publication_date DESC NULLS LAST, id) AS place, count(*) OVER () AS n
    FROM tenders)"""


def _stored(spark, sf_dir):
    store = TenderStore(spark, scratch_path(spark, "tenders"))
    store.write(tenders(spark, sf_dir).select(*TENDERS.fieldNames()))
    return store


@query(
    "list_deep_page",
    f"{_DEEP} SELECT * EXCLUDE (place, n) FROM placed WHERE place > n * 4 // 5 AND place <= n * 4 // 5 + 50",
)
def list_deep_page(spark, sf_dir):
    """A page four fifths down the stored list."""
    store = _stored(spark, sf_dir)
    total = store.days().agg(F.sum("n")).first()[0]
    return paging.list_page(store, offset=total * 4 // 5)


@query(
    "list_last_page",
    f"{_DEEP} SELECT * EXCLUDE (place, n) FROM placed WHERE place > n - 20",
)
def list_last_page(spark, sf_dir):
    """The end of the list, where tenders without a date lie."""
    store = _stored(spark, sf_dir)
    total = store.days().agg(F.sum("n")).first()[0]
    return paging.list_page(store, offset=total - 20)


_DETAIL = f"""id, tender_id, organization_acronym, reference_number, tender_object, public_buyer,
  location, category, procurement_type, publication_date, deadline,
  {HAS_ARCHIVE_SQL} AS has_dce_archive"""


@query("tender_detail", f"{WITH_TENDERS} SELECT {_DETAIL} FROM tenders WHERE id = 7")
def tender_detail(spark, sf_dir):
    return lookup.get_tender(tenders(spark, sf_dir), 7)


@query("tender_details", f"{WITH_TENDERS} SELECT {_DETAIL} FROM tenders")
def tender_details(spark, sf_dir):
    return lookup.tender_details(tenders(spark, sf_dir))


@query(
    "search_criteria",
    f"""{WITH_TENDERS} SELECT id, tender_object, public_buyer, publication_date FROM tenders
    WHERE contains(lower(tender_object), 'works') AND contains(lower(public_buyer), '0001')
      AND organization_acronym = 'ORG7'
      AND publication_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
)
def search_criteria(spark, sf_dir):
    criteria = filters.SearchCriteria(
        "Works", "0001", "ORG7", date(1996, 1, 1), date(2000, 12, 31)
    )
    found = filters.search_tenders(tenders(spark, sf_dir), criteria)
    return found.select("id", "tender_object", "public_buyer", "publication_date")


@query("search_keyword", f"""{WITH_TENDERS} SELECT id, tender_object, public_buyer FROM tenders
    WHERE contains(lower(tender_object), 'customer#00000001') AND contains(lower(public_buyer), '00017')""")
def search_keyword(spark, sf_dir):
    """The same search by postings: only the folders of the rarest pieces are opened."""
    rows = tenders(spark, sf_dir)
    index = KeywordIndex(spark, scratch_path(spark, "keywords"))
    index.build(rows)
    found = index.search(rows, filters.SearchCriteria("Customer#00000001", "00017"))
    return found.select("id", "tender_object", "public_buyer")


@query(
    "ready_to_index",
    f"{WITH_TENDERS} SELECT id, status, last_status FROM tenders WHERE {READY_SQL}",
)
def ready_to_index(spark, sf_dir):
    return lookup.find_for_indexing(tenders(spark, sf_dir)).select("id", "status", "last_status")


@query(
    "indexing_batch",
    f"{WITH_TENDERS} SELECT id, tender_id FROM tenders WHERE {READY_SQL} ORDER BY id LIMIT 100",
)
def indexing_batch(spark, sf_dir):
    return lookup.find_for_indexing(tenders(spark, sf_dir), 100).select("id", "tender_id")


@query(
    "has_archive_counts",
    f"""{WITH_TENDERS} SELECT status, {HAS_ARCHIVE_SQL} AS has_dce_archive, count(*) AS n
    FROM tenders GROUP BY ALL""",
)
def has_archive_counts(spark, sf_dir):
    flagged = tenders(spark, sf_dir).withColumn("has_dce_archive", filters.has_archive())
    return flagged.groupBy("status", "has_dce_archive").agg(F.count("*").alias("n"))


@query(
    "display_dates",
    f"""{WITH_TENDERS} SELECT id, strftime(publication_date, '%d/%m/%Y') AS published,
      strftime({LOCAL_DEADLINE}, '%d/%m/%Y') AS closes_on,
      strftime({LOCAL_DEADLINE}, '%H:%M') AS closes_at,
      strftime({LOCAL_DEADLINE}, '%d/%m/%Y %H:%M') AS closes,
      strftime({LOCAL_DEADLINE}, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso
    FROM tenders""",
)
def display_dates(spark, sf_dir):
    deadline = F.col("deadline")
    return tenders(spark, sf_dir).select(
        "id",
        dates.format_date(F.col("publication_date")).alias("published"),
        dates.format_date(dates.local_time(deadline)).alias("closes_on"),
        dates.format_time(deadline).alias("closes_at"),
        dates.format_deadline(deadline).alias("closes"),
        dates.iso_local(deadline).alias("iso"),
    )


@query(
    "short_titles",
    f"""{WITH_TENDERS} SELECT id, CASE WHEN tender_object IS NULL OR tender_object = ''
        THEN 'Untitled tender' WHEN length(tender_object) > 120
        THEN rtrim(substring(tender_object, 1, 120)) || '…' ELSE tender_object END AS title
    FROM tenders""",
)
def short_titles(spark, sf_dir):
    title = text.short_title(F.col("tender_object"))
    return tenders(spark, sf_dir).select("id", title.alias("title"))


@query(
    "archive_names",
    f"""{WITH_TENDERS} SELECT id, tender_id || '_' || organization_acronym || '.zip' AS name,
      '?page=entreprise.EntrepriseDownloadCompleteDce&reference='
        || replace(url_encode(reference_number), '%20', '+')
        || '&orgAcronym=' || organization_acronym AS url
    FROM tenders""",
)
def archive_names(spark, sf_dir):
    tender, organization = F.col("tender_id"), F.col("organization_acronym")
    return tenders(spark, sf_dir).select(
        "id",
        text.archive_name(tender, organization).alias("name"),
        text.download_url(F.col("reference_number"), organization).alias("url"),
    )


@query(
    "file_types",
    r"""SELECT page_id, lower(regexp_extract(url, '[^/]\.([^./]+)$', 1)) AS file_type
    FROM pages""",
)
def file_types(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", text.file_type(F.col("url")).alias("file_type"))


_MARKED = """SELECT event_id, CASE event_type
    WHEN 'view' THEN 'Could not translate HOST name "db-' || user_id || '"'
    WHEN 'click' THEN 'connection to 10.0.0.' || user_id || ' failed: Connection refused'
    WHEN 'error' THEN 'Timeout expired after ' || value || ' s'
    WHEN 'purchase' THEN 'FATAL: password authentication failed for user u' || user_id
    ELSE 'ssl closed by ' || user_id END AS message FROM {events}"""


@query(
    "reason_classes",
    f"""WITH marked AS ({_MARKED.format(events="events")}), lowered AS (
      SELECT event_id, lower(message) AS m FROM marked)
    SELECT event_id, CASE WHEN contains(m, 'could not translate host name')
        OR contains(m, 'name or service not known') OR contains(m, 'nodename nor servname')
        THEN 'host does not resolve'
      WHEN contains(m, 'connection refused') THEN 'connection refused'
      WHEN contains(m, 'timeout expired') OR contains(m, 'timed out') THEN 'connection timed out'
      WHEN contains(m, 'password authentication failed') THEN 'authentication failed'
      ELSE 'connection failed (OperationalError)' END AS reason
    FROM lowered""",
)
def reason_classes(spark, sf_dir):
    marked = spark.sql(_MARKED, events=table(spark, sf_dir, "events"))
    reason = text.failure_reason(F.col("message"), F.lit("OperationalError"))
    return marked.select("event_id", reason.alias("reason"))


@query(
    "local_dates_events",
    """SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Africa/Casablanca' AS DATE)
      AS local_day FROM events""",
)
def local_dates_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", dates.local_date(F.col("ts")).alias("local_day"))


_LOCAL_TS = "((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Africa/Casablanca')"


@query(
    "display_dates_events",
    f"""SELECT event_id, strftime({_LOCAL_TS}, '%d/%m/%Y') AS day, strftime({_LOCAL_TS}, '%H:%M') AS time,
      strftime({_LOCAL_TS}, '%d/%m/%Y %H:%M') AS shown,
      strftime({_LOCAL_TS}, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN {_LOCAL_TS} > ts THEN '+01:00' ELSE '+00:00' END AS iso
    FROM events""",
)
def display_dates_events(spark, sf_dir):
    """Instants of a time of the year when the local clock is an hour ahead."""
    ts = F.date_trunc("second", "ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.format_date(dates.local_time(ts)).alias("day"),
        dates.format_time(ts).alias("time"),
        dates.format_deadline(ts).alias("shown"),
        dates.iso_local(ts).alias("iso"),
    )


@query(
    "known_tenders",
    f"""{WITH_TENDERS} SELECT event_id, user_id * 101 IN (SELECT id FROM tenders) AS known,
      CASE WHEN user_id * 101 IN (SELECT id FROM tenders) THEN user_id * 101 END
        AS tender_record_id
    FROM events""",
)
def known_tenders(spark, sf_dir):
    """Identities named by events, resolved in one batch."""
    keys = tenders(spark, sf_dir).select("id", "tender_id", "organization_acronym")
    named = table(spark, sf_dir, "events").withColumn("key", F.col("user_id") * 101)
    owners = keys.select(F.col("id").alias("key"), "organization_acronym")
    named = named.join(owners, "key", "left").select(
        "event_id",
        F.col("key").cast("string").alias("tender_id"),
        F.coalesce("organization_acronym", F.lit("NONE")).alias("organization_acronym"),
    )
    found, unknown = filters.resolve(keys, named)
    return (
        found.withColumn("known", F.lit(True))
        .unionByName(unknown.withColumn("known", F.lit(False)), allowMissingColumns=True)
        .select("event_id", "known", "tender_record_id")
    )


@query(
    "identified_tenders",
    f"""{WITH_TENDERS}, t AS (SELECT id, trim(location) AS place, organization_acronym AS org
      FROM tenders)
    SELECT id, coalesce(place <> '', false) AS identified FROM t""",
)
def identified_tenders(spark, sf_dir):
    rows = tenders(spark, sf_dir).withColumn("tender_id", F.trim("location"))
    valid, invalid = filters.identified(rows, strict=False)
    return valid.select("id", F.lit(True).alias("identified")).unionByName(
        invalid.select("id", F.lit(False).alias("identified"))
    )


@query(
    "export_json",
    f"""{WITH_TENDERS}, shown AS (SELECT id, tender_id, organization_acronym, procurement_type,
        category, strftime(publication_date, '%Y-%m-%d') AS publication_date, reference_number,
        tender_object, public_buyer, location,
        strftime({LOCAL_DEADLINE}, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS deadline FROM tenders)
    SELECT CAST(to_json({{tender_id: tender_id, organization_acronym: organization_acronym,
      procurement_type: procurement_type, category: category, publication_date: publication_date,
      reference_number: reference_number, tender_object: tender_object,
      public_buyer: public_buyer, location: location, deadline: deadline}}) AS VARCHAR) AS json
    FROM shown""",
)
def export_json(spark, sf_dir):
    rows = export.export_rows(tenders(spark, sf_dir))
    return rows.select(export.export_json(rows).alias("json"))
