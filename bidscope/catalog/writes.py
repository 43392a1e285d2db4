"""Upserts, status changes, replacement and checks, on tables derived from the tender view."""

from pyspark.sql import functions as F

from bidscope.catalog.base import (
    LOCAL_DEADLINE,
    NOW,
    NOW_SQL,
    ORACLES,
    WITH_TENDERS,
    query,
    table,
    tenders,
)
from bidscope.functions.dates import parse_deadline, parse_publication_date
from bidscope.operators import contract, writes
from bidscope.operators.insights import file_report
from bidscope.schemas import TENDERS
from bidscope.session import scratch_path, staged
from bidscope.sources.store import TenderStore

# What was known at NOW, and every line item as a later sighting of its tender.
KNOWN = "(publication_date IS NULL OR publication_date <= DATE '2000-06-15')"
_SIGHTED = """SELECT CAST(l_orderkey * 16 + l_linenumber AS BIGINT) AS seq, l_orderkey AS id,
    CAST(max(l_shipdate) AS DATE) AS shipped, max(l_returnflag) AS flag, l_linenumber AS line
  FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""
_BATCH = """SELECT seq, tender_id, organization_acronym, procurement_type, 'Relisted' AS category,
    shipped AS publication_date, reference_number,
    'Line ' || CAST(line AS {text}) || ' ' || flag AS tender_object,
    CASE WHEN flag = 'R' THEN NULL ELSE upper(public_buyer) END AS public_buyer, location,
    CAST(shipped AS TIMESTAMP) AS deadline
  FROM ({sighted}) AS s JOIN {tenders} AS t ON t.id = s.id"""

_WITH_BATCH = f"""{WITH_TENDERS}, existing AS (SELECT * FROM tenders WHERE {KNOWN}),
    batch AS ({_BATCH.format(sighted=_SIGHTED.format(lineitem="lineitem"), tenders="tenders",
                             text="VARCHAR")}),
    latest AS (SELECT *, min(seq) OVER one AS first_seq FROM batch
      WINDOW one AS (PARTITION BY tender_id, organization_acronym)
      QUALIFY row_number() OVER (PARTITION BY tender_id, organization_acronym
        ORDER BY seq DESC) = 1)"""


def sightings(spark, sf_dir, rows=None):
    """``rows`` is the tender view where it was computed before."""
    text = _BATCH.format(sighted=_SIGHTED, tenders="{tenders}", text="STRING")
    return spark.sql(
        text, lineitem=table(spark, sf_dir, "lineitem"), tenders=rows or tenders(spark, sf_dir)
    )


@query(
    "dedupe_last_wins",
    f"""{_WITH_BATCH} SELECT tender_id, organization_acronym, tender_object, public_buyer,
      publication_date, first_seq FROM latest""",
)
def dedupe_last_wins(spark, sf_dir):
    return writes.dedupe_last(sightings(spark, sf_dir)).select(
        "tender_id",
        "organization_acronym",
        "tender_object",
        "public_buyer",
        "publication_date",
        F.col("first_seen.seq").alias("first_seq"),
    )


_STATE = """id, tender_id, organization_acronym, category, publication_date, reference_number,
  tender_object, public_buyer, location, deadline, status, last_status, created_at, updated_at"""


@query(
    "upsert_tenders",
    f"""{_WITH_BATCH}, kept AS (
      SELECT e.* REPLACE (
        CASE WHEN l.seq IS NULL THEN e.tender_object ELSE l.tender_object END AS tender_object,
        CASE WHEN l.seq IS NULL THEN e.public_buyer ELSE l.public_buyer END AS public_buyer,
        CASE WHEN l.seq IS NULL THEN e.publication_date ELSE l.publication_date END
          AS publication_date,
        CASE WHEN l.seq IS NULL THEN e.updated_at ELSE {NOW_SQL} END AS updated_at)
      FROM existing e LEFT JOIN latest l USING (tender_id, organization_acronym)
    ), added AS (
      SELECT (SELECT max(id) FROM existing) + row_number() OVER (ORDER BY first_seq) AS id, l.*,
        'DISCOVERED' AS status, CAST(NULL AS VARCHAR) AS last_status, {NOW_SQL} AS created_at,
        {NOW_SQL} AS updated_at
      FROM latest l ANTI JOIN existing e USING (tender_id, organization_acronym)
    )
    SELECT {_STATE} FROM kept UNION ALL SELECT {_STATE} FROM added""",
)
def upsert_tenders(spark, sf_dir):
    known = staged(tenders(spark, sf_dir).filter(KNOWN), "known-tenders")
    return writes.upsert(known, sightings(spark, sf_dir), NOW).select(
        *[name.strip() for name in _STATE.split(",")]
    )


@query("store_upsert", ORACLES["upsert_tenders"])
def store_upsert(spark, sf_dir):
    """The same sightings saved to a store in two batches, which open their own buckets of keys only.

    Orders are cut in two, so that batches do not repeat a tender and ids stay in order.
    """
    store = TenderStore(spark, scratch_path(spark, "tenders"))
    rows = staged(tenders(spark, sf_dir), "tender-view")
    store.write(rows.filter(KNOWN).select(*TENDERS.fieldNames()))
    found = staged(sightings(spark, sf_dir, rows), "sightings")
    middle = found.agg(F.max("seq")).first()[0] // 32 * 16
    for part in (F.col("seq") < middle, F.col("seq") >= middle):
        store.upsert(found.filter(part), NOW)
    return store.read().select(*[name.strip() for name in _STATE.split(",")])


_UPDATES = """SELECT e.event_id AS seq, CAST(e.user_id * 101 AS {text}) AS tender_id,
    coalesce(t.organization_acronym, 'NONE') AS organization_acronym,
    CASE e.event_type WHEN 'view' THEN 'DOWNLOADING' WHEN 'click' THEN 'UPLOADED'
      WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'INDEXED' ELSE 'CHUNKING' END AS status,
    CASE WHEN e.event_type = 'error' AND e.value < 5 THEN 'FAILED'
      WHEN e.event_type = 'error' AND e.value > 8 THEN 'CHUNKED'
      WHEN e.event_type = 'signup' AND e.value > 20 THEN 'UPLOADED' END AS last_status
  FROM {events} AS e LEFT JOIN {tenders} AS t ON t.id = e.user_id * 101"""
_SOUND = """coalesce(CASE WHEN status = 'FAILED' THEN last_status <> 'FAILED'
    ELSE last_status IS NULL END, false)"""
_WITH_UPDATES = f"""{WITH_TENDERS},
    updates AS ({_UPDATES.format(text="VARCHAR", events="events", tenders="tenders")}),
    latest AS (SELECT * FROM updates WHERE {_SOUND} QUALIFY row_number() OVER (
      PARTITION BY tender_id, organization_acronym ORDER BY seq DESC) = 1)"""


def status_events(spark, sf_dir, rows=None):
    """``rows`` is the tender view where it was computed before."""
    return spark.sql(
        _UPDATES.replace("{text}", "STRING"),
        events=table(spark, sf_dir, "events"),
        tenders=rows or tenders(spark, sf_dir),
    )


UPDATED_SQL = f"""{_WITH_UPDATES}
    SELECT t.id, CASE WHEN l.seq IS NULL THEN t.status ELSE l.status END AS status,
      CASE WHEN l.seq IS NULL THEN t.last_status ELSE l.last_status END AS last_status,
      CASE WHEN l.seq IS NULL THEN t.updated_at ELSE {NOW_SQL} END AS updated_at
    FROM tenders t LEFT JOIN latest l USING (tender_id, organization_acronym)"""


@query("status_updates", UPDATED_SQL)
def status_updates(spark, sf_dir):
    updated = writes.apply_status_updates(
        tenders(spark, sf_dir), status_events(spark, sf_dir), NOW, strict=False
    )
    return updated.select("id", "status", "last_status", "updated_at")


@query(
    "rejected_updates",
    f"""{_WITH_UPDATES}
    SELECT seq, status, last_status, CASE WHEN NOT {_SOUND} THEN 'status rule'
      ELSE 'unknown tender' END AS reason
    FROM updates WHERE NOT {_SOUND} OR organization_acronym = 'NONE'""",
)
def rejected_updates(spark, sf_dir):
    rejected = writes.rejected_updates(tenders(spark, sf_dir), status_events(spark, sf_dir))
    return rejected.select("seq", "status", "last_status", "reason")


def _remap(name, change, status, last_status="last_status"):
    sql = f"""{WITH_TENDERS} SELECT id, {status} AS status, {last_status} AS last_status
    FROM tenders"""

    @query(name, sql)
    def run(spark, sf_dir):
        return change(tenders(spark, sf_dir)).select("id", "status", "last_status")


_remap(
    "reopen_indexed",
    writes.reopen_indexed,
    "CASE status WHEN 'INDEXED' THEN 'UPLOADED' ELSE status END",
)
_remap(
    "close_indexed",
    writes.close_indexed,
    """CASE WHEN status IN ('UPLOADED', 'CHUNKING', 'CHUNKED', 'EMBEDDING') THEN 'INDEXED'
      ELSE status END""",
    """CASE WHEN last_status IN ('CHUNKING', 'CHUNKED', 'EMBEDDING') THEN 'UPLOADED'
      ELSE last_status END""",
)


@query(
    "merge_download_statuses",
    f"""{WITH_TENDERS} SELECT id, CASE status WHEN 'CHUNKING' THEN 'DOWNLOADING'
        WHEN 'EMBEDDING' THEN 'DOWNLOADING' ELSE status END AS status,
      CASE last_status WHEN 'EMBEDDING' THEN 'DOWNLOADING' ELSE last_status END AS last_status
    FROM tenders""",
)
def merge_download_statuses(spark, sf_dir):
    """Two current statuses are renamed to the dropped ones first."""
    dropped = {"CHUNKING": "DOWNLOADED", "EMBEDDING": "UPLOADING"}
    old = tenders(spark, sf_dir).replace(dropped, subset=["status", "last_status"])
    return writes.merge_download_statuses(old).select("id", "status", "last_status")


@query(
    "contract_check",
    f"""{WITH_TENDERS}, t AS (SELECT trim(location) AS a, organization_acronym AS b,
        CASE WHEN status = 'CHUNKED' THEN 'DOWNLOADED' ELSE status END AS status, last_status
      FROM tenders),
    flagged AS (SELECT a, b, coalesce(a <> '' AND b <> '', false) AS identified,
        status = 'DOWNLOADED' AS unknown, status <> 'DOWNLOADED' AND NOT {_SOUND} AS broken
      FROM t)
    SELECT (SELECT count(*) FROM flagged) AS row_count,
      (SELECT count(*) FROM (SELECT 1 FROM flagged WHERE identified GROUP BY a, b
        HAVING count(*) > 1)) AS repeated_identities,
      (SELECT count(*) FROM flagged WHERE NOT identified) AS without_identity,
      (SELECT count(*) FROM flagged WHERE unknown) AS unknown_status,
      (SELECT count(*) FROM flagged WHERE broken) AS last_status_rule""",
)
def contract_check(spark, sf_dir):
    """The view with places for ids and a status that no longer exists."""
    rows = tenders(spark, sf_dir).withColumn("tender_id", F.trim("location"))
    return contract.contract_report(rows.replace({"CHUNKED": "DOWNLOADED"}, subset=["status"]))


# Dates as the platform's text, in every form it has, bad ones included.
_TEXTS = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN '31/02/2000'
      WHEN o_orderkey % 11 = 1 THEN 'soon' WHEN o_orderkey % 11 = 2 THEN '  '
      WHEN o_orderkey % 11 = 3 THEN NULL ELSE ' ' || {day} || ' ' END AS published_text,
    CASE o_orderkey % 10 WHEN 0 THEN {day} || ' 11:00' WHEN 1 THEN {day} || '<br>11:00'
      WHEN 2 THEN {day} || '<BR />  09:30' WHEN 3 THEN {day} || '17:45' WHEN 4 THEN {day}
      WHEN 5 THEN {day} || ' 25:00' WHEN 6 THEN '30/02/1999 10:00' WHEN 7 THEN 'to be set'
      WHEN 8 THEN '' END AS deadline_text
  FROM {orders}"""
_TEXTS_SQL = _TEXTS.format(day="strftime(o_orderdate, '%d/%m/%Y')", orders="orders")
# DuckDB: the date sits at fixed places; the times are those above, and the zone is UTC then.
_TYPED_SQL = f"""WITH texts AS ({_TEXTS_SQL}), typed AS (SELECT id, published_text, deadline_text,
      CAST(try_strptime(trim(published_text), '%d/%m/%Y') AS DATE) AS publication_date,
      try_strptime(CASE WHEN deadline_text NOT LIKE '%:%' THEN deadline_text || ' 23:59'
        ELSE substr(deadline_text, 1, 10) || ' ' || right(deadline_text, 5) END,
        '%d/%m/%Y %H:%M') AS deadline FROM texts)"""


def date_texts(spark, sf_dir):
    text = _TEXTS.replace("{day}", "date_format(o_orderdate, 'dd/MM/yyyy')")
    return spark.sql(text, orders=table(spark, sf_dir, "orders"))


@query("text_dates_backfill", f"{_TYPED_SQL} SELECT id, publication_date, deadline FROM typed")
def text_dates_backfill(spark, sf_dir):
    return writes.type_dates(date_texts(spark, sf_dir), "published_text", "deadline_text")


@query(
    "unreadable_dates",
    f"""{_TYPED_SQL} SELECT count(*) AS row_count,
      count(*) FILTER (WHERE trim(published_text) <> '' AND publication_date IS NULL)
        AS publication_dates,
      count(*) FILTER (WHERE trim(deadline_text) <> '' AND deadline IS NULL) AS deadlines
    FROM typed""",
)
def unreadable_dates(spark, sf_dir):
    return writes.unreadable_dates(date_texts(spark, sf_dir), "published_text", "deadline_text")


@query(
    "typed_dates_to_text",
    f"""{WITH_TENDERS} SELECT id, strftime(publication_date, '%d/%m/%Y') AS publication_date,
      strftime({LOCAL_DEADLINE}, '%d/%m/%Y %H:%M') AS deadline FROM tenders""",
)
def typed_dates_to_text(spark, sf_dir):
    return writes.untype_dates(tenders(spark, sf_dir)).select("id", "publication_date", "deadline")


@query(
    "set_dates",
    f"""{WITH_TENDERS}, v AS ({_TYPED_SQL} SELECT id, publication_date, deadline FROM typed
      WHERE deadline_text IS NOT NULL)
    SELECT t.id, CASE WHEN v.id IS NULL THEN t.publication_date ELSE v.publication_date END
        AS publication_date, CASE WHEN v.id IS NULL THEN t.deadline ELSE v.deadline END AS deadline
    FROM tenders t LEFT JOIN v ON v.id = t.id""",
)
def set_dates(spark, sf_dir):
    """Dates of the tenders that have a deadline text, set from it."""
    texts = date_texts(spark, sf_dir).filter("deadline_text IS NOT NULL")
    values = texts.select(
        "id",
        parse_publication_date(F.col("published_text")).alias("publication_date"),
        parse_deadline(F.col("deadline_text")).alias("deadline"),
    )
    changed = writes.set_dates(tenders(spark, sf_dir), values)
    return changed.select("id", "publication_date", "deadline")


# Documents as files of the tender with their number; every line is a chunk.
_FILES = """SELECT doc_id + 1000000 AS id, doc_id AS tender_record_id,
    'texts/doc_' || CAST(doc_id AS {text}) || CASE lang WHEN 'en' THEN '.MD' WHEN 'de' THEN '.pdf'
      WHEN 'fr' THEN '.tar.gz' ELSE '' END AS path,
    CASE lang WHEN 'en' THEN 'md' WHEN 'de' THEN 'pdf' WHEN 'fr' THEN 'gz' ELSE '' END AS file_type,
    CASE source WHEN 'src1' THEN 'skipped' WHEN 'src2' THEN 'failed' ELSE 'chunked' END AS status
  FROM {documents}"""
_LINES = """SELECT d.doc_id + 1000000 AS dce_file_id, CAST(s.chunk_index AS INT) AS chunk_index,
    s.text AS text FROM {documents} AS d {lines} WHERE d.source NOT IN ('src1', 'src2')"""
_WITH_FILES = f"""{WITH_TENDERS},
    dce_files AS ({_FILES.format(text="VARCHAR", documents="documents")}),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS chunk_index FROM documents),
    chunks AS ({_LINES.format(documents="documents",
                              lines="JOIN lines AS s ON s.doc_id = d.doc_id")}),
    doomed AS (SELECT id FROM tenders WHERE publication_date < DATE '1998-01-01')"""


def stored_files(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return spark.sql(_FILES.replace("{text}", "STRING"), documents=documents)


def stored_lines(spark, sf_dir):
    lines = r"LATERAL VIEW posexplode(split(d.text, '\n')) s AS chunk_index, text"
    documents = table(spark, sf_dir, "documents")
    return spark.sql(_LINES.replace("{lines}", lines), documents=documents)


def _cascade(spark, sf_dir):
    rows = tenders(spark, sf_dir)
    doomed = rows.filter("publication_date < DATE '1998-01-01'").select(
        "tender_id", "organization_acronym"
    )
    return writes.cascade_delete(
        rows, stored_files(spark, sf_dir), stored_lines(spark, sf_dir), doomed
    )


@query(
    "cascade_delete_tenders",
    f"{_WITH_FILES} SELECT id FROM tenders WHERE id NOT IN (SELECT id FROM doomed)",
)
def cascade_delete_tenders(spark, sf_dir):
    return _cascade(spark, sf_dir)[0].select("id")


@query(
    "cascade_delete_files",
    f"{_WITH_FILES} SELECT * FROM dce_files WHERE tender_record_id NOT IN (SELECT id FROM doomed)",
)
def cascade_delete_files(spark, sf_dir):
    return _cascade(spark, sf_dir)[1]


@query(
    "cascade_delete_chunks",
    f"""{_WITH_FILES} SELECT * FROM chunks WHERE dce_file_id - 1000000 NOT IN
      (SELECT id FROM doomed)""",
)
def cascade_delete_chunks(spark, sf_dir):
    return _cascade(spark, sf_dir)[2]


@query(
    "stored_rows",
    f"""{_WITH_FILES} SELECT t.tender_id, t.organization_acronym, f.path, f.file_type, f.status,
      c.chunk_index FROM tenders t JOIN dce_files f ON f.tender_record_id = t.id
      LEFT JOIN chunks c ON c.dce_file_id = f.id""",
)
def stored_rows(spark, sf_dir):
    chunks = stored_lines(spark, sf_dir).withColumns(
        {"page_numbers": F.array(F.lit(1)), "heading_path": F.array().cast("array<string>")}
    )
    rows = writes.stored_rows(tenders(spark, sf_dir), stored_files(spark, sf_dir), chunks)
    return rows.drop("page_numbers", "heading_path")


@query(
    "file_report",
    f"""{_WITH_FILES} SELECT status, file_type, count(*) AS file_count FROM dce_files
    GROUP BY ALL""",
)
def file_report_query(spark, sf_dir):
    return file_report(stored_files(spark, sf_dir))
