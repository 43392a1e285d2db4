"""Upserts, status changes, replacement and deletion, as frames of the new table state.

Each function returns the whole new state; ``bidscope.sources.store`` makes it durable.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.errors import InvalidRowsError
from bidscope.functions.dates import (
    format_date,
    format_deadline,
    instant,
    parse_deadline,
    parse_publication_date,
    unreadable,
)
from bidscope.operators.filters import identified
from bidscope.operators.numbering import dense_ids
from bidscope.schemas import IDENTITY, STATUSES, TENDER_FIELDS
from bidscope.session import staged

FIELDS = TENDER_FIELDS.fieldNames()
#: Columns a repeated tender overwrites; every other column keeps its first value.
REFRESHED = ["tender_object", "public_buyer", "publication_date"]


def dedupe_last(tenders: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """One row per identity: the values of its last occurrence, and ``first_seen`` of its first.

    An aggregate rather than a window: repeats of one tender collapse before the shuffle. Of
    occurrences in the same place the one with the greatest values is the last; null places come
    before all others.
    """
    others = [name for name in tenders.columns if name not in (*IDENTITY, *order)]
    place = F.struct(*order)
    decided = F.struct(*order, *others)
    return (
        tenders.groupBy(*IDENTITY)
        .agg(F.max_by(F.struct(*others), decided).alias("last"), F.min(place).alias("first_seen"))
        .select(*IDENTITY, "last.*", "first_seen")
    )


def upsert_changes(
    tenders: DataFrame,
    batch: DataFrame,
    now: datetime,
    order: tuple[str, ...] = ("seq",),
    strict: bool = True,
) -> DataFrame:
    """The rows that saving ``batch`` changes or adds: the ten tender fields, and their ``order``.

    A known tender takes a new object, buyer and publication date and nothing else; a new one is
    DISCOVERED and numbered after the highest id, in order of first appearance, then of identity.
    The order columns may be of any type; null comes first. The table is scanned once for the
    tenders of the batch, and once for its ids.
    """
    incoming, clock = _latest(batch, order, strict), instant(now)
    fresh = incoming.select(*IDENTITY, *[F.col(c).alias(f"new_{c}") for c in REFRESHED])
    new = {c: F.col(f"new_{c}") for c in REFRESHED} | {"updated_at": clock}
    known = staged(
        tenders.join(fresh, IDENTITY).select(*[new.get(c, F.col(c)).alias(c) for c in tenders.columns]),
        "upsert-known",
    )
    added = _added(tenders, incoming.join(known.select(*IDENTITY), IDENTITY, "left_anti"), clock)
    return known.unionByName(added, allowMissingColumns=True)


def _latest(batch: DataFrame, order: tuple[str, ...], strict: bool) -> DataFrame:
    """The batch's tenders, one row each, written once since they are joined twice."""
    latest = staged(dedupe_last(batch.select(*FIELDS, *order), order), "upsert-batch")
    return identified(latest, strict)[0]


def _added(tenders: DataFrame, unknown: DataFrame, clock: Column) -> DataFrame:
    """New tenders as rows of the table, numbered after its highest id."""
    highest = F.coalesce(tenders.agg(F.max("id")).scalar(), F.lit(0))
    return dense_ids(unknown, ["first_seen", *IDENTITY], highest).select(
        *FIELDS,
        "id",
        F.lit("DISCOVERED").alias("status"),
        clock.alias("created_at"),
        clock.alias("updated_at"),
    )


def upsert(
    tenders: DataFrame,
    batch: DataFrame,
    now: datetime,
    order: tuple[str, ...] = ("seq",),
    strict: bool = True,
) -> DataFrame:
    """The whole table after saving ``batch``; see ``upsert_changes``.

    Known rows take their new values in one join; only the batch itself is ever written down.
    """
    incoming, clock = _latest(batch, order, strict), instant(now)
    fresh = incoming.select(*IDENTITY, F.lit(True).alias("_met"), *[F.col(c).alias(f"new_{c}") for c in REFRESHED])
    new = {c: F.col(f"new_{c}") for c in REFRESHED} | {"updated_at": clock}
    new = {c: F.when(F.col("_met"), value).otherwise(F.col(c)) for c, value in new.items()}
    kept = tenders.join(fresh, IDENTITY, "left").select(*[new.get(c, F.col(c)).alias(c) for c in tenders.columns])
    unknown = incoming.join(tenders.select(*IDENTITY), IDENTITY, "left_anti")
    return kept.unionByName(_added(tenders, unknown, clock), allowMissingColumns=True)


def with_changes(tenders: DataFrame, changes: DataFrame) -> DataFrame:
    """The table with some rows, told by their id, in place of its own or added."""
    kept = tenders.join(changes.select("id"), "id", "left_anti").select(*tenders.columns)
    return kept.unionByName(changes, allowMissingColumns=True)


def status_rule() -> Column:
    """FAILED needs a last status other than FAILED; every other status must come without one."""
    status, last = F.col("status"), F.col("last_status")
    failed = status == "FAILED"
    sound = F.when(failed, last.isin(*STATUSES) & (last != "FAILED")).otherwise(
        status.isin(*STATUSES) & last.isNull()
    )
    return F.coalesce(sound, F.lit(False))


def rejected_updates(tenders: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates that break the status rule or name an unknown tender, with the reason."""
    broken = updates.filter(~status_rule()).withColumn("reason", F.lit("status rule"))
    unknown = (
        updates.filter(status_rule())
        .join(tenders.select(*IDENTITY), IDENTITY, "left_anti")
        .withColumn("reason", F.lit("unknown tender"))
    )
    return broken.unionByName(unknown)


def latest_updates(updates: DataFrame) -> DataFrame:
    """The last sound update of each tender, by ``seq``; at a tie, the greatest status."""
    return (
        updates.filter(status_rule())
        .groupBy(*IDENTITY)
        .agg(
            F.max_by(F.struct("status", "last_status"), F.struct("seq", "status", "last_status")).alias("new"),
            F.max("seq").alias("seq"),
        )
    )


def status_changes(
    tenders: DataFrame, updates: DataFrame, now: datetime, strict: bool = True
) -> DataFrame:
    """The rows that the updates change. Strict refuses all of them if any would be rejected.

    Where the table has ``status_seq``, the number of the last update applied, an update that
    comes late changes nothing.
    """
    if strict and not rejected_updates(tenders, updates).isEmpty():
        raise InvalidRowsError("some updates break the status rule or name an unknown tender")
    met = tenders.join(latest_updates(updates).withColumnRenamed("seq", "new_seq"), IDENTITY)
    new = {
        "status": F.col("new.status"),
        # A status other than FAILED clears the last status.
        "last_status": F.col("new.last_status"),
        "updated_at": instant(now),
    }
    if "status_seq" in tenders.columns:
        met = met.filter(F.col("new_seq") > F.coalesce("status_seq", F.lit(-1)))
        new["status_seq"] = F.col("new_seq")
    return met.select(*[new.get(c, F.col(c)).alias(c) for c in tenders.columns])


def apply_status_updates(
    tenders: DataFrame, updates: DataFrame, now: datetime, strict: bool = True
) -> DataFrame:
    """The whole table after the updates; see ``status_changes``."""
    return with_changes(tenders, staged(status_changes(tenders, updates, now, strict), "status-changes"))


def _remap(tenders: DataFrame, **rules: list[tuple[tuple[str, ...], str]]) -> DataFrame:
    for name, pairs in rules.items():
        value = F.col(name)
        for old, new in pairs:
            value = F.when(F.col(name).isin(*old), new).otherwise(value)
        tenders = tenders.withColumn(name, value)
    return tenders


def reopen_indexed(tenders: DataFrame) -> DataFrame:
    """Tenders indexed before chunks were stored go back to UPLOADED."""
    return _remap(tenders, status=[(("INDEXED",), "UPLOADED")])


def close_indexed(tenders: DataFrame) -> DataFrame:
    """The reverse: what reached UPLOADED or an indexing step was INDEXED right after upload."""
    steps = ("CHUNKING", "CHUNKED", "EMBEDDING")
    return _remap(
        tenders,
        status=[(("UPLOADED", *steps), "INDEXED")],
        last_status=[(steps, "UPLOADED")],
    )


def merge_download_statuses(tenders: DataFrame) -> DataFrame:
    """Two dropped statuses become DOWNLOADING, in both status columns."""
    rule = [(("DOWNLOADED", "UPLOADING"), "DOWNLOADING")]
    return _remap(tenders, status=rule, last_status=rule)


def type_dates(tenders: DataFrame, published: str, deadline: str) -> DataFrame:
    """Replace two text columns by typed ``publication_date`` and ``deadline``."""
    return tenders.select(
        *[c for c in tenders.columns if c not in (published, deadline)],
        parse_publication_date(F.col(published)).alias("publication_date"),
        parse_deadline(F.col(deadline)).alias("deadline"),
    )


def unreadable_dates(tenders: DataFrame, published: str, deadline: str) -> DataFrame:
    """One row: how many texts became null in each column, out of how many rows."""
    dates, deadlines = F.col(published), F.col(deadline)
    return tenders.agg(
        F.count("*").alias("row_count"),
        F.count_if(unreadable(dates, parse_publication_date(dates))).alias("publication_dates"),
        F.count_if(unreadable(deadlines, parse_deadline(deadlines))).alias("deadlines"),
    )


def untype_dates(tenders: DataFrame) -> DataFrame:
    """The reverse: both dates as the platform's text."""
    return tenders.select(
        *[c for c in tenders.columns if c not in ("publication_date", "deadline")],
        format_date(F.col("publication_date")).alias("publication_date"),
        format_deadline(F.col("deadline")).alias("deadline"),
    )


def set_dates(tenders: DataFrame, values: DataFrame) -> DataFrame:
    """Set both dates of the tenders listed in ``values`` (id, publication_date, deadline)."""
    new = values.select(
        "id",
        F.lit(True).alias("listed"),
        F.col("publication_date").alias("new_publication_date"),
        F.col("deadline").alias("new_deadline"),
    )
    chosen = {
        c: F.when(F.col("listed"), F.col(f"new_{c}")).otherwise(F.col(c))
        for c in ("publication_date", "deadline")
    }
    return tenders.join(new, "id", "left").select(
        *[chosen.get(c, F.col(c)).alias(c) for c in tenders.columns]
    )


def cascade_delete(
    tenders: DataFrame, dce_files: DataFrame, chunks: DataFrame, identities: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables without the listed tenders, their files and their chunks."""
    doomed = tenders.join(identities, IDENTITY, "left_semi").select("id")
    doomed_files = _files_of(dce_files, doomed)
    return (
        tenders.join(doomed, "id", "left_anti"),
        dce_files.join(_as_owner(doomed), "tender_record_id", "left_anti"),
        chunks.join(doomed_files, "dce_file_id", "left_anti"),
    )


def remove_files(
    dce_files: DataFrame, chunks: DataFrame, tender_ids: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Files and chunks without those of the given tenders (column ``tender_record_id``)."""
    owners = tender_ids.select(F.col("tender_record_id").alias("id"))
    return (
        dce_files.join(_as_owner(owners), "tender_record_id", "left_anti"),
        chunks.join(_files_of(dce_files, owners), "dce_file_id", "left_anti"),
    )


def _as_owner(ids: DataFrame) -> DataFrame:
    return ids.select(F.col("id").alias("tender_record_id"))


def _files_of(dce_files: DataFrame, ids: DataFrame) -> DataFrame:
    owned = dce_files.join(_as_owner(ids), "tender_record_id", "left_semi")
    return owned.select(F.col("id").alias("dce_file_id"))


def stored_rows(tenders: DataFrame, dce_files: DataFrame, chunks: DataFrame) -> DataFrame:
    """Audit of what is stored: one row per chunk, and one per file without chunks."""
    owners = tenders.select(*IDENTITY, F.col("id").alias("tender_record_id"))
    files = dce_files.select(
        "tender_record_id", "path", "file_type", "status", F.col("id").alias("dce_file_id")
    )
    pieces = chunks.select("dce_file_id", "chunk_index", "page_numbers", "heading_path")
    return (
        files.join(owners, "tender_record_id")
        .join(pieces, "dce_file_id", "left")
        .select(
            *IDENTITY, "path", "file_type", "status", "chunk_index", "page_numbers", "heading_path"
        )
    )
