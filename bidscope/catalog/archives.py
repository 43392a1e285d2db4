"""Archive queries: Spark packs the supplied documents into archives, then takes them apart."""

import io
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.catalog.base import (
    HAS_ARCHIVE_SQL,
    NOW,
    ORACLES,
    READY_SQL,
    WITH_TENDERS,
    query,
    spread_table,
    table,
    tenders,
)
from bidscope.catalog.texts import DIMENSION
from bidscope.functions.paths import filesystem
from bidscope.functions.text import archive_name
from bidscope.operators.archives import (
    TextConverter,
    attach_archives,
    chunk_files,
    expand_archives,
    missing_archives,
)
from bidscope.operators.embedding import HashEmbedder
from bidscope.operators.filters import has_archive
from bidscope.plans.indexing import run_indexing
from bidscope.schemas import TENDERS
from bidscope.session import scratch_path, staged
from bidscope.sources.archives import archive_files
from bidscope.sources.store import FileStore, TenderStore


def _packed(members: dict[str, bytes]) -> bytes:
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0)), content)
    return target.getvalue()


@F.arrow_udf(T.BinaryType())
def _archive(texts: pa.Array, sources: pa.Array) -> pa.Array:
    """A text, the same in a nested archive, a drawing and a broken nested archive."""
    made = []
    for text, source in zip(texts.to_pylist(), sources.to_pylist()):
        body = text.encode()
        if source == "src3":  # not an archive at all
            made.append(body)
            continue
        inner = _packed({"parts/notes.txt": b"# Rules\n" + body})
        members = {"papers/": b"", "papers/terms.md": body, "extra.ZIP": inner, "sketch.dwg": b"\x00\x01"}
        if source == "src7":
            members["bad.zip"] = b"not a zip"
        made.append(_packed(members))
    return pa.array(made, pa.binary())


def archives(spark, sf_dir, rows=None):
    """One archive per document, named after the tender with the document's number.

    ``rows`` is the tender view where it was computed before.
    """
    owners = (rows or tenders(spark, sf_dir)).select("id", "tender_id", "organization_acronym")
    documents = spread_table(spark, sf_dir, "documents")
    name = archive_name(F.col("tender_id"), F.col("organization_acronym"))
    return documents.join(owners, documents.doc_id == owners.id).select(
        "doc_id",
        F.concat(F.lit("store/"), name).alias("path"),
        _archive("text", "source").alias("content"),
    )


_MEMBERS = """members AS (SELECT * FROM (VALUES (0, 'papers/terms.md', 'md', ''),
      (1, 'extra.ZIP/parts/notes.txt', 'txt', '# Rules' || chr(10)), (2, 'sketch.dwg', 'dwg', NULL),
      (3, 'bad.zip', 'zip', NULL)) AS m(position, path, file_type, prefix))"""
_FILES = f"""{_MEMBERS}, files AS (
      SELECT doc_id, CAST(position AS BIGINT) AS position, path, file_type, prefix, text, source
      FROM documents, members WHERE source <> 'src3' AND (position < 3 OR source = 'src7'))"""


@query(
    "zip_expand",
    f"""WITH {_FILES}
    SELECT doc_id, position, path, file_type, position = 3 AS failed,
      CASE position WHEN 2 THEN 2 WHEN 3 THEN NULL ELSE strlen(prefix || text) END AS n_bytes,
      CASE WHEN prefix IS NOT NULL THEN md5(prefix || text) END AS digest FROM files
    UNION ALL
    SELECT doc_id, NULL, NULL, NULL, true, NULL, NULL FROM documents WHERE source = 'src3'""",
)
def zip_expand(spark, sf_dir):
    return _measured(expand_archives(archives(spark, sf_dir), "doc_id"))


def _measured(files):
    return files.select(
        "doc_id",
        "position",
        "path",
        "file_type",
        F.col("error").isNotNull().alias("failed"),
        F.octet_length("content").alias("n_bytes"),
        F.when(F.col("file_type").isin("md", "txt"), F.md5("content")).alias("digest"),
    )


#: Folders that archives are written to, by a hash of their name.
FOLDERS = 256


def _written(folder: str):
    """Writes each archive as a file under its name; a task run again writes the same bytes."""

    def write(batches):
        storage, path = filesystem(folder)
        storage.create_dir(path)
        made = set()
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                name = name.rsplit("/", 1)[-1]
                home = f"{path}/{zlib.crc32(name.encode()) % FOLDERS:02x}"
                if home not in made:
                    storage.create_dir(home)
                    made.add(home)
                with storage.open_output_stream(f"{home}/{name}") as out:
                    out.write(content.as_buffer())
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["path"])

    return write


@query("zip_expand_files", ORACLES["zip_expand"])
def zip_expand_files(spark, sf_dir):
    """The same archives as files in storage, found by name and opened by the tasks that read them."""
    folder = scratch_path(spark, "archive-files")
    made = archives(spark, sf_dir).select("path", "content").mapInArrow(_written(folder), "path string")
    staged(made, "archives-written")
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    owners = tenders(spark, sf_dir).join(documents, "id").select("id", "tender_id", "organization_acronym")
    attached = attach_archives(owners, archive_files(spark, folder)).withColumnRenamed("id", "doc_id")
    return _measured(expand_archives(attached, "doc_id"))


_WORD_COUNT = r"len(list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda w: w <> ''))"


@query(
    "file_outcomes",
    f"""WITH {_FILES}
    SELECT doc_id, position, path, CASE position WHEN 2 THEN 'skipped' WHEN 3 THEN 'failed'
        ELSE 'chunked' END AS status, position >= 2 AS has_reason,
      CASE WHEN position < 2 THEN CAST(ceil({_WORD_COUNT} / 512.0) AS BIGINT) ELSE 0 END
        AS n_chunks, CASE WHEN position = 1 THEN 'Rules' END AS heading
    FROM files
    UNION ALL
    SELECT doc_id, NULL, NULL, NULL, true, 0, NULL FROM documents WHERE source = 'src3'""",
)
def file_outcomes(spark, sf_dir):
    converted = expand_archives(archives(spark, sf_dir), "doc_id", TextConverter())
    return chunk_files(converted).select(
        "doc_id",
        "position",
        "path",
        "status",
        F.col("reason").isNotNull().alias("has_reason"),
        F.size("chunks").alias("n_chunks"),
        F.get(F.get("chunks", F.lit(0))["heading_path"], F.lit(0)).alias("heading"),
    )


@query(
    "missing_archives",
    f"""{WITH_TENDERS} SELECT id, tender_id || '_' || organization_acronym || '.zip' AS archive_name
    FROM tenders WHERE {HAS_ARCHIVE_SQL} AND id NOT IN (SELECT doc_id FROM documents)""",
)
def missing_archives_query(spark, sf_dir):
    """Tenders that should have an archive while storage has none."""
    expected = tenders(spark, sf_dir).filter(has_archive())
    return missing_archives(expected, archives(spark, sf_dir)).select("id", "archive_name")


def indexed(spark, sf_dir, rounds=1):
    """The stores after indexing every tender that is ready, and what the last run reported."""
    tender_store = TenderStore(spark, scratch_path(spark, "tenders"))
    rows = staged(tenders(spark, sf_dir), "tender-view")
    tender_store.write(rows.select(*TENDERS.fieldNames()))
    file_store = FileStore(spark, scratch_path(spark, "files"))
    stored = staged(archives(spark, sf_dir, rows).select("path", "content"), "archives")
    for _ in range(rounds):
        report = run_indexing(
            tender_store, file_store, stored, TextConverter(), HashEmbedder(DIMENSION), NOW
        )
    return tender_store, file_store, report


_INDEXED = f"""{WITH_TENDERS}, {_FILES}, ready AS (SELECT id FROM tenders WHERE {READY_SQL}),
    good AS (SELECT id FROM ready JOIN documents ON doc_id = id WHERE source <> 'src3')"""


@query(
    "index_run",
    f"""{_INDEXED}, counts AS (SELECT doc_id AS id, count(*) AS n_files, CAST(sum(CASE WHEN
        position < 2 THEN ceil({_WORD_COUNT} / 512.0) ELSE 0 END) AS BIGINT) AS n_chunks
      FROM files GROUP BY 1)
    SELECT t.id, CASE WHEN r.id IS NULL THEN t.status WHEN g.id IS NULL THEN 'FAILED'
        ELSE 'INDEXED' END AS status, CASE WHEN r.id IS NULL THEN t.last_status WHEN g.id IS NULL
        THEN 'UPLOADED' END AS last_status, CASE WHEN g.id IS NOT NULL THEN n_files ELSE 0 END
        AS n_files, CASE WHEN g.id IS NOT NULL THEN n_chunks ELSE 0 END AS n_chunks
    FROM tenders t LEFT JOIN ready r USING (id) LEFT JOIN good g USING (id)
      LEFT JOIN counts USING (id)""",
)
def index_run(spark, sf_dir):
    """Every tender after one run, with the files and chunks stored for it."""
    tender_store, file_store, _ = indexed(spark, sf_dir)
    files = file_store.files().groupBy(F.col("tender_record_id").alias("id")).agg(
        F.count("*").alias("n_files")
    )
    chunks = file_store.chunks().groupBy(F.col("tender_record_id").alias("id")).agg(
        F.count("*").alias("n_chunks")
    )
    counted = tender_store.read().join(files, "id", "left").join(chunks, "id", "left")
    return counted.select(
        "id",
        "status",
        "last_status",
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
    )


@query(
    "index_run_files",
    f"""{_INDEXED} SELECT doc_id AS tender_record_id, path, file_type, CASE position
        WHEN 2 THEN 'skipped' WHEN 3 THEN 'failed' ELSE 'chunked' END AS status
    FROM files WHERE doc_id IN (SELECT id FROM good)""",
)
def index_run_files(spark, sf_dir):
    """Files stored after two runs: the second one only retries what failed."""
    _, file_store, _ = indexed(spark, sf_dir, rounds=2)
    return file_store.files().select("tender_record_id", "path", "file_type", "status")
