"""WARC archives with an index written first, and reads of selected records by byte ranges.

Each writing task appends compressed records to an archive of its own in the shared folder and
returns their index rows: archive, offset, length, URL, digest. The index is a table; it names
only archives of tasks that ended well, so a lost executor leaves at most files nobody reads.

A read takes rows of the index, sorts them by archive and offset, and fetches neighbouring
records with one request when the gap between them is small.
"""

import base64
import hashlib
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.paths import filesystem
from bidscope.llm.registry import query, table
from bidscope.session import scratch_path, staged

#: An archive is closed and the next one begun beyond this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Two ranges become one request when no more than this many bytes lie between them.
GAP_BYTES = 64 << 10
#: Longest request, unless a single record is longer.
REQUEST_BYTES = 8 << 20
DATE = "2000-01-01T00:00:00Z"

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, url string, archive string, offset long, length long, payload_digest string, record_type string"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, payload binary"
)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page_id(record_id: str):
    value = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def record(page_id, url, refers_to, is_revisit: bool, payload: bytes, payload_digest: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, which states the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if is_revisit else payload)
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # Blanks, controls and per cent signs could end or change a header line.
        lines.insert(3, "WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]~"))
    if is_revisit:
        lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of RECORDS from one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": _page_id(fields["WARC-Record-ID"]),
        "url": unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "record_type": fields["WARC-Type"],
        "refers_to": _page_id(fields["WARC-Refers-To"]) if revisit else None,
        "payload_bytes": int(length.split(": ")[1]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": None if revisit else payload,
    }


def revisits(pages: DataFrame) -> DataFrame:
    """page_id and keeper (the page it revisits) of all pages whose payload a larger id also has.

    Works on digests alone: payloads do not cross a shuffle, and equal ones meet as counts.
    """
    digests = pages.filter(F.col("page_id").isNotNull()).select(
        "page_id", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha1")
    )
    keepers = digests.groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("_least"))
    keepers = keepers.filter(F.col("_least") < F.col("keeper")).drop("_least")
    return digests.join(keepers, "sha1").filter(F.col("page_id") < F.col("keeper"))


def _write(folder: str):
    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        storage, path = filesystem(folder)
        storage.create_dir(path)
        name, n, out, at = f"{context.partitionId():06d}-{context.taskAttemptId()}", 0, None, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, keeper in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()
                ):
                    payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                    if out is None or at > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                            n += 1
                        archive = f"{name}-{n}.warc.gz"
                        out, at = storage.open_output_stream(f"{path}/{archive}", compression=None), 0
                    found = digest(payload)
                    revisit = keeper is not None
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # 31: a gzip member of its own
                    data = packer.compress(record(page_id, url, keeper, revisit, payload, found)) + packer.flush()
                    out.write(data)
                    rows.append((page_id, url, archive, at, len(data), found, "revisit" if revisit else "response"))
                    at += len(data)
                columns = list(zip(*rows)) if rows else [()] * 7
                types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(columns, types)], names=_names(INDEX)
                )
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the stored index.

    Of pages with equal payloads the one with the largest id is a response, and the others are
    revisits that refer to it. A null or empty html is an empty payload. Rows of one id are written
    each; those of the largest id are all responses. A page without an id is a response. Other
    columns are ignored. An empty table gives an empty index.
    """
    sha1 = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    later = revisits(pages).select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "keeper").distinct()
    keyed = pages.select("page_id", "url", "html", sha1.alias("sha1"))
    same = (F.col("page_id") == F.col("_id")) & (F.col("sha1") == F.col("_sha1"))
    marked = keyed.join(later, same, "left").select("page_id", "url", "html", "keeper")
    return staged(marked.mapInArrow(_write(folder), INDEX), "warc-index")


def coalesce_ranges(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = REQUEST_BYTES) -> list[list[int]]:
    """Groups of numbers of sorted (offset, length) ranges, each to be read at once."""
    groups, end = [], 0
    for k, (offset, length) in enumerate(ranges):
        if groups and offset - end <= gap and offset + length - ranges[groups[-1][0]][0] <= most:
            groups[-1].append(k)
        else:
            groups.append([k])
        end = max(end, offset + length) if groups[-1][0] != k else offset + length
    return groups


def _read(folder: str):
    def run(batches):
        storage, path = filesystem(folder)
        opened, name = None, None
        for batch in batches:
            archives, offsets, lengths = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            begin = 0
            while begin < len(archives):
                end = begin
                while end < len(archives) and archives[end] == archives[begin]:
                    end += 1
                if archives[begin] != name:
                    if opened is not None:
                        opened.close()
                    name = archives[begin]
                    opened = storage.open_input_file(f"{path}/{name}")
                ranges = list(zip(offsets[begin:end], lengths[begin:end]))
                for group in coalesce_ranges(ranges):
                    first = ranges[group[0]][0]
                    data = opened.read_at(max(ranges[k][0] + ranges[k][1] for k in group) - first, first)
                    rows = [
                        parse(zlib.decompress(data[ranges[k][0] - first : ranges[k][0] - first + ranges[k][1]], 31))
                        for k in group
                    ]
                    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[c] for r in rows], type=t) for c, t in zip(_names(RECORDS), types)],
                        names=_names(RECORDS),
                    )
                begin = end
        if opened is not None:
            opened.close()

    return run


def read_records(selected: DataFrame, folder: str) -> DataFrame:
    """The records that rows of the index point to; a row selected twice is read twice.

    Revisits have no payload here; its length and digest are in the record. Tasks read about as
    many bytes as the session lets a scan's tasks read (spark.sql.files.maxPartitionBytes).
    """
    conf = selected.sparkSession._jsparkSession.sessionState().conf()
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = -(-total // conf.filesMaxPartitionBytes()) or 1
    rows = selected.select("archive", "offset", "length")
    ordered = rows.repartitionByRange(tasks, "archive", "offset")
    return ordered.sortWithinPartitions("archive", "offset").mapInArrow(_read(folder), RECORDS)


@query("op6_warc")
def warc(spark, sf_dir):
    folder = scratch_path(spark, "warc")
    index = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
