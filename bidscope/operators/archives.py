"""Archives to files, and files to text, one outcome per file."""

import io
import re
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.paths import open_stored
from bidscope.functions.text import archive_name, file_type
from bidscope.operators.chunking import MAX_TOKENS, chunk_sections
from bidscope.schemas import IDENTITY

#: Output is handed over whenever this many bytes of files have gathered.
FLUSH_BYTES = 16 * 1024 * 1024
#: A larger file of an archive is reported rather than read: a row cannot hold it. Nested archives
#: of any size are read; above this one they are streams, taken apart where they lie.
MEMBER_BYTES = 1 << 30
#: Members of an archive are dealt to tasks in pieces of about this many bytes, and at most so many.
PIECE_BYTES = 16 * 1024 * 1024
PIECE_MEMBERS = 256

# Types read as text unless the caller names others.
TEXT_TYPES = ("txt", "md", "text", "csv")


class UnsupportedFileError(Exception):
    """The type of a file is not one the converter reads."""


#: A section: its headings, outermost first, and its pieces of text with their page.
Section = dict
#: Turns the path and bytes of one file into sections; raises if it cannot.
Converter = Callable[[str, bytes], list[Section]]


class TextConverter:
    """Reads text files: ``#`` lines are headings, form feeds are page breaks."""

    def __init__(self, types: tuple[str, ...] = TEXT_TYPES) -> None:
        self.types = frozenset(types)

    def __call__(self, path: str, content: bytes) -> list[Section]:
        name = path.rsplit("/", 1)[-1]
        kind = name.rsplit(".", 1)[-1].lower() if "." in name[1:] else ""
        if kind not in self.types:
            raise UnsupportedFileError(f"{kind or 'these'} files are not supported")
        sections: list[Section] = [{"headings": [], "pieces": []}]
        for page, page_text in enumerate(content.decode("utf-8").split("\f"), start=1):
            for line in page_text.split("\n"):
                heading = re.match(r"(#{1,6})\s+(\S.*)", line)
                if heading:
                    above = sections[-1]["headings"][: len(heading[1]) - 1]
                    sections.append({"headings": [*above, heading[2].strip()], "pieces": []})
                else:
                    sections[-1]["pieces"].append({"page": page, "text": line})
        return sections


_SECTIONS = pa.list_(
    pa.struct(
        [
            ("headings", pa.list_(pa.string())),
            ("pieces", pa.list_(pa.struct([("page", pa.int32()), ("text", pa.string())]))),
        ]
    )
)
_SECTIONS_SQL = "array<struct<headings:array<string>,pieces:array<struct<page:int,text:string>>>>"


def attach_archives(tenders: DataFrame, archives: DataFrame) -> DataFrame:
    """Tenders with the path of their archive, null where storage has none of that name.

    ``archives`` has a ``path`` and, where archives are not files that tasks can open, their
    ``content``; the content then comes along. The join knows names only: no archive is opened
    for it. Of several objects of one name the one with the least path counts.
    """
    named = _named(tenders).join(_stored(archives), "archive_name", "left")
    if "content" not in archives.columns:
        return named
    wanted = named.filter(F.col("path").isNotNull())
    with_content = wanted.join(archives.select("path", "content"), "path")
    missing = named.filter(F.col("path").isNull()).withColumn("content", F.lit(None).cast("binary"))
    return with_content.unionByName(missing)


def missing_archives(tenders: DataFrame, archives: DataFrame) -> DataFrame:
    """Tenders whose archive is not in storage; reads names only, never contents."""
    return _named(tenders).join(_stored(archives), "archive_name", "left_anti")


def _named(tenders: DataFrame) -> DataFrame:
    return tenders.withColumn("archive_name", archive_name(*[F.col(c) for c in IDENTITY]))


def _stored(archives: DataFrame) -> DataFrame:
    names = archives.select(F.element_at(F.split("path", "/"), -1).alias("archive_name"), "path")
    return names.groupBy("archive_name").agg(F.min("path").alias("path"))


def expand_archives(
    archives: DataFrame,
    key: str,
    convert: Converter | None = None,
    member_bytes: int = MEMBER_BYTES,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Every file of every archive, nested archives included, in archive order.

    Takes ``key`` (bigint) and either ``content`` or the ``path`` of an archive in storage. An
    archive with a path never passes the JVM, and may be larger than memory: one task reads its
    directory, and pieces of its members are dealt to all tasks, which open the archive at their
    place. Returns key, position, path, file_type, error and either the file's ``content`` or, with
    a converter, its ``sections`` and ``supported``: the bytes then never leave the Python worker.
    An archive that cannot be opened gives one row without a position. A file that cannot be read,
    or is larger than ``member_bytes``, has an error and stops nothing else.
    """
    body = [("content", pa.binary())]
    body_sql = "content binary"
    if convert is not None:
        body = [("supported", pa.bool_()), ("sections", _SECTIONS)]
        body_sql = f"supported boolean, sections {_SECTIONS_SQL}"
    schema = pa.schema(
        [("key", pa.int64()), ("position", pa.int32()), ("path", pa.string()), ("error", pa.string()), *body]
    )

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for key_value, files in _pieces_read(batches, member_bytes):
            for row in files:
                size += len(row.get("content") or b"")
                rows.append({"key": key_value, **_converted(row, convert)})
                if size >= FLUSH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    if "content" in archives.columns:
        pieces = archives.select(F.col(key).cast("bigint").alias("key"), "content")
    else:
        pieces = archive_pieces(archives, key, member_bytes, piece_bytes)
        parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pieces = pieces.repartition(parts, "path", "first").sortWithinPartitions("path", "first")
    files = pieces.mapInArrow(expand, f"key bigint, position int, path string, error string, {body_sql}")
    rest = ["content"] if convert is None else ["supported", "sections"]
    return files.select(
        F.col("key").alias(key), "position", "path", file_type(F.col("path")).alias("file_type"), "error", *rest
    )


PIECES = "key bigint, path string, first int, last int, position int, error string"


def archive_pieces(
    archives: DataFrame, key: str, member_bytes: int = MEMBER_BYTES, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Pieces of the archives at ``path``: key, path, first and last member, and the first one's position.

    Directories are read, and nested archives to count their files, but no other content. An archive
    that cannot be opened is one piece with an error.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for key_value, path in zip(*_columns(batch)) for row in _cut(key_value, path, member_bytes, piece_bytes)]
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            names = [field.split()[0] for field in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return archives.select(F.col(key).cast("bigint").alias("key"), "path").mapInArrow(pieces, PIECES)


def _columns(batch: pa.RecordBatch) -> list[list]:
    return [column.to_pylist() for column in batch.columns]


def _cut(key, path: str | None, member_bytes: int, piece_bytes: int) -> Iterator[tuple]:
    if path is None:
        yield key, None, 0, 0, None, "archive not found"
        return
    try:
        archive = zipfile.ZipFile(open_stored(path))
    except Exception as error:
        yield key, path, 0, 0, None, f"{type(error).__name__}: {error}"
        return
    with archive:
        members = archive.infolist()
        first = position = size = count = 0
        for number, member in enumerate(members):
            if number > first and (size + member.file_size > piece_bytes or number - first >= PIECE_MEMBERS):
                yield key, path, first, number, position, None
                first, position, size, count = number, position + count, 0, 0
            size += member.file_size
            count += _count(archive, member, member_bytes)
        if count:
            yield key, path, first, len(members), position, None


def _is_archive(path: str) -> bool:
    return re.search(r"[^/]\.zip$", path, re.IGNORECASE) is not None


def _nested(archive: zipfile.ZipFile, member: zipfile.ZipInfo, member_bytes: int) -> zipfile.ZipFile:
    """An archive within one: in memory, or as a stream if it is large."""
    if member.file_size <= member_bytes:
        return zipfile.ZipFile(io.BytesIO(archive.read(member)))
    return zipfile.ZipFile(archive.open(member))


def _count(archive: zipfile.ZipFile, member: zipfile.ZipInfo, member_bytes: int) -> int:
    """How many rows a member gives: those of its files if it is an archive that can be opened."""
    if member.is_dir():
        return 0
    if not _is_archive(member.filename):
        return 1
    try:
        with _nested(archive, member, member_bytes) as nested:
            return sum(_count(nested, inner, member_bytes) for inner in nested.infolist())
    except Exception:
        return 1


def _pieces_read(batches: Iterator[pa.RecordBatch], member_bytes: int) -> Iterator[tuple]:
    """(key, rows of files) of each whole archive or piece of one. An open archive serves pieces in a row."""
    last, archive = None, None
    for batch in batches:
        if batch.schema.names == ["key", "content"]:
            for key_value, content in zip(batch.column(0), batch.column(1)):
                yield key_value.as_py(), _files(content.as_py(), member_bytes)
            continue
        for key_value, path, first, end, position, error in zip(*_columns(batch)):
            if error is not None:
                yield key_value, [{"error": error}]
                continue
            if path != last:
                archive, last = zipfile.ZipFile(open_stored(path)), path
            yield key_value, _members(archive, archive.infolist()[first:end], position, member_bytes)


def _files(content: bytes | None, member_bytes: int) -> Iterator[dict]:
    """The files of an archive given as bytes, in order, as rows without their key."""
    if content is None:
        yield {"error": "archive not found"}
        return
    try:
        top = zipfile.ZipFile(io.BytesIO(content))
    except Exception as error:
        yield {"error": f"{type(error).__name__}: {error}"}
        return
    yield from _members(top, top.infolist(), 0, member_bytes)


def _members(archive: zipfile.ZipFile, members: list, position: int, member_bytes: int) -> Iterator[dict]:
    """The files of some members of an archive, in order, numbered from ``position``."""
    # Depth first, without recursion: the innermost open archive is last.
    open_archives = [("", archive, iter(members))]
    while open_archives:
        prefix, archive, rest = open_archives[-1]
        member = next(rest, None)
        if member is None:
            open_archives.pop()
            continue
        if member.is_dir():
            continue
        row = {"position": position, "path": prefix + member.filename}
        try:
            if _is_archive(row["path"]):
                nested = _nested(archive, member, member_bytes)
                open_archives.append((row["path"] + "/", nested, iter(nested.infolist())))
                continue
            if member.file_size > member_bytes:
                raise ValueError(f"{member.file_size} bytes are more than a file may have")
            row["content"] = archive.read(member)
        except Exception as error:
            row["error"] = f"unreadable member: {type(error).__name__}: {error}"
        position += 1
        yield row


def _converted(row: dict, convert: Converter | None) -> dict:
    if convert is None or row.get("content") is None:
        return row
    content = row.pop("content")
    try:
        return {**row, "supported": True, "sections": convert(row["path"], content)}
    except UnsupportedFileError as error:
        return {**row, "supported": False, "error": str(error)}
    except Exception as error:
        return {**row, "supported": True, "error": f"{type(error).__name__}: {error}"}


def chunk_files(converted: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Outcome and chunks of every converted file: chunked, skipped or failed, with the reason.

    The row of an archive that could not be opened keeps its null position and gets no status.
    """
    outcome = (
        F.when(F.col("position").isNull(), F.lit(None))
        .when(~F.col("supported"), "skipped")
        .when(F.col("error").isNotNull(), "failed")
        .otherwise("chunked")
    )
    none = F.array().cast(
        "array<struct<chunk_index:int,text:string,embedding_text:string,"
        "page_numbers:array<int>,heading_path:array<string>>>"
    )
    return converted.select(
        *[c for c in converted.columns if c not in ("supported", "error", "sections")],
        outcome.alias("status"),
        F.col("error").alias("reason"),
        F.coalesce(chunk_sections(F.col("sections"), max_tokens), none).alias("chunks"),
    )
