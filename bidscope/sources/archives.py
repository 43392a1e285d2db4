"""Archives in storage."""

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.functions.paths import SCHEMES, filesystem
from bidscope.session import spread, staged

#: A folder has no length.
ENTRIES = "path string, modificationTime timestamp, length long"
#: Entries handed over at a time.
BATCH_ROWS = 8192


def _scan(spark: SparkSession, folder: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
    return reader.option("recursiveFileLookup", "true").load(folder)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.zip`` under a folder: path, modificationTime and length. No content is read.

    Tasks list the folders, level by level, and write down what they find, so the driver never holds
    the names. A pattern of folders, a single file and storage that tasks cannot open are listed by Spark.
    """
    root = _folder(spark, folder)
    if root is None:
        return _scan(spark, folder).select("path", "modificationTime", "length")
    level, levels = spark.createDataFrame([(root,)], "path string"), []
    while not levels or not level.isEmpty():
        levels.append(staged(level.mapInArrow(_listed, ENTRIES), "archive-names"))
        level = spread(levels[-1].filter("length IS NULL").select("path"))
    return reduce(DataFrame.union, levels).filter("length IS NOT NULL")


def _folder(spark: SparkSession, folder: str) -> str | None:
    """The folder as Spark spells it, if it is one that tasks can list."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    storage = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if any(c in folder for c in "{}[]*?\\") or storage.getUri().getScheme() not in SCHEMES:
        return None
    if not storage.exists(path) or not storage.getFileStatus(path).isDirectory():
        return None
    return storage.makeQualified(path).toString().rstrip("/")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The archives and folders right inside of folders."""
    schema = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())])
    for batch in batches:
        rows = []
        for folder in batch.column(0).to_pylist():
            for name, millis, length in _entries(folder):
                if _hidden(name) or (length is not None and not name.endswith(".zip")):
                    continue
                rows.append((f"{folder}/{name}", millis * 1000, length))
                if len(rows) == BATCH_ROWS:
                    yield _batch(rows, schema)
                    rows = []
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _entries(folder: str) -> Iterator[tuple[str, int, int | None]]:
    """Name, time in milliseconds and length, null for a folder, of what is right inside a folder."""
    if folder.startswith("file:/"):  # one by one, however many they are
        with os.scandir("/" + folder.removeprefix("file:").lstrip("/")) as entries:
            for entry in entries:
                try:
                    found, inside = entry.stat(), entry.is_dir()
                except FileNotFoundError:  # gone meanwhile
                    continue
                yield entry.name, found.st_mtime_ns // 1_000_000, None if inside else found.st_size
        return
    storage, path = filesystem(folder)
    for found in storage.get_file_info(fs.FileSelector(path)):
        inside = found.type == fs.FileType.Directory
        yield found.base_name, (found.mtime_ns or 0) // 1_000_000, None if inside else found.size


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out as well."""
    if name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def load_archive(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The archives of that name with their content; no row when storage has none.

    The name is a property of the file, so no other file is opened.
    """
    return _scan(spark, folder).filter(F.col("_metadata.file_name") == name)
