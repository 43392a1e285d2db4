"""Durable tables on plain Parquet: write a version, then commit it with one small row.

A version counts only once its commit row exists, so readers see all of a write or none of it.
What a failed attempt left behind has no commit and is overwritten by the next attempt. One
writer at a time; any number of readers.
"""

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.errors import InvalidRowsError, NotFoundError
from bidscope.functions.dates import instant
from bidscope.operators.chunking import embedding_text
from bidscope.operators.embedding import check_dimension, embed
from bidscope.operators.filters import identified
from bidscope.operators.numbering import dense_ids, totals_before
from bidscope.operators.writes import REFRESHED, dedupe_last, latest_updates, status_rule
from bidscope.schemas import CHUNKS, DAY, DCE_FILES, IDENTITY, INT, LONG, TENDER_FIELDS, TENDERS, TEXT
from bidscope.session import staged
from bidscope.sources.tables import by_month, in_months

_COMMITS = T.StructType(
    [
        *[T.StructField(name, LONG) for name in ("version", "batch", "last_file_id", "last_chunk_id", "last_id", "buckets")],
        T.StructField("stream", TEXT),
        T.StructField("full", T.BooleanType()),
        T.StructField("kinds", T.ArrayType(TEXT)),
    ]
)


class _Versions:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMITS)  # no commit yet

    def _last(self) -> Row:
        found = self._commits().orderBy(F.desc("version")).take(1)
        return found[0] if found else Row(version=0, last_file_id=0, last_chunk_id=0)

    def version(self) -> int:
        """The last committed version; 0 before the first."""
        return self._last().version

    def has_batch(self, batch: int, stream: str) -> bool:
        """Whether a batch of this stream was committed before, so that a replay can be skipped.

        Every stream counts its batches from 0, so a number means nothing without its stream.
        """
        same = (F.col("batch") == batch) & (F.col("stream") == stream)
        return not self._commits().filter(same).isEmpty()

    def _commit(self, **fields) -> None:
        row = self.spark.createDataFrame([tuple(fields.get(name) for name in _COMMITS.names)], _COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")


#: Tenders per bucket of the keys, about.
BUCKET_ROWS = 1 << 16
#: Buckets of a store that began without a whole state.
FIRST_BUCKETS = 16

_REFRESHED = T.StructType(
    [T.StructField("id", LONG), *[TENDERS[name] for name in (*REFRESHED, "updated_at")], T.StructField("month", DAY), T.StructField("version", INT)]
)
_STATUSES = T.StructType(
    [
        *[T.StructField(name, LONG) for name in ("id", "seq")],
        *[TENDERS[name] for name in ("status", "last_status", "updated_at")],
        T.StructField("version", INT),
    ]
)
_DAYS = T.StructType([T.StructField("publication_date", DAY), T.StructField("n", LONG)])
_KEYS = T.StructType(
    [
        *[TENDERS[name] for name in (*IDENTITY, "id")],
        T.StructField("month", DAY),
        *[T.StructField(name, INT) for name in ("version", "bucket")],
    ]
)


class TenderStore(_Versions):
    """The tenders table: a whole state by publication month, and what changed since then.

    ``write`` stores a whole state, with a narrow table of keys beside it: identity, id and month, in
    folders by a hash of the identity. Batches are stored as they come: whole rows of new tenders,
    the refreshed fields of known ones, and statuses with their number. A batch looks up its own
    identities in its own buckets, so it costs what it holds, and no tender is read for it. A read
    lays the newest of each kind over the whole state; ``compact`` makes a whole state again.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = TENDERS) -> None:
        super().__init__(spark, root)
        self.schema = schema

    def _state(self) -> Row:
        """Versions of the last commit, the last whole state and the last change of each kind."""
        full = F.when(F.col("full"), F.col("version"))
        newest = lambda kind: F.max(F.when(F.array_contains("kinds", kind), F.col("version")))
        found = self._commits().agg(
            F.max("version").alias("version"),
            F.max(full).alias("full"),
            F.max_by("last_id", "version").alias("last_id"),
            F.max_by("buckets", full).alias("buckets"),
            *[newest(kind).alias(kind) for kind in ("changes", "refreshed", "statuses")],
        )
        found = found.select(*[F.coalesce(c, F.lit(FIRST_BUCKETS if c == "buckets" else 0)).alias(c) for c in found.columns])
        return found.first()

    def _since(self, state: Row, kind: str, schema: T.StructType) -> DataFrame:
        """What was committed of a kind since the last whole state."""
        if state[kind] <= state.full:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")
        rows = rows.filter((F.col("version") > state.full) & (F.col("version") <= state.version))
        return rows.join(self._versions(kind), "version", "left_semi").select(*schema.names)

    def _versions(self, kind: str) -> DataFrame:
        held = self._commits().filter(F.array_contains("kinds", kind))
        return held.select(F.col("version").cast("int").alias("version"))

    def _full(self, version: int) -> DataFrame:
        dated = T.StructType([*self.schema, T.StructField("month", DAY)])
        if not version:
            return self.spark.createDataFrame([], dated)
        return self.spark.read.schema(dated).parquet(f"{self.root}/full/version={version}")

    def read(self, published: tuple | None = None, undated: bool = False) -> DataFrame:
        """The current state. With ``published`` (first and last day), other months are not read.

        A tender whose date was moved into the period is found in the month where it lies.
        ``undated`` asks for tenders without a date: beside those of ``published``, or alone.
        """
        if undated and published is None:
            return self._read(F.col("month").isNull(), F.col("publication_date").isNull())
        if published is None:
            return self._read(None, None)
        near, inside = in_months(F.col("month"), published), F.col("publication_date").between(*published)
        if undated:
            near, inside = near | F.col("month").isNull(), inside | F.col("publication_date").isNull()
        return self._read(near, inside)

    def _read(self, near: Column | None, inside: Column | None) -> DataFrame:
        """``near`` picks months, and ``inside`` the changed dates that are looked for anywhere."""
        columns, state = self.schema.fieldNames(), self._state()
        refreshed = self._since(state, "refreshed", _REFRESHED)
        rows = self._full(state.full)
        if near is not None:
            if state.refreshed > state.full:
                moved = refreshed.filter(inside).select("month").distinct()
                months = [row.month for row in moved.collect()]  # at most as many as there are months
                near |= F.col("month").isin([m for m in months if m]) | (F.col("month").isNull() & F.lit(None in months))
            rows = rows.filter(near)
        rows = rows.select(*columns, F.lit(state.full).cast("int").alias("_row"))
        if state.changes > state.full:
            versioned = T.StructType([*self.schema, T.StructField("version", INT)])
            newest = self._since(state, "changes", versioned).groupBy("id")
            newest = newest.agg(F.max_by(F.struct(*columns, F.col("version").alias("_row")), "version").alias("row")).select("row.*")
            rows = rows.join(newest.select("id"), "id", "left_anti").select(*columns, "_row").unionByName(newest)
        if state.refreshed > state.full:
            values = F.struct(*[c for c in _REFRESHED.names if c not in ("id", "month")])
            newest = refreshed.groupBy("id").agg(F.max_by(values, "version").alias("_new"))
            rows = rows.join(newest, "id", "left")
        else:
            rows = rows.withColumn("_new", F.lit(None).cast(T.StructType([f for f in _REFRESHED if f.name not in ("id", "month")])))
        if state.statuses > state.full:
            rows = rows.join(self._newest_statuses(state, rows), "id", "left")
        else:
            rows = rows.withColumn("_status", F.lit(None).cast(T.StructType([f for f in _STATUSES if f.name != "id"])))
        return rows.select(*[self._laid_over().get(c, F.col(c)).alias(c) for c in columns])

    def days(self) -> DataFrame:
        """How many tenders (``n``) each publication_date has; null for those without one.

        Stored with a whole state, one row a day. Since then added or refreshed tenders are counted
        by a scan of the dates, until ``compact``.
        """
        state = self._state()
        if not state.full or max(state.changes, state.refreshed) > state.full:
            return self.read().groupBy("publication_date").agg(F.count("*").alias("n"))
        return self.spark.read.schema(_DAYS).parquet(f"{self.root}/days/version={state.full}")

    def _newest_statuses(self, state: Row, rows: DataFrame) -> DataFrame:
        """id and the status that counts: the one of the highest number where numbers are tracked, else the last."""
        statuses = self._since(state, "statuses", _STATUSES)
        if state.changes > state.full:  # a whole row that came later has a status of its own
            whole = rows.filter(F.col("_row") > state.full).select("id", "_row")
            statuses = statuses.join(whole, "id", "left").filter(F.col("version") > F.coalesce("_row", F.lit(0)))
        places = ["seq", "version"] if "status_seq" in self.schema.names else ["version", "seq"]
        order = F.struct(*places, "status", "last_status")
        values = F.struct(*[c for c in _STATUSES.names if c != "id"])
        return statuses.groupBy("id").agg(F.max_by(values, order).alias("_status"))

    def _laid_over(self) -> dict:
        new, status = F.col("_new"), F.col("_status")
        refreshes = F.coalesce(new["version"] > F.col("_row"), F.lit(False))
        counts = status["version"].isNotNull()
        if "status_seq" in self.schema.names:
            counts = counts & (status["seq"] > F.coalesce("status_seq", F.lit(-1)))
        last = refreshes & (~counts | (new["version"] > status["version"]))
        updated = F.when(last, new["updated_at"]).when(counts, status["updated_at"]).otherwise(F.col("updated_at"))
        return {
            **{c: F.when(refreshes, new[c]).otherwise(F.col(c)) for c in REFRESHED},
            **{c: F.when(counts, status[c]).otherwise(F.col(c)) for c in ("status", "last_status")},
            "status_seq": F.when(counts, status["seq"]).otherwise(F.col("status_seq")),
            "updated_at": updated,
        }

    def write(self, tenders: DataFrame, batch: int | None = None, stream: str | None = None) -> int:
        """Commit a whole new state, which may be computed from the current one."""
        version = self.version() + 1
        by_month(tenders.select(*self.schema.fieldNames())).write.mode("overwrite").partitionBy(
            "month"
        ).parquet(f"{self.root}/full/version={version}")
        rows = self._full(version)
        days = rows.groupBy("publication_date").agg(F.count("*").alias("n"), F.max("id").alias("last"))
        days = self._write("days", version, days.coalesce(1))
        known = days.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("last"), F.lit(0)).alias("last")).first()
        buckets = -(-known.n // BUCKET_ROWS) or 1
        self._add_keys(rows, version, version, buckets)
        self._commit(version=version, batch=batch, stream=stream, full=True, last_id=known.last, buckets=buckets, kinds=["keys"])
        return version

    def apply(self, changes: DataFrame, batch: int | None = None, stream: str | None = None) -> int:
        """Commit new rows and changed ones, told by their id. All other rows stay as they are."""
        state = self._state()
        version = state.version + 1
        rows = self._write("changes", version, changes.select(*self.schema.fieldNames()))
        self._add_keys(rows.withColumn("month", F.lit(None).cast("date")), state.full, version, state.buckets)
        last = rows.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        self._commit(
            version=version, batch=batch, stream=stream, full=False, last_id=max(last, state.last_id), kinds=["changes", "keys"]
        )
        return version

    def upsert(
        self,
        found: DataFrame,
        now: datetime,
        order: tuple[str, ...] = ("seq",),
        strict: bool = True,
        batch: int | None = None,
        stream: str | None = None,
    ) -> int:
        """Save a batch of found tenders: the ten fields, and their ``order``; see ``upsert_changes``.

        Only the buckets of the batch's identities are opened, and of them only the keys.
        """
        state, clock = self._state(), instant(now)
        version = state.version + 1
        latest = staged(dedupe_last(found.select(*TENDER_FIELDS.names, *order), order), "upsert-batch")
        incoming, _ = identified(latest, strict)
        met = staged(self._with_keys(incoming, state), "upsert-matched")
        refreshed = met.filter(F.col("id").isNotNull())
        self._write("refreshed", version, refreshed.select("id", *REFRESHED, clock.alias("updated_at"), "month"))
        new = dense_ids(met.filter(F.col("id").isNull()).drop("id", "month"), ["first_seen", *IDENTITY], F.lit(state.last_id))
        filled = {"status": F.lit("DISCOVERED"), "created_at": clock, "updated_at": clock}
        missing = {f.name: F.lit(None).cast(f.dataType) for f in self.schema if f.name not in new.columns}
        rows = new.select(*[filled.get(c, missing.get(c, F.col(c))).alias(c) for c in self.schema.names])
        rows = self._write("changes", version, rows)
        self._add_keys(rows.withColumn("month", F.lit(None).cast("date")), state.full, version, state.buckets)
        self._commit(
            version=version,
            batch=batch,
            stream=stream,
            full=False,
            last_id=state.last_id + rows.count(),
            kinds=["changes", "refreshed", "keys"],
        )
        return version

    def update_status(
        self, updates: DataFrame, now: datetime, strict: bool = True, batch: int | None = None, stream: str | None = None
    ) -> int:
        """Save status updates. Strict refuses all of them if any breaks the rule or names no tender.

        Otherwise those are left out. With ``status_seq`` in the schema the update with the highest
        number counts, whenever it came; else the last one that came.
        """
        state = self._state()
        version = state.version + 1
        if strict and not updates.filter(~status_rule()).isEmpty():
            raise InvalidRowsError("some updates break the status rule")
        latest = staged(latest_updates(updates).select(*IDENTITY, "seq", "new.status", "new.last_status"), "status-batch")
        met = self._with_keys(latest, state)
        if strict and not met.filter(F.col("id").isNull()).isEmpty():
            raise InvalidRowsError("some updates name an unknown tender")
        rows = met.filter(F.col("id").isNotNull()).withColumn("updated_at", instant(now))
        self._write("statuses", version, rows.select(*[c for c in _STATUSES.names if c != "version"]))
        self._commit(version=version, batch=batch, stream=stream, full=False, last_id=state.last_id, kinds=["statuses"])
        return version

    def compact(self) -> int:
        return self.write(self.read())

    def _write(self, kind: str, version: int, rows: DataFrame) -> DataFrame:
        path = f"{self.root}/{kind}/version={version}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _add_keys(self, rows: DataFrame, full: int, version: int, buckets: int) -> None:
        keys = rows.select(*IDENTITY, "id", "month", _bucket(buckets)).repartition("bucket")
        keys.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/keys/full={full}/version={version}")

    def _with_keys(self, rows: DataFrame, state: Row) -> DataFrame:
        """Rows with the id of their tender and its month in the whole state; null where it is new.

        ``rows`` is read twice: once for its buckets.
        """
        if not max(state.full, state.changes):
            return rows.withColumns({"id": F.lit(None).cast("long"), "month": F.lit(None).cast("date")})
        touched = [row.bucket for row in rows.select(_bucket(state.buckets)).distinct().collect()]  # at most all
        keys = self.spark.read.schema(_KEYS).parquet(f"{self.root}/keys/full={state.full}")
        keys = keys.filter((F.col("version") <= state.version) & F.col("bucket").isin(touched))
        keys = keys.join(self._versions("keys"), "version", "left_semi")
        if state.changes > state.full:  # a tender may have been stored again since
            keys = keys.groupBy(*IDENTITY, "id").agg(F.max_by("month", "version").alias("month"))
        return rows.join(keys.select(*IDENTITY, "id", "month"), IDENTITY, "left")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*IDENTITY), F.lit(buckets)).cast("int").alias("bucket")


_REPLACED = T.StructType(
    [
        T.StructField("tender_record_id", LONG),
        T.StructField("error", TEXT),
        T.StructField("version", INT),
    ]
)
_FILE_ROWS = T.StructType([*DCE_FILES, T.StructField("version", INT)])
_CHUNK_ROWS = T.StructType(
    [
        *CHUNKS,
        T.StructField("tender_record_id", LONG),
        T.StructField("error", TEXT),
        T.StructField("version", INT),
    ]
)


class FileStore(_Versions):
    """Files and chunks of tenders, replaced per tender.

    A replacement appends the new rows under a new version, plus one ``replaced`` row for each
    tender. Rows of an older version of the same tender no longer count, so a write costs what
    its batch costs, whatever the table holds, and an empty new set needs no rows at all.

    With a ``dimension``, only models whose vectors have that size are accepted.
    """

    def __init__(self, spark: SparkSession, root: str, dimension: int | None = None) -> None:
        super().__init__(spark, root)
        self.dimension = dimension

    def accept(self, embedder) -> None:
        """An error unless the model's vectors have the size of the stored ones."""
        if self.dimension is not None:
            check_dimension(embedder, self.dimension)

    def _rows(self, name: str, schema: T.StructType, upto: int) -> DataFrame:
        if upto == 0:
            return self.spark.createDataFrame([], schema)
        # ``version`` is the folder's name: the filter picks folders, not rows.
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return rows.filter(F.col("version") <= upto)

    def _live(self, name: str, schema: T.StructType) -> DataFrame:
        upto = self.version()
        # A tender written once, without error, has no stale rows and needs no join.
        changed = (
            self._rows("replaced", _REPLACED, upto)
            .groupBy(F.col("tender_record_id").alias("owner"))
            .agg(
                F.max(F.when(F.col("error").isNull(), F.col("version"))).alias("latest"),
                F.count("*").alias("times"),
            )
            .filter("times > 1 OR latest IS NULL")
        )
        stale = (F.col("tender_record_id") == F.col("owner")) & (
            F.col("version") != F.coalesce("latest", F.lit(-1))
        )
        return self._rows(name, schema, upto).join(changed, stale, "left_anti")

    def files(self) -> DataFrame:
        return self._live("files", _FILE_ROWS).select(*DCE_FILES.fieldNames())

    def chunks(self) -> DataFrame:
        """Chunks, with ``tender_record_id`` beside the table's own columns.

        A filter on it reaches the scan, where the order of the rows lets it skip row groups.
        """
        return self._live("chunks", _CHUNK_ROWS).select(*CHUNKS.fieldNames(), "tender_record_id")

    def replace(
        self,
        tender_ids: DataFrame,
        files: DataFrame,
        embedder,
        strict: bool = True,
        tenders: DataFrame | None = None,
    ) -> DataFrame:
        """Replace everything stored for the given tenders (column ``tender_record_id``).

        ``files`` has tender_record_id, position (from 0), path, file_type, status, reason and
        ``chunks``, an array of struct(chunk_index, text, embedding_text, page_numbers,
        heading_path). Without an embedding_text, headings and text are embedded. It is read several
        times: pass a staged frame if it is costly, ``without_repeats``. A file of
        another tender, one without tender or position, or a second one in the same position is an
        error. Where ``tenders`` is given, so is a tender it does not hold.

        Strict: one chunk without a sound vector, and nothing changes for any tender. Otherwise
        only its tender keeps what it had. Returns the tenders with the error of each, if any.
        """
        self.accept(embedder)
        _refuse(tender_ids, files, tenders)
        last = self._last()
        version = last.version + 1
        numbered = _numbered(files, last.last_file_id, last.last_chunk_id)
        created = F.current_timestamp().alias("created_at")
        file_rows = numbered.select(*[created if c == "created_at" else c for c in DCE_FILES.fieldNames()])
        self._write("files", version, file_rows)
        self._write("chunks", version, _chunk_rows(files, numbered, embedder).withColumn("created_at", created))

        written = self._rows("chunks", _CHUNK_ROWS, version).filter(F.col("version") == version)
        errors = written.groupBy("tender_record_id").agg(F.min("error").alias("error"))
        self._write("replaced", version, tender_ids.select("tender_record_id").distinct().join(errors, "tender_record_id", "left"))
        replaced = self._rows("replaced", _REPLACED, version).filter(F.col("version") == version)
        if strict and not replaced.filter(F.col("error").isNotNull()).isEmpty():
            raise InvalidRowsError("some chunks have no sound vector; nothing was replaced")
        counted = numbered.agg(F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("chunks")).first()
        self._commit(
            version=version,
            last_file_id=last.last_file_id + counted.files,
            last_chunk_id=last.last_chunk_id + counted.chunks,
        )
        return replaced.select("tender_record_id", "error")

    def _write(self, name: str, version: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/version={version}")


def _refuse(tender_ids: DataFrame, files: DataFrame, tenders: DataFrame | None) -> None:
    """Errors before anything is written."""
    named = tender_ids.select("tender_record_id").distinct().withColumn("_named", F.lit(True))
    if tenders is not None:
        known = tenders.select(F.col("id").alias("tender_record_id"))
        if not named.join(known, "tender_record_id", "left_anti").isEmpty():
            raise NotFoundError("some tenders are not stored")
    counts = files.groupBy("tender_record_id", "position").agg(F.count("*").alias("_n"))
    wrong = F.col("_named").isNull() | F.col("position").isNull() | (F.col("_n") > 1)
    if not counts.join(named, "tender_record_id", "left").filter(wrong).isEmpty():
        raise InvalidRowsError("a file needs a named tender and a position of its own")


def without_repeats(files: DataFrame) -> DataFrame:
    """Files whose chunks leave out an ``embedding_text`` that their headings and text give anyway."""

    def kept(chunk: Column) -> Column:
        same = chunk["embedding_text"] == embedding_text(chunk["heading_path"], chunk["text"])
        return chunk.withField("embedding_text", F.when(~F.coalesce(same, F.lit(False)), chunk["embedding_text"]))

    return files.withColumn("chunks", F.transform("chunks", kept))


_PLACE = ["tender_record_id", "position"]


def _numbered(files: DataFrame, last_file: int, last_chunk: int) -> DataFrame:
    """Files without their chunks: the number ``n`` of these, the file's id, and the id its first chunk starts from."""
    sizes = files.select(*[c for c in files.columns if c != "chunks"], F.size("chunks").cast("bigint").alias("n"))
    numbers = totals_before(sizes, _PLACE, chunks_before=F.col("n"))
    return numbers.select(
        *sizes.columns,
        (F.col("rows_before") + 1 + last_file).alias("id"),
        (F.col("chunks_before") + 1 + last_chunk).alias("first_chunk_id"),
    )


def _chunk_rows(files: DataFrame, numbered: DataFrame, embedder) -> DataFrame:
    """Chunks in order, with their ids.

    The numbers of a file travel as a row before its chunks, so that text moves once: the ranges
    that put chunks in order also bring them to their numbers.
    """
    pieces = files.select(*_PLACE, F.explode("chunks").alias("chunk")).select(*_PLACE, F.lit(True).alias("_piece"), "chunk.*")
    numbers = numbered.select(*_PLACE, F.lit(False).alias("_piece"), F.col("id").alias("dce_file_id"), "first_chunk_id")
    # Ordered before the vectors exist, so that the sort moves text only.
    # As finely as ``spread`` deals out rows: few large ranges would leave tasks idle at the model.
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.unionByName(numbers, allowMissingColumns=True).repartitionByRange(parts, *_PLACE)
    ordered = ordered.sortWithinPartitions(*_PLACE, "_piece", "chunk_index")
    before = W.partitionBy(*_PLACE).orderBy("_piece", "chunk_index").rowsBetween(W.unboundedPreceding, W.currentRow)
    ordered = ordered.withColumns({name: F.first(name).over(before) for name in ("dce_file_id", "first_chunk_id")})
    ordered = ordered.filter("_piece").select(
        "tender_record_id",
        "dce_file_id",
        (F.col("first_chunk_id") + F.col("chunk_index")).alias("id"),
        "chunk_index",
        "text",
        F.coalesce("embedding_text", embedding_text(F.col("heading_path"), F.col("text"))).alias("embedding_text"),
        "page_numbers",
        "heading_path",
    )
    embedded = embed(ordered, "embedding_text", embedder).drop("embedding_text")
    size = F.size("embedding")
    wrong = F.when(size != embedder.dimension, F.concat(F.lit("vector of size "), size.cast("string")))
    return embedded.withColumn("error", F.coalesce("error", wrong))
