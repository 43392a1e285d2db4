"""Archives of tenders to stored, searchable chunks."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.operators.archives import Converter, attach_archives, chunk_files, expand_archives
from bidscope.operators.chunking import MAX_TOKENS
from bidscope.operators.embedding import Embedder
from bidscope.operators.lookup import find_for_indexing
from bidscope.schemas import IDENTITY
from bidscope.session import staged
from bidscope.sources.store import FileStore, TenderStore, without_repeats


def file_outcomes(
    batch: DataFrame, archives: DataFrame, convert: Converter, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """Every file of the batch's archives with its outcome and chunks.

    An archive that is missing or cannot be opened gives one row without a position.
    """
    opened = expand_archives(attach_archives(batch, archives), "id", convert)
    return chunk_files(opened, max_tokens).withColumnRenamed("id", "tender_record_id")


def run_indexing(
    tenders: TenderStore,
    files: FileStore,
    archives: DataFrame,
    convert: Converter,
    embedder: Embedder,
    now: datetime,
    limit: int | None = None,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """Index the tenders that are ready, oldest first, and return the new status of each.

    A tender whose archive fails is FAILED after UPLOADED, one whose chunks cannot be embedded
    FAILED after CHUNKED and keeps what was stored; the others go on. Archives that belong to no
    tender of the batch are not opened. A model whose vectors do not fit the store is an error. A run that is cut short
    leaves every status as it was, so the next run starts again with the same tenders.
    """
    files.accept(embedder)
    current = tenders.read()
    batch = staged(find_for_indexing(current, limit).select("id", *IDENTITY), "index-batch")
    outcomes = staged(without_repeats(file_outcomes(batch, archives, convert, max_tokens)), "file-outcomes")
    broken = outcomes.filter(F.col("position").isNull()).select("tender_record_id")
    chunked = batch.select(F.col("id").alias("tender_record_id")).join(
        broken, "tender_record_id", "left_anti"
    )
    stored = files.replace(
        chunked, outcomes.filter(F.col("position").isNotNull()), embedder, strict=False, tenders=current
    )
    updates = staged(_updates(batch, stored), "status-updates")
    tenders.update_status(updates, now, strict=False)
    return updates.drop("seq")


def _updates(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """INDEXED where chunks were stored, else FAILED after the last step that succeeded."""
    done = stored.select(F.col("tender_record_id").alias("id"), F.lit(True).alias("chunked"), "error")
    indexed = F.col("chunked").isNotNull() & F.col("error").isNull()
    return batch.join(done, "id", "left").select(
        F.lit(0).cast("bigint").alias("seq"),
        *IDENTITY,
        F.when(indexed, "INDEXED").otherwise("FAILED").alias("status"),
        F.when(indexed, F.lit(None))
        .when(F.col("chunked").isNotNull(), "CHUNKED")
        .otherwise("UPLOADED")
        .alias("last_status"),
    )
