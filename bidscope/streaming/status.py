"""Continuous status updates: the latest sound update of each tender wins, in any arrival order."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bidscope.schemas import LONG, STATUS_UPDATES, TENDERS
from bidscope.sources.store import TenderStore
from bidscope.streaming.once import each_batch_once

#: Tenders with the number of the last update applied to each.
TRACKED_TENDERS = T.StructType([*TENDERS, T.StructField("status_seq", LONG)])


def stream_status(
    spark: SparkSession,
    folder: str,
    store: TenderStore,
    checkpoint: str,
    clock: Callable[[], datetime],
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Apply every update file not seen yet to a store of tracked tenders, then stop.

    Updates that break the status rule or name no tender are left out. A batch reads its own rows
    and the keys of its own tenders; which update of a tender counts is decided by number when the
    store is read, so batches may come in any order and cut.
    """
    updates = (
        spark.readStream.schema(STATUS_UPDATES)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )

    def save(batch: DataFrame, number: int, stream: str) -> None:
        store.update_status(batch, clock(), strict=False, batch=number, stream=stream)

    return each_batch_once(updates, store, checkpoint, save)
