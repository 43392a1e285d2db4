"""Continuous discovery: new page files become stored tenders."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bidscope.plans.discovery import discover
from bidscope.schemas import RESULT_PAGES
from bidscope.sources.store import TenderStore
from bidscope.streaming.once import each_batch_once


def stream_discovery(
    spark: SparkSession,
    folder: str,
    store: TenderStore,
    checkpoint: str,
    clock: Callable[[], datetime],
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Take in every page file not seen yet, then stop. A replayed batch is not saved twice.

    Pages without rows or identity are left out rather than stopping the stream.
    """
    pages = (
        spark.readStream.schema(RESULT_PAGES)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )

    def save(batch: DataFrame, number: int, stream: str) -> None:
        discover(batch, store, clock(), strict=False, batch=number, stream=stream)

    return each_batch_once(pages, store, checkpoint, save)
