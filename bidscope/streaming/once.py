"""Streams whose batches are committed once, whatever is replayed."""

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from bidscope.sources.store import TenderStore


def each_batch_once(
    rows: DataFrame, store: TenderStore, checkpoint: str, save: Callable[[DataFrame, int, str], object]
) -> StreamingQuery:
    """Call ``save`` with every batch that the store does not hold yet, then stop.

    A batch is told by its number and its stream. The stream's id is kept with its checkpoint: it
    survives a restart, and a new checkpoint is another stream.
    """
    started, stream = threading.Event(), []

    def handle(batch: DataFrame, number: int) -> None:
        started.wait()
        if not store.has_batch(number, stream[0]):
            save(batch, number, stream[0])

    query = (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.append(str(query.id))
    started.set()
    return query
