"""Status updates arriving as files."""

from pyspark.sql import functions as F

from bidscope.catalog.base import NOW, query, tenders
from bidscope.catalog.writes import UPDATED_SQL, status_events
from bidscope.schemas import STATUS_UPDATES
from bidscope.session import scratch_path, staged
from bidscope.sources.store import TenderStore
from bidscope.streaming.status import TRACKED_TENDERS, stream_status


@query("stream_status", UPDATED_SQL)
def stream_status_query(spark, sf_dir):
    """All events, in files that arrive in no particular order, a few at a time."""
    work = scratch_path(spark, "status-stream")
    events = status_events(spark, sf_dir).select(*STATUS_UPDATES.fieldNames())
    events.repartition(4, F.xxhash64("seq")).write.parquet(f"{work}/updates")
    store = TenderStore(spark, f"{work}/tenders", TRACKED_TENDERS)
    untouched = tenders(spark, sf_dir).withColumn("status_seq", F.lit(None).cast("bigint"))
    store.write(untouched.select(*TRACKED_TENDERS.fieldNames()))
    stream_status(
        spark, f"{work}/updates", store, f"{work}/checkpoint", lambda: NOW, files_per_batch=2
    ).awaitTermination()
    return store.read().select("id", "status", "last_status", "updated_at")


@query("stream_status_twice", UPDATED_SQL)
def stream_status_twice(spark, sf_dir):
    """Two streams with checkpoints of their own on one store, and the first one started again."""
    work = scratch_path(spark, "status-streams")
    rows = staged(tenders(spark, sf_dir), "tender-view")
    events = staged(status_events(spark, sf_dir, rows).select(*STATUS_UPDATES.fieldNames()), "status-events")
    store = TenderStore(spark, f"{work}/tenders", TRACKED_TENDERS)
    untouched = rows.withColumn("status_seq", F.lit(None).cast("bigint"))
    store.write(untouched.select(*TRACKED_TENDERS.fieldNames()))
    for half in (0, 1):
        own = events.filter(F.pmod("seq", F.lit(2)) == half)
        own.repartition(2, F.xxhash64("seq")).write.parquet(f"{work}/updates-{half}")
    for half in (0, 1, 0):
        stream_status(
            spark, f"{work}/updates-{half}", store, f"{work}/checkpoint-{half}", lambda: NOW, files_per_batch=1
        ).awaitTermination()
    store.compact()
    return store.read().select("id", "status", "last_status", "updated_at")
