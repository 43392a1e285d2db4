"""Session settings, and the shared folder for checkpoints and staged tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes up to which a side of a join is broadcast by its estimate alone. Estimates are made of compressed files and
#: of shares of their columns: ids of a table that also has texts and nulls weigh many times what is estimated, and
#: all of it passes the driver.
ESTIMATED_BYTES = 256 * 1024
#: The same for a side that a shuffle has measured.
MEASURED_BYTES = 10 * 1024 * 1024

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Texts and archive bytes travel through Arrow: bound a batch by bytes, not only by rows. A Python
    # worker holds a few copies of a batch, as objects too.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    "spark.ui.enabled": "false",
}
BROADCASTS = {
    "spark.sql.autoBroadcastJoinThreshold": str(ESTIMATED_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(MEASURED_BYTES),
}


def build_session(app_name: str = "bidscope", master: str | None = None, **conf) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | BROADCASTS).items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the library's run-time settings on a session built elsewhere.

    Local-date rules need a UTC session. What that session allows to be broadcast holds for measured
    sizes; for estimated ones it is only ever lowered.
    """
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    estimated, measured = BROADCASTS
    allowed = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if allowed > ESTIMATED_BYTES:
        if spark.conf.get(measured, None) is None:
            spark.conf.set(measured, str(allowed))
        spark.conf.set(estimated, str(ESTIMATED_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, a folder in Spark's warehouse.

    A warehouse on the driver's own disk serves a local session only: executors elsewhere would
    not see what lies there, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    path = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    return _shared(f"{warehouse}/_staged".rstrip("/"), scheme, spark.sparkContext.master)


def _shared(folder: str, scheme: str, master: str) -> str:
    if scheme == "file" and master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def run_folder(spark: SparkSession) -> str:
    """Where this application stages its tables."""
    return f"{shared_dir(spark)}/bidscope/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new folder name in the run folder, never used before."""
    return f"{run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete everything this application has staged, once its results are no longer read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a frame that is read more than once and costly to recompute: the copy survives the loss
    of an executor, which a cached block does not.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out evenly, for costly work per row on files of few large row groups.

    The session's number of shuffle partitions says how finely, as for every other shuffle.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
