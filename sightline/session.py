"""Session defaults and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# JSON text keeps whole microseconds only when told so.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def build_session(app: str = "sightline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on. Cluster sizing is left to the launcher."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **REQUIRED,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Settings the results or the handling of skew depend on, whoever made the session. A skewed join is
# split even where the next aggregation then needs a shuffle of its own.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Bring a session made elsewhere to the settings the operators need."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    _broadcast_by_found_size(spark)
    return spark


def _broadcast_by_found_size(spark: SparkSession) -> None:
    """A join is broadcast by the bytes its side was found to have, up to the session's threshold, never by an estimate.

    The estimate is of file bytes and default widths; texts built or lists opened in the plan are many times that, and
    the driver would hold them.
    """
    estimated, found = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    threshold = spark.conf.get(estimated)
    if threshold == "-1":
        return
    if spark.conf.get(found, None) is None:
        spark.conf.set(found, threshold)
    spark.conf.set(estimated, "-1")


def is_local(master: str) -> bool:
    """Driver and executors in one process, so any folder is shared."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster in spark.checkpoint.dir.

    A cluster without the setting is an error. A session in one process takes a temporary folder then.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    made = context._jsc.sc().getCheckpointDir()
    if made.isDefined():
        return made.get()
    if not is_local(context.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sightline-"))
    return context._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; every run takes a new one."""
    return f"{shared_dir(spark).rstrip('/')}/sightline/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and fixes the rows for later branches."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


SMALL_INPUT_BYTES = 64 * 1024 * 1024
SPREAD_BYTES = 1024 * 1024  # of the optimizer's estimate for one task
SPLIT = "4m"  # bytes of a file for one task
OPEN_COST = "128k"  # of these a small file counts at least, so a task takes up to 32 of them


def fine_splits(spark: SparkSession) -> SparkSession:
    """Read tables in small splits: texts built from a row are many times its bytes, and the work of a task is per row.

    By default a split grows with the input up to 128 MB, and so would the longest task. What opening a file counts for
    shrinks with it (by default 4 MB, a whole split): an archive of many small files is not read by a task for each.
    """
    for key, value in (("maxPartitionBytes", SPLIT), ("openCostInBytes", OPEN_COST)):
        if spark.conf.get(f"spark.sql.files.{key}") != value:
            spark.conf.set(f"spark.sql.files.{key}", value)
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for work that is heavy per row when the input is small.

    A small file is one split and would keep one core busy. The size is the optimizer's estimate,
    so nothing runs for it; tasks grow in number with it. Larger inputs have splits enough and are not shuffled.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SMALL_INPUT_BYTES:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES)))


def spread_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` dealt by ``keys``, in as many tasks as ``spread`` makes for a small input, else as the session has it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SMALL_INPUT_BYTES:
        return df.repartition(*keys)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES)), *keys)
