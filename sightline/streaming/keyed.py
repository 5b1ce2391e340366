"""Keyed state kept by Spark's state store: a micro-batch costs what its keys cost, however many old keys there are.

State that is a fold lives in a streaming aggregation. Spark combines the rows of a key before the shuffle, so a hot key
reaches the store as one row for each task. State that is a history holds each row under a key of its own,
so a hot key spreads over the store, and a late row touches nothing but itself. The store is RocksDB with a log of changes, so
a checkpoint writes the touched keys. Current tables are read from the store itself; there is no change log to compact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.operators import history
from sightline.session import cut_lineage

_STORE = "spark.sql.streaming.stateStore."
SETTINGS = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
}


def advance(result: DataFrame, checkpoint: str) -> None:
    """Bring the state of a streaming ``result`` up to all that is there, then stop."""
    for key, value in SETTINGS.items():
        result.sparkSession.conf.set(key, value)
    query = (
        result.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _has_state(spark: SparkSession, checkpoint: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/0")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def folded(result: DataFrame, checkpoint: str) -> DataFrame:
    """The current rows of an aggregation, read from its state; nothing before the first batch.

    Every aggregate must be one that keeps a single value as its buffer and result: min, max or count.
    """
    spark = result.sparkSession
    if not _has_state(spark, checkpoint):
        return spark.createDataFrame([], result.schema)
    state = spark.read.format("statestore").option("path", checkpoint).load()
    # The store names a value by its function, so that several have one name: they are told apart by their place.
    n = len(state.schema["key"].dataType.fields)
    kinds = {c: T.StructType(result.schema.fields[a:b]) for c, a, b in (("key", 0, n), ("value", n, None))}
    return state.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()]).select("key.*", "value.*")


def change_points(stream: DataFrame, key: str, at: str, tie: list[str], value: str, checkpoint: str) -> DataFrame:
    """Sightings whose value is the first of its key or differs from the one before, in order of (``at``, ``tie``).

    Whatever the order of delivery, the result is that of all sightings at once: ``key``, ``at``, the columns of ``tie``, ``value`` and
    change_reason. ``tie`` columns are integers. The state holds each sighting under a key of its own, so a micro-batch writes the
    sightings it brings; which of them are points is found when they are read.
    """
    advance_points(stream, key, at, tie, value, checkpoint)
    points = read_points(stream.sparkSession, key, at, tie, value, checkpoint)
    return points.withColumn(key, F.col(key).cast(stream.schema[key].dataType))


def advance_points(stream: DataFrame, key: str, at: str, tie: list[str], value: str, checkpoint: str) -> None:
    """Take the sightings of ``stream`` into the state that ``read_points`` reads."""
    rows = stream.select(
        F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp_ntz").alias("at"),
        *[F.col(t).cast("long").alias(f"tie{i}") for i, t in enumerate(tie)], F.col(value).alias("value"),
    )
    advance(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), checkpoint)


def read_points(spark: SparkSession, key: str, at: str, tie: list[str], value: str, checkpoint: str) -> DataFrame:
    """The points as the state at ``checkpoint`` has them, keys as text; at least one micro-batch must have run."""
    state = spark.read.format("statestore").option("path", checkpoint).load().select("key.*", "value.*")
    ties = [f"tie{i}" for i in range(len(tie))]
    # Read more than once below, and a read of the store opens it whole.
    held = cut_lineage(state.toDF("key", "at", *ties, "value", "n"))
    # Sightings alike in all columns are one row of the state; each without a value is a point, of the others the first may be one.
    alike = F.when(F.col("value").isNull(), F.col("n")).otherwise(1)
    sightings = held.select("key", "at", *ties, "value", F.explode(F.sequence(F.lit(1).cast("long"), alike)).alias("n")).drop("n")
    found = history.change_points(sightings, ["key"], ["at", *ties], "value")
    names = [F.col("at").alias(at), *[F.col(c).alias(t) for c, t in zip(ties, tie)], F.col("value").alias(value), "change_reason"]
    return found.select(F.col("key").alias(key), *names)


def newest(columns: list, order: list[str], when: Column | None = None) -> Column:
    """The last ``columns`` by ``order`` as one comparable struct; a fold that Spark combines before the shuffle."""
    row = F.struct(*order, *columns)
    return F.max(row if when is None else F.when(when, row))
