"""Positions in a total order, without a task that holds all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import cut_lineage


def with_position(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """``df`` with the place (from 0) of each row in ``order``, rows with equal keys in any order among them.

    Rows are dealt to ranges and sorted there; the ranges are fixed by a checkpoint before they are
    counted, and only one number for each range is summed up in order. Keys should end in a unique
    column, so that no range has to hold very many equal keys.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    fixed = cut_lineage(ranged)
    part = F.shiftright("_at", 33)
    sizes = fixed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    placed = fixed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_start")
