"""Latest row per key and deduplication, all by map-side combinable aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FIXED_WIDTH = (*WHOLE, T.BooleanType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)

# An id of 64 bits, or none, takes one of 2^64 + 1 places. Below 10^38 that leaves 2.7 * 10^18 microseconds either way,
# some 85,000 years; a null time comes before all of them.
_PLACES = 2**65
_NO_TIME = -2_700_000_000_000_000_000


def packed_order(df: DataFrame, order: list[str]) -> Column | None:
    """(time, id) as one number that sorts as the pair does, nulls first; None where the types do not allow it.

    Spark keeps a number of fixed width in the buffer of a hash aggregate, whereas a struct as order, or a
    value of variable width, makes it sort all rows before and after the shuffle.
    """
    if len(order) != 2:
        return None
    first, second = (df.schema[c].dataType for c in order)
    if not isinstance(second, WHOLE):
        return None
    if isinstance(first, T.TimestampType):
        micros = F.unix_micros(order[0])
    elif isinstance(first, T.DateType):
        micros = F.unix_date(order[0]).cast("long")
    elif isinstance(first, WHOLE[:3]):
        micros = F.col(order[0]).cast("long")
    else:
        return None
    time = F.coalesce(micros, F.lit(_NO_TIME)).cast("decimal(19,0)") * F.lit(str(_PLACES)).cast("decimal(20,0)")
    place = F.coalesce(F.col(order[1]).cast("decimal(20,0)") + F.lit(str(2**63 + 1)).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (time + place).cast("decimal(38,0)")


def _extreme_per_key(df: DataFrame, keys: list[str], order: list[str], columns: list[str] | None, pick) -> DataFrame:
    keep = columns or [c for c in df.columns if c not in keys]
    packed = packed_order(df, order) if all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in keep) else None
    if packed is None:
        picked = pick(F.struct(*keep), F.struct(*order)).alias("_row")
        return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_row")[c].alias(c) for c in keep])
    # All columns see the same rows in the same order, so that rows equal in (time, id) give one of them as a whole.
    rows = df.select(*keys, F.struct(*keep).alias("_row"), packed.alias("_order"))
    return rows.groupBy(*keys).agg(*[pick(F.col("_row")[c], F.col("_order")).alias(c) for c in keep]).select(*keys, *keep)


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str] | None = None
) -> DataFrame:
    """The row with the greatest ``order`` per key. A hot key is reduced before the shuffle.

    An order of (time, id) with ``columns`` of fixed width runs as a hash aggregate, anything else as a sort aggregate.
    """
    return _extreme_per_key(df, keys, order, columns, F.max_by)


def earliest_per_key(
    df: DataFrame, keys: list[str], order: list[str], columns: list[str] | None = None
) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    return _extreme_per_key(df, keys, order, columns, F.min_by)


def latest_value(df: DataFrame, value: str, order: list[str]) -> Column:
    """``value`` of the row with the greatest ``order``, as an aggregate; hashed where type and order allow it."""
    packed = packed_order(df, order) if isinstance(df.schema[value].dataType, FIXED_WIDTH) else None
    return F.max_by(value, F.struct(*order) if packed is None else packed)


def dedupe_last_wins(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """One row per key, the last to arrive. Unlike dropDuplicates the survivor is defined."""
    return latest_per_key(df, keys, arrival).select(*df.columns)


def superseded(
    df: DataFrame, keys: list[str], order: list[str], row_id: str
) -> DataFrame:
    """Rows for which a newer row of the same key exists.

    The newest id per key is an aggregate; the anti join is on the unique row id, so a hot
    key is spread over all tasks. Null keys form one group of their own.
    """
    newest = df.groupBy(*keys).agg(latest_value(df, row_id, order).alias("_newest"))
    return df.join(newest.select(F.col("_newest").alias(row_id)), row_id, "left_anti")
