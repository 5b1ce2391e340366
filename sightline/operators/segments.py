"""Ordered per-key computations that survive a hot key.

A window partitioned by key puts each key in one task, and a key that holds a third of a large table
never ends. Here a key that fills more than two tasks' share is cut into stretches of its order; the window runs per
(key, stretch), and one summary row per stretch is carried forward and joined back. The plan is the same for any
input, and the result is that of the plain window.

Which keys are cut, and where, comes from a sample by hash and is held as constants: the stretch of a row is a function of
the row alone. So nothing has to be written to keep it, a recomputed task gives the same rows, and the wide rows are
shuffled once, for the window. Count, sample and summaries read keys, order and the needed values only. ``df`` is read once for each of
these and must give the same rows each time.

``order`` lists columns in ascending order, nulls first; it should be unique per key. Rows that tie in all of them are
told apart by a hash of the values in question, so that equal keys and orders can be cut, and then by one of the row (maps and
variants aside). Rows that are equal in keys, order and values stay in one stretch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.session import cut_lineage

SAMPLED = 16  # rows of the sample for each task's share
_OVER_STRETCHES = {"sum": F.sum, "count": F.sum, "rows": F.sum, "min": F.min, "max": F.max}


def _aggregate(kind: str, column: str) -> Column:
    if kind == "rows":
        return F.count(F.lit(1))
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[kind](F.col(column))


def _tie(df: DataFrame) -> Column:
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*plain)


def _same(keys: list[str], prefix: str) -> Column:
    """The row's keys equal those of a joined table, nulls too."""
    condition = F.lit(True)
    for i, name in enumerate(keys):
        condition = condition & F.col(name).eqNullSafe(F.col(f"{prefix}{i}"))
    return condition


def _with_stretch(df: DataFrame, keys: list[str], place: Column) -> DataFrame:
    """``df`` with ``_stretch``: how many borders of its key lie at or below its ``place``; 0 for keys that are not cut."""
    spark = df.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rate = 1 << 20
    least = min(rate, -(-rate * SAMPLED * shares // max(1, df.count())))
    held = [F.col(name).alias(f"_h{i}") for i, name in enumerate(keys)]
    sample = df.where(F.pmod(F.xxhash64(*keys, place), F.lit(rate)) < least).select(*held, place.alias("p")).distinct()
    by_key = sample.groupBy(*[f"_h{i}" for i in range(len(keys))]).agg(F.array_sort(F.collect_list("p")).alias("every"))
    borders = F.filter("every", lambda _p, i: (i > 0) & (F.pmod(i, F.lit(SAMPLED)) == 0)).alias("_borders")
    cut = by_key.where(F.size("every") >= 2 * SAMPLED).select(*[f"_h{i}" for i in range(len(keys))], borders)
    # About a border for each task's share, whatever the input; held by the driver so that every pass sees the same ones.
    fixed = F.broadcast(spark.createDataFrame(cut.collect(), cut.schema))
    steps = [1 << k for k in reversed(range((4 * shares).bit_length()))]

    def search(pos: Column, step: Column) -> Column:
        further = (pos + step <= F.size("_borders")) & (F.get("_borders", pos + step - 1) <= place)
        return F.when(further, pos + step).otherwise(pos)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), search)
    joined = df.join(fixed, _same(keys, "_h"), "left")
    return joined.select(*df.columns, F.col("_borders").isNotNull().alias("_cut"), F.when(F.col("_borders").isNotNull(), found).otherwise(0).alias("_stretch"))


def with_ordered(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lags: dict[str, str] | None = None,
    running: dict[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Add previous values and running values per key in order, in one pass over ranges.

    ``lags[new]`` names the column whose previous value is wanted, null on the first row. ``running[new]`` is
    (kind, expression), inclusive; kinds are ``sum``, ``count``, ``min``, ``max`` and ``rows`` (row number).
    """
    lags, running = lags or {}, running or {}
    base = df.select("*", *[e.alias(f"_x_{n}") for n, (_k, e) in running.items()])
    # Rows that tie in this too are alike for all that is computed here, so no other column has to be read to place them.
    needed = [F.col(c) for c in lags.values()] + [F.col(f"_x_{n}") for n in running]
    base = base.withColumn("_tie", F.xxhash64(*needed))
    place = F.struct(*[F.col(c) for c in order], F.col("_tie"))
    dealt = _with_stretch(base, keys, place)
    held = [f"_k{i}" for i in range(len(keys))]
    values = F.struct(F.lit(True), *[F.col(c).alias(n) for n, c in lags.items()])
    tails = dealt.where("_cut").groupBy(*[F.col(k).alias(h) for k, h in zip(keys, held)], F.col("_stretch").alias("_at")).agg(
        F.max_by(values, place).alias("_tail"), *[_aggregate(k, f"_x_{n}").alias(f"_t_{n}") for n, (k, _e) in running.items()]
    )
    before = Window.partitionBy(*held).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(
        *held, "_at", F.last("_tail", ignorenulls=True).over(before).alias("_tail"),
        *[_OVER_STRETCHES[k](f"_t_{n}").over(before).alias(f"_c_{n}") for n, (k, _e) in running.items()],
    )
    # One row for each stretch, so the broadcast is bounded by the number of tasks.
    joined = dealt.join(F.broadcast(carried), _same(keys, "_k") & (F.col("_stretch") == F.col("_at")), "left")
    joined = joined.withColumn("_goes_on", F.col("_tail").isNotNull()).withColumn("_row", _tie(df))
    window = Window.partitionBy(*keys, "_stretch").orderBy(*[F.col(c).asc_nulls_first() for c in order], "_tie", "_row")
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = joined.select(
        "*", F.row_number().over(window).alias("_place"),
        *[F.lag(c).over(window).alias(f"_lag_{n}") for n, c in lags.items()],
        *[_aggregate(k, f"_x_{n}").over(upto).alias(f"_run_{n}") for n, (k, _e) in running.items()],
    )
    picked = [F.when(F.col("_place") > 1, F.col(f"_lag_{n}")).when(F.col("_goes_on"), F.col("_tail")[n]).alias(n) for n in lags]
    for name, (kind, _expr) in running.items():
        local, carry = F.col(f"_run_{name}"), F.when(F.col("_goes_on"), F.col(f"_c_{name}"))
        if kind == "min":
            value = F.least(local, carry)
        elif kind == "max":
            value = F.greatest(local, carry)
        elif kind == "sum":  # a sum over nothing but nulls stays null
            value = F.coalesce(local + carry, local, carry)
        else:
            value = local + F.coalesce(carry, F.lit(0))
        picked.append(value.alias(name))
    return seen.select(*df.columns, *picked)


def with_lag(df: DataFrame, keys: list[str], order: list[str], outputs: dict[str, str]) -> DataFrame:
    """Add ``outputs[new] = previous value of column`` per key in order; null on the first row."""
    return with_ordered(df, keys, order, lags=outputs)


def with_running(df: DataFrame, keys: list[str], order: list[str], outputs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add inclusive running values per key in order: ``outputs[new] = (kind, expression)``."""
    return with_ordered(df, keys, order, running=outputs)


def exact_percentiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    quantiles: dict[str, float],
    digits: int | None = 2,
) -> DataFrame:
    """Linear-interpolation percentiles per group, without gathering a group in one buffer.

    Values are counted first, so equal values shrink map-side; ranks are running counts.
    """
    histogram = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    # Values and counts only; what counts them is not done again for each pass over the ranges.
    histogram = cut_lineage(histogram)
    ranked = with_running(histogram, groups, ["_v"], {"_cum": ("sum", F.col("_c"))})
    sizes = ranked.groupBy(*groups).agg(F.max("_cum").alias("_n"))
    if groups:
        cond = None
        renamed = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], "_n")
        for i, g in enumerate(groups):
            term = F.col(g).eqNullSafe(F.col(f"_g{i}"))
            cond = term if cond is None else cond & term
        joined = ranked.join(renamed, cond, "inner")
    else:
        joined = ranked.withColumn("_n", sizes.select("_n").scalar())
    picks = []
    for name, q in quantiles.items():
        rank = (F.col("_n") - 1) * F.lit(float(q))
        low = F.floor(rank) + 1
        high = F.ceil(rank) + 1
        picks += [
            F.min(F.when(F.col("_cum") >= low, F.col("_v"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") >= high, F.col("_v"))).alias(f"_hi_{name}"),
        ]
    edges = joined.groupBy(*groups).agg(F.first("_n").alias("_n"), *picks)
    out = []
    for name, q in quantiles.items():
        rank = (F.col("_n") - 1) * F.lit(float(q))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        result = low + (high - low) * (rank - F.floor(rank))
        out.append((F.round(result, digits) if digits is not None else result).alias(name))
    return edges.select(*groups, *out)
