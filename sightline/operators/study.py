"""Payload study: what details add to search items, and how much repeated details drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.json_ops import effectively_null, is_important_path
from sightline.functions.scalars import safe_ratio
from sightline.operators.segments import with_lag

TOP_PATHS = 20
STABLE_RATE, MODERATE_RATE = 0.2, 0.5


def compare_paths(search: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Detail paths of entities present on both sides: only in detail, informative, important."""
    both = search.select(key).distinct().join(detail.select(key).distinct(), key)
    s = search.select(key, "path", F.col("leaf_values").alias("_s"))
    rows = detail.join(both, key, "left_semi").join(s, [key, "path"], "left")
    missing = F.col("_s").isNull()
    informative = ~effectively_null(F.col("leaf_values")) & (missing | effectively_null(F.col("_s")))
    return rows.select(
        key,
        "path",
        missing.alias("detail_only"),
        informative.alias("detail_non_null"),
        (informative & is_important_path(F.col("path"))).alias("important"),
    )


def top_paths(rows: DataFrame, flag: str, n: int = TOP_PATHS) -> DataFrame:
    """In how many entities a path carries the flag; equal counts in path order."""
    return (
        rows.filter(F.col(flag)).groupBy("path").agg(F.count(F.lit(1)).alias("vacancy_count"))
        .orderBy(F.desc("vacancy_count"), "path").limit(n)
    )


def paths_only_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Set difference of (entity, path)."""
    return left.select(*keys).join(right.select(*keys), keys, "left_anti")


def consecutive_pairs(observations: DataFrame, key: str, round_: str, present: str) -> DataFrame:
    """Each round with the one before it; comparable if both brought a payload."""
    lagged = with_lag(observations, [key], [round_], {"from_round": round_, "_had": present})
    return lagged.filter("from_round is not null").select(
        key, "from_round", F.col(round_).alias("to_round"), (F.col("_had") & F.col(present)).alias("comparable")
    )


def changed_paths(pairs: DataFrame, leaves: DataFrame, key: str, round_: str) -> DataFrame:
    """Paths that differ between the two rounds of a pair; a missing path counts as changed.

    The leaves of a document travel packed in one row, to the pair it comes before and the one it comes after, and are opened
    where both sides of a pair meet.
    """
    ids = [key, "from_round", "to_round"]
    use = pairs.filter("comparable").select(*ids)
    before = use.select(*ids, F.col("from_round").alias(round_), F.lit(False).alias("_after"))
    sides = before.unionByName(use.select(*ids, F.col("to_round").alias(round_), F.lit(True).alias("_after")))
    packed = leaves.groupBy(key, round_).agg(F.collect_list(F.struct("path", "leaf_values")).alias("_leaves"))
    met = sides.join(packed, [key, round_]).select(*ids, "_after", "_leaves").repartition(*[F.col(c) for c in ids])
    side = met.select(*ids, "_after", F.inline("_leaves"))
    a, b = (F.max(F.when(F.col("_after") == after, F.col("leaf_values"))) for after in (False, True))
    both = side.groupBy(*ids, "path").agg(a.alias("_a"), b.alias("_b"))
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*ids, "path")


def drift_rate(pairs: DataFrame, changes: DataFrame, key: str, label: str) -> DataFrame:
    """Comparable pairs, pairs with a change, and their ratio."""
    n = pairs.agg(F.count_if("comparable").alias("comparable_pairs"))
    hit = changes.select(key, "from_round", "to_round").distinct().agg(F.count(F.lit(1)))
    return n.select(
        F.lit(label).alias("view"), "comparable_pairs", hit.scalar().alias("changed_pairs")
    ).withColumn("changed_pair_rate", safe_ratio(F.col("changed_pairs"), F.col("comparable_pairs")))


def recommendation(important_fields: Column, normalized_rate: Column) -> Column:
    """How often details should be fetched, by what they add and how they drift."""
    return (
        F.when(important_fields == 0, "detail_optional")
        .when(normalized_rate <= STABLE_RATE, "selective_detail")
        .when(normalized_rate <= MODERATE_RATE, "selective_detail_short_ttl")
        .otherwise("aggressive_detail_refresh")
    )
