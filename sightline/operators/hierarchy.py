"""Adjacency lists as trees: level, root and place in depth-first order, with orphans as roots.

Pointers are doubled: after k rounds a node knows its ancestor 2^k above, and sums along the way. A tree of any depth
takes a number of joins that grows with the logarithm of its depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.segments import with_running
from sightline.session import cut_lineage


def with_root_flag(nodes: DataFrame, row_id: str, parent: str, scope: list[str]) -> DataFrame:
    """``is_root``: no parent, or a parent outside the scope's own set."""
    parents = nodes.select(*scope, F.col(row_id).alias(parent), F.lit(True).alias("_has"))
    return nodes.join(parents, [*scope, parent], "left").withColumn("is_root", F.col("_has").isNull()).drop("_has")


def _doubled(nodes: DataFrame, sums: list[str], up_sum: str | None, most: int) -> DataFrame:
    """``nodes`` (node, jump, ...) after pointer doubling: every ``sums`` column added up over the node and all its
    ancestors, ``up_sum`` over the node and all its descendants; ``top`` is the root and ``jump`` null. A node on
    or below a cycle keeps its pointer when 2^rounds has passed ``most``, the number of nodes.
    """
    state, reach = cut_lineage(nodes.withColumn("top", F.coalesce("jump", "node"))), 1
    while reach <= 2 * most and not state.where("jump IS NOT NULL").isEmpty():
        above = state.select(
            F.col("node").alias("jump"), F.col("jump").alias("_jump"), F.col("top").alias("_top"), *[F.col(c).alias(f"_{c}") for c in sums]
        )
        moved = {"jump": F.col("_jump"), "top": F.coalesce("_top", "top"), **{c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in sums}}
        # Nodes that are done have no pointer to join by; as nulls of a left join they would all meet in one task.
        going = state.where("jump IS NOT NULL").join(above, "jump", "left").select(*[moved.get(c, F.col(c)).alias(c) for c in state.columns])
        further = going.union(state.where("jump IS NULL"))
        if up_sum:
            below = state.where("jump IS NOT NULL").groupBy(F.col("jump").alias("node")).agg(F.sum(up_sum).alias("_below"))
            further = further.join(below, "node", "left").withColumn(up_sum, F.col(up_sum) + F.coalesce("_below", F.lit(0)))
        state = cut_lineage(further.select(*state.columns))
        reach *= 2
    return state


def walk(nodes: DataFrame, row_id: str, parent: str, siblings: list[str], scope: list[str] | None = None) -> DataFrame:
    """Every reachable node of each ``scope`` with ``tree_level``, ``root_id`` and ``tree_position`` (from 1, depth first).

    Siblings, and the roots of a scope, follow each other by ``siblings``. Ids are unique in a scope; a parent outside the scope makes a root.
    Two doublings: the first counts levels and the nodes below each node, the second adds up along each path how many
    nodes stand before it. Nodes on or below a cycle are left out; ``unreachable`` lists them.
    """
    scope = scope or []
    flagged = with_root_flag(nodes, row_id, parent, scope)
    node = F.struct(*scope, row_id)
    rows = flagged.select(
        node.alias("node"), F.when(~F.col("is_root"), F.struct(*scope, F.col(parent).alias(row_id))).alias("jump"),
        F.struct(*siblings).alias("step"), F.lit(1).cast("long").alias("size"), F.lit(1).cast("long").alias("levels"),
    )
    first = rows.withColumn("parent", F.col("jump"))
    most = first.count()
    sized = _doubled(first, ["levels"], "size", most).where("jump IS NULL")
    family = sized.select("*", *[F.col("node")[c].alias(f"_s{i}") for i, c in enumerate(scope)])
    keys = [*[f"_s{i}" for i in range(len(scope))], "parent"]
    # Places taken by a node and all its earlier siblings, less its own descendants: its step from its parent.
    ordered = with_running(family, keys, ["step", "node"], {"upto": ("sum", F.col("size"))})
    placed = ordered.select("node", F.col("parent").alias("jump"), "levels", F.col("top").alias("root"), (F.col("upto") - F.col("size") + 1).alias("position"))
    done = _doubled(placed, ["position"], None, most)
    return done.select(
        *[F.col("node")[c].alias(c) for c in scope], F.col("node")[row_id].alias(row_id), (F.col("levels") - 1).cast("int").alias("tree_level"),
        F.col("root")[row_id].alias("root_id"), F.col("position").alias("tree_position"),
    )


def unreachable(nodes: DataFrame, walked: DataFrame, row_id: str) -> DataFrame:
    """Nodes on a cycle: an issue to report, never a hang."""
    return nodes.join(walked.select(row_id), row_id, "left_anti")


def active_roots(areas: DataFrame) -> DataFrame:
    return areas.filter(F.col("is_active") & F.col("parent_area_id").isNull())


def active_children(areas: DataFrame) -> DataFrame:
    """(parent natural key, child) pairs of active children."""
    parents = areas.select(F.col("id").alias("parent_area_id"), F.col("hh_area_id").alias("parent_hh_area_id"))
    return areas.filter("is_active").join(parents, "parent_area_id")


def leaf_children(areas: DataFrame, root_natural_id: str) -> DataFrame:
    """Active children of a root that have no active child themselves."""
    kids = active_children(areas).filter(F.col("parent_hh_area_id") == root_natural_id)
    inner = areas.filter("is_active").select(F.col("parent_area_id").alias("id"))
    return kids.join(inner, "id", "left_anti")


def area_order() -> list:
    return [F.asc_nulls_first("level"), F.asc_nulls_last("path_text"), F.asc("name"), F.asc("hh_area_id")]
