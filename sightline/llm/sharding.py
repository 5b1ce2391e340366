"""Even shards that keep linked documents together: balanced label propagation.

Documents with equal texts are linked; a group that no shard can hold is parted beforehand. Every document starts
with a label of its own hash, so a group starts scattered and is gathered by the rounds alone. In each round a group asks
for the label that most of it has; ties, and a label with one member less but room, are decided by a hash of group, label and round,
so a group that was not let in asks elsewhere the next time. A label lets in as many as leave it and fit below its quota. Which
groups these are is decided by a hash of group and round: all members under a label move or none, so the number of cut links
never grows, and a rerun decides alike. The last round also swaps what two labels ask of each other. At the end each shard keeps the
linked documents of its label, up to its quota, and the others fill the rest in the order of their groups, so counts are at
most one apart. Only counts per group and label are ever gathered for a group, shards squared at most on the driver.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import ready
from sightline.operators.ordering import with_position
from sightline.session import cut_lineage

SETTLING = 50  # passes over the counts until the shares of all labels agree
TIE = 0.9  # less than a member


def _chance(*columns) -> F.Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def grants(asked: DataFrame, quota: float) -> DataFrame:
    """(label, wanted, share): the share of the documents under ``label`` that may move to ``wanted``, of counts (label, wanted, n).

    Counts with label = wanted are documents that stay. Equal counts in both directions are swapped, the rest
    shares the room below the quota.
    """
    load = asked.groupBy(F.col("label").alias("wanted")).agg(F.sum("n").alias("load"))
    asks = asked.where("label <> wanted")
    back = asks.select(F.col("label").alias("wanted"), F.col("wanted").alias("label"), F.col("n").alias("back"))
    both = asks.join(back, ["label", "wanted"], "left").withColumn("swap", F.least("n", F.coalesce("back", F.lit(0))))
    left = both.groupBy("wanted").agg(F.sum(F.col("n") - F.col("swap")).alias("left")).join(load, "wanted", "left")
    room = F.greatest(F.lit(0.0), F.lit(quota) - F.coalesce("load", F.lit(0)))
    fits = left.select("wanted", F.least(F.lit(1.0), room / F.greatest("left", F.lit(1))).alias("fits"))
    share = (F.col("swap") + (F.col("n") - F.col("swap")) * F.col("fits")) / F.col("n")
    return both.join(fits, "wanted").select("label", "wanted", share.alias("share"))


def admitted(asked: list[tuple[int, int, int]], quota: float) -> dict[int, float]:
    """{wanted: share}: the share of those asking for a label that it can let in, of counts (label, wanted, n).

    No label takes more than its room below the quota and what leaves it. Who is refused does not leave either, so shares
    fall until all agree, or ``SETTLING`` times; they bound chances, and the exact fill corrects the rest.
    """
    load, inward, outward = defaultdict(int), defaultdict(list), defaultdict(list)
    for label, wanted, n in asked:
        load[label] += n
        if label != wanted:
            inward[wanted].append(n)
            outward[label].append((wanted, n))
    share = dict.fromkeys(inward, 1.0)
    for _ in range(SETTLING):
        fits = {}
        for wanted, parts in inward.items():
            leaving = sum(n * share[to] for to, n in outward[wanted])
            fits[wanted] = min(share[wanted], (max(0.0, quota - load[wanted]) + leaving) / sum(parts))
        if fits == share:
            break
        share = fits
    return share


def propagated(linked: DataFrame, quota: float, rounds: int) -> DataFrame:
    """``linked`` (id, hub, label, ...) with the labels after ``rounds`` of propagation at most, fewer if nobody asks to move."""
    spark, labels = linked.sparkSession, cut_lineage(linked)
    for turn in range(rounds):
        room = {r["label"]: max(0.0, quota - r["count"]) for r in labels.groupBy("label").count().collect()}
        most = max([1.0, *room.values()])
        open_ = F.broadcast(spark.createDataFrame([(k, v / most) for k, v in room.items()], "label int, open double"))
        held = labels.groupBy("hub", "label").agg(F.count("*").alias("n")).join(open_, "label")
        score = F.col("n") + TIE * _chance("hub", "label", F.lit(turn)) + F.col("open")
        best = held.groupBy("hub").agg(F.max(F.struct(score.alias("score"), "label")).alias("best"))
        want = labels.join(best.select("hub", F.col("best.label").alias("wanted")), "hub")
        asked = cut_lineage(want.groupBy("label", "wanted").agg(F.count("*").alias("n")))  # shards squared at most
        counts = [tuple(r) for r in asked.collect()]
        if all(label == wanted for label, wanted, _ in counts):
            break
        whole = spark.createDataFrame(list(admitted(counts, quota).items()), "wanted int, whole double")
        share = asked.where("label <> wanted").join(F.broadcast(whole), "wanted").select("label", "wanted", F.col("whole").alias("share"))
        if turn == rounds - 1:
            swapped = grants(asked, quota).withColumnRenamed("share", "swapped")
            share = share.join(swapped, ["label", "wanted"]).select("label", "wanted", F.greatest("share", "swapped").alias("share"))
        moves = _chance("hub", F.lit(turn)) < F.coalesce("share", F.lit(0.0))
        moved = want.join(F.broadcast(share), ["label", "wanted"], "left").withColumn("label", F.when(moves, F.col("wanted")).otherwise(F.col("label")))
        labels = cut_lineage(moved.select(*labels.columns))
    return labels


def started(linked: DataFrame, shards: int, total: int) -> DataFrame:
    """``linked`` (id, hub, members, ...) with a first label by a hash of the id; groups larger than a shard become several groups."""
    parts = F.ceil(F.col("members") * F.lit(shards) / F.lit(max(total, 1)))
    part = F.pmod(F.xxhash64("id", "hub"), F.greatest(parts, F.lit(1)))
    label = F.pmod(F.xxhash64(F.lit("label"), "id"), F.lit(shards)).cast("int")
    dealt = linked.withColumn("part", part).withColumn("label", label)
    return dealt.withColumn("hub", F.when(parts > 1, F.xxhash64("hub", "part")).otherwise(F.col("hub"))).drop("part")


def balanced_shards(df: DataFrame, shards: int = 24, rounds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id_col``, size (UTF-8 bytes of the text and 8), text_crc32, shard (from 0), slot (from 0 in a shard).

    Shard counts differ by one at most. A null text has size 8 and checksum 0; null texts are linked to each other,
    as are empty ones. Repeated rows and null ids are rows like others. Other columns are not read.
    """
    ready(df.sparkSession)
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    docs = cut_lineage(df.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col).isNull(), F.col(text_col)).alias("hub"),
        (F.octet_length(raw) + F.lit(8)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    ))
    total = docs.count()
    groups = docs.groupBy("hub").agg(F.count("*").alias("members"))
    marked = docs.join(groups, "hub")
    linked = propagated(started(marked.where("members > 1"), shards, total), total / shards, rounds)
    placed = with_position(linked, ["label", F.desc("members"), "hub", "id"])
    spark = df.sparkSession
    loads = {r["label"]: (r["n"], r["first"]) for r in placed.groupBy("label").agg(F.count("*").alias("n"), F.min("position").alias("first")).collect()}
    rows, room = [], 0
    for shard in range(shards):
        n, first = loads.get(shard, (0, 0))
        size = total // shards + (shard < total % shards)
        kept = min(n, size)
        rows.append((shard, first, size, kept, room, room + size - kept))
        room += size - kept
    plan = F.broadcast(spark.createDataFrame(rows, "shard int, first long, quota long, kept long, fill_from long, fill_to long"))
    placed = placed.join(plan.select(F.col("shard").alias("label"), "first", "quota"), "label").withColumn("slot", F.col("position") - F.col("first"))
    own = placed.where("slot < quota").select("id", "size", "text_crc32", F.col("label").alias("shard"), "slot")
    columns = ["hub", "id", "size", "text_crc32"]
    # The rest of a label stays in a row, so few groups lie across a border.
    loose = placed.where("slot >= quota").select(columns).union(marked.where("members = 1").select(columns))
    filled = with_position(loose, ["hub", "id"])
    # Which shard a place falls into: a sum over the few borders, instead of a range join.
    border = F.expr("0" + "".join(f" + CAST(position >= {r[5]} AS INT)" for r in rows[:-1]))
    filled = filled.withColumn("shard", border).join(plan.select("shard", "kept", "fill_from"), "shard")
    filled = filled.select("id", "size", "text_crc32", "shard", (F.col("position") - F.col("fill_from") + F.col("kept")).alias("slot"))
    return own.union(filled).withColumnRenamed("id", id_col)
