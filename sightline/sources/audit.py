"""Archive audit: file checks, checkpoint chain, receipts, copy and prune plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.segments import with_lag
from sightline.session import cut_lineage
from sightline.sources.archive import below

RECEIPT_FIELDS = ("dataset_key", "layer", "row_count", "data_size_bytes", "data_sha256")
REQUIRED_MANIFEST_FIELDS = (
    "dataset_key", "layer", "row_count", "data_file", "data_size_bytes", "data_sha256", "format", "compression",
)


def verify_files(manifests: DataFrame, digests: DataFrame, counts: DataFrame, inventory: DataFrame, root: str) -> DataFrame:
    """Every manifest with the first thing wrong about its file, or null; files are named below ``root``."""
    found = digests.select(
        below(F.col("data_file"), root).alias("data_file"), F.col("data_size_bytes").alias("_size"), F.col("data_sha256").alias("_sha")
    )
    rows = counts.select(below(F.col("data_file"), root).alias("data_file"), F.col("row_count").alias("_rows"))
    listed = inventory.select("manifest_file").distinct().withColumn("_listed", F.lit(True))
    missing = F.lit(False)
    for field in REQUIRED_MANIFEST_FIELDS:
        missing = missing | F.col(field).isNull()
    issue = (
        F.when(missing, "manifest field missing")
        .when(~F.col("format").isin("jsonl") | (F.col("compression") != "gzip"), "unsupported format")
        .when(F.col("_sha").isNull(), "data file missing")
        .when(F.col("_size") != F.col("data_size_bytes"), "data size mismatch")
        .when(F.col("_sha") != F.col("data_sha256"), "data checksum mismatch")
        .when(F.coalesce("_rows", F.lit(0)) != F.col("row_count"), "row count mismatch")
        .when(F.col("_listed").isNull(), "manifest not in inventory")
    )
    joined = manifests.join(found, "data_file", "left").join(rows, "data_file", "left").join(listed, "manifest_file", "left")
    return joined.withColumn("issue", issue).select(*manifests.columns, "issue")


def with_receipts(manifests: DataFrame, receipts: DataFrame, url: str, root: str, min_objects: int = 2) -> DataFrame:
    """Manifests with why their verification receipt does not count; null when it is exactly equal."""
    r = receipts.select(
        "manifest_file", F.struct(*RECEIPT_FIELDS).alias("_r"), F.struct("offsite_url", "offsite_root").alias("_t"),
        F.col("verified_object_count").alias("_n"),
    )
    same = F.lit(True)
    for field in RECEIPT_FIELDS:
        same = same & F.col("_r")[field].eqNullSafe(F.col(field))
    target = (F.col("_t.offsite_url") == url) & (F.col("_t.offsite_root") == root)
    issue = (
        F.when(F.col("_r").isNull(), "receipt missing")
        .when(~same, "receipt mismatch")
        .when(~target, "receipt target mismatch")
        .when(F.col("_n") < min_objects, "receipt has too few objects")
    )
    return manifests.join(r, "manifest_file", "left").withColumn("receipt_issue", issue).drop("_r", "_t", "_n")


def chain_audit(checkpoints: DataFrame, manifests: DataFrame, start: int = 0) -> DataFrame:
    """Checkpoints with their issue, judged against the checkpoint before them.

    ``manifests`` is long: (checkpoint_id, dataset_key, manifest_file, row_count, source_min_id,
    source_max_id, receipt_issue). ``valid`` holds for the unbroken prefix of each dataset.
    """
    order = ["created_at", "checkpoint_id"]
    owner = F.struct(*order)
    refs = manifests.join(checkpoints.select("checkpoint_id", "dataset_key", "created_at"), ["checkpoint_id", "dataset_key"])
    first_use = refs.groupBy("dataset_key", "manifest_file").agg(F.min(owner).alias("_first"))
    refs = refs.join(first_use, ["dataset_key", "manifest_file"])
    facts = refs.groupBy("checkpoint_id", "dataset_key").agg(
        F.count(F.lit(1)).alias("_files"),
        F.sum("row_count").alias("_rows"),
        F.min("source_min_id").alias("_min"),
        F.max("source_max_id").alias("_max"),
        F.bool_or(owner > F.col("_first")).alias("_reused"),
        F.min("receipt_issue").alias("_receipt"),
    )
    chained = with_lag(checkpoints, ["dataset_key"], order, {"_previous": "source_id_after"})
    rows = chained.join(facts, ["checkpoint_id", "dataset_key"], "left").na.fill(0, ["_files", "_rows"])
    expected = F.coalesce("_previous", F.lit(start))
    files, before, after = F.col("_files"), F.col("source_id_before"), F.col("source_id_after")
    issue = (
        F.when(before != expected, "chain break")
        .when(after < before, "cursor goes back")
        .when(F.col("chunk_count") != files, "chunk count mismatch")
        .when((after > before) != (files > 0), "progress without files")
        .when((F.col("row_count") > 0) != (files > 0), "rows without files")
        .when(F.col("_reused"), "manifest used twice")
        .when(F.col("_receipt").isNotNull(), F.col("_receipt"))
        .when(F.col("row_count") != F.col("_rows"), "row count mismatch")
        .when(F.col("_min") <= before, "range overlaps the previous cursor")
        .when(F.col("_max") != after, "cursor differs from the files")
    )
    judged = cut_lineage(rows.withColumn("issue", issue))  # used twice below
    broken = judged.groupBy("dataset_key").agg(F.min(F.when(F.col("issue").isNotNull(), owner)).alias("_broken"))
    out = judged.join(broken, "dataset_key")
    valid = F.col("_broken").isNull() | (owner < F.col("_broken"))
    at_break = owner == F.col("_broken")
    return out.select(
        *checkpoints.columns, F.col("_files").alias("file_count"), valid.alias("valid"),
        F.when(at_break, F.col("issue")).alias("issue"),
    )


def coverage(audited: DataFrame, datasets: list[str] | None = None) -> DataFrame:
    """Per dataset: complete or not, what the valid prefix covers, and the first issue."""
    v = F.col("valid")
    out = audited.groupBy("dataset_key").agg(
        F.when(F.count("issue") == 0, "complete").otherwise("incomplete").alias("status"),
        F.count(F.lit(1)).alias("scanned_checkpoint_count"),
        F.count_if(v).alias("verified_checkpoint_count"),
        F.coalesce(F.sum(F.when(v, F.col("file_count"))), F.lit(0)).alias("verified_manifest_count"),
        F.coalesce(F.sum(F.when(v, F.col("row_count"))), F.lit(0)).alias("verified_row_count"),
        F.coalesce(F.max(F.when(v, F.col("source_id_after"))), F.lit(0)).alias("source_id_covered"),
        F.max("issue").alias("issue"),
    )
    return out if datasets is None else out.filter(F.col("dataset_key").isin(*datasets))


def overall_status(summary: DataFrame) -> DataFrame:
    good = F.coalesce(F.bool_and(F.col("status") == "complete"), F.lit(False))
    return summary.agg(F.when(good, "complete").otherwise("incomplete").alias("status"))


def copy_plan(manifests: DataFrame, receipts: DataFrame) -> DataFrame:
    """Bundles still to copy; one with an equal upload receipt is skipped."""
    keys = ["manifest_file", "data_size_bytes", "data_sha256"]
    done = receipts.select(*keys).distinct().withColumn("_done", F.lit(True))
    return manifests.join(done, keys, "left").withColumn(
        "action", F.when(F.col("_done").isNotNull(), "skipped").otherwise("copy")
    ).drop("_done")


def _by_folder(files: DataFrame, root: str) -> DataFrame:
    name = below(F.col("data_file"), root)
    return files.select(name.alias("data_file"), F.regexp_extract(name, r"^(.*)/[^/]*$", 1).alias("_folder"), "data_size_bytes", "data_sha256")


def _folder_digests(files: DataFrame, name: str) -> DataFrame:
    """One digest for each folder that does not depend on the order of its files."""
    entry = F.xxhash64("data_file", "data_size_bytes", "data_sha256")
    return files.groupBy("_folder").agg(F.struct(F.count("*"), F.sum("data_size_bytes"), F.bit_xor(entry), F.sum(F.shiftright(entry, 24))).alias(name))


def replica_check(local: DataFrame, replica: DataFrame, local_root: str, replica_root: str) -> DataFrame:
    """Files of both sides by their path below the root of their side, with what differs, or null.

    Folders are compared first, by a digest that each side sums up; only files of folders that differ are joined one by one.
    """
    a, b = _by_folder(local, local_root), _by_folder(replica, replica_root)
    pairs = _folder_digests(a, "_x").join(_folder_digests(b, "_y"), "_folder", "full_outer")
    differ = pairs.filter(~F.col("_x").eqNullSafe(F.col("_y"))).select("_folder")
    same = a.join(differ, "_folder", "left_anti").select("data_file", F.lit(None).cast("string").alias("issue"))
    sides = [
        side.join(differ, "_folder", "left_semi").select("data_file", F.struct("data_size_bytes", "data_sha256").alias(name))
        for side, name in ((a, "_a"), (b, "_b"))
    ]
    issue = (
        F.when(F.col("_b").isNull(), "missing in replica")
        .when(F.col("_a").isNull(), "unknown file in replica")
        .when(F.col("_a.data_size_bytes") != F.col("_b.data_size_bytes"), "size differs")
        .when(F.col("_a.data_sha256") != F.col("_b.data_sha256"), "content differs")
    )
    return same.union(sides[0].join(sides[1], "data_file", "full_outer").select("data_file", issue.alias("issue")))


def prune_plan(
    manifests: DataFrame, files: DataFrame, uploads: DataFrame, verified: DataFrame, now: Column, min_age_days: int, root: str = ""
) -> DataFrame:
    """What may be dropped locally: data present, old enough, equal upload and verification receipts."""
    present = files.select(below(F.col("data_file"), root).alias("data_file"), "modified_at", F.col("data_size_bytes").alias("_size"))
    keys = ["manifest_file", "data_size_bytes", "data_sha256"]
    up = uploads.select(*keys).distinct().withColumn("_up", F.lit(True))
    ok = verified.select(*keys).distinct().withColumn("_ok", F.lit(True))
    rows = manifests.join(present, "data_file", "left").join(up, keys, "left").join(ok, keys, "left")
    young = F.col("modified_at") > now.cast("timestamp") - F.make_interval(days=F.lit(min_age_days))
    action = (
        F.when(F.col("_size").isNull(), "already_pruned")
        .when(F.col("_size") != F.col("data_size_bytes"), "size_mismatch")
        .when(young, "too_young")
        .when(F.col("_up").isNull(), "upload_receipt_missing")
        .when(F.col("_ok").isNull(), "verification_receipt_missing")
        .otherwise("prune")
    )
    freed = F.when(F.col("action") == "prune", F.col("data_size_bytes")).otherwise(0)
    return rows.withColumn("action", action).withColumn("freed_bytes", freed.cast("long")).select(
        *manifests.columns, "action", "freed_bytes"
    )
