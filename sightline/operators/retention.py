"""Retention: which rows may go, in which order, what they drag along, and safe removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.latest import superseded
from sightline.session import JSON_TIMES, cut_lineage, scratch_path

ACTIVE_RUN = "created"
DOCUMENT_VERSION = "2"


def is_legacy_snapshot(document: str = "normalized_json") -> Column:
    """Documents without the current schema version; their raw payload is still needed."""
    return F.coalesce(F.get_json_object(document, "$.schema_version"), F.lit("")) != DOCUMENT_VERSION


def outside_active_runs(df: DataFrame, runs: DataFrame, run: str = "crawl_run_id") -> DataFrame:
    """Rows without a run, or whose run is not active (or gone)."""
    active = runs.filter(F.col("status") == ACTIVE_RUN).select(F.col("id").alias(run))
    return df.join(active, run, "left_anti").select(*df.columns)


def protected_payload_ids(snapshots: DataFrame) -> DataFrame:
    """Payloads a legacy snapshot refers to, by either reference."""
    legacy = snapshots.filter(is_legacy_snapshot())
    refs = F.explode(F.array("short_payload_ref_id", "detail_payload_ref_id"))
    return legacy.select(refs.alias("id")).filter("id is not null")


def _capped(df: DataFrame, cap: Column | None) -> DataFrame:
    return df if cap is None else df.filter(F.col("id") <= cap)


def payload_candidates(
    payloads: DataFrame, runs: DataFrame, snapshots: DataFrame, cutoff: Column, cap: Column | None = None
) -> DataFrame:
    old = _capped(payloads.filter(F.col("received_at") < cutoff), cap)
    return outside_active_runs(old, runs).join(protected_payload_ids(snapshots), "id", "left_anti")


def snapshot_candidates(
    snapshots: DataFrame, runs: DataFrame, cutoff: Column, cap: Column | None = None
) -> DataFrame:
    """Old snapshots that a newer one of the same (vacancy, type) supersedes."""
    narrow = snapshots.select("id", "vacancy_id", "snapshot_type", "captured_at", "crawl_run_id")
    stale = superseded(narrow, ["vacancy_id", "snapshot_type"], ["captured_at", "id"], "id")
    old = _capped(stale.filter(F.col("captured_at") < cutoff), cap)
    return outside_active_runs(old, runs)


def latest_ids(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("vacancy_id", "crawl_run_id").agg(F.max("id").alias("id")).select("id")


def attempt_candidates(
    attempts: DataFrame, runs: DataFrame, cutoff: Column, cap: Column | None = None
) -> DataFrame:
    """Old attempts except the latest of each (vacancy, run)."""
    old = _capped(attempts.filter(F.col("requested_at") < cutoff), cap)
    return outside_active_runs(old, runs).join(latest_ids(attempts), "id", "left_anti")


def finished_runs(runs: DataFrame, cutoff: Column) -> DataFrame:
    return runs.filter((F.col("status") != ACTIVE_RUN) & (F.col("finished_at") < cutoff))


def runs_with_events_after(runs: DataFrame, events: DataFrame, covered_id: Column, blocked: bool) -> DataFrame:
    """Runs having (or, negated, not having) sightings above the archived id."""
    newest = events.groupBy("crawl_run_id").agg(F.max("id").alias("_max"))
    above = newest.filter(F.col("_max") > covered_id).select(F.col("crawl_run_id").alias("id"))
    return runs.join(above, "id", "left_semi" if blocked else "left_anti")


def oldest_first(candidates: DataFrame, at: str, limit: int) -> DataFrame:
    """The bounded selection of one retention step."""
    return candidates.orderBy(at, "id").limit(max(limit, 0))


def plan_row(
    target: str, candidates: DataFrame, retention_days: int, cutoff: Column, limit: int
) -> DataFrame:
    """Summary of one target: 0 days switches it off."""
    if retention_days == 0:
        counted = candidates.limit(0).agg(F.count(F.lit(1)).alias("candidate_count"))
    else:
        counted = candidates.agg(F.count(F.lit(1)).alias("candidate_count"))
    actions = F.least("candidate_count", F.lit(limit).cast("long"))
    enabled = retention_days > 0
    return counted.select(
        F.lit(target).alias("target"),
        (cutoff if enabled else F.lit(None).cast("timestamp_ntz")).alias("cutoff"),
        "candidate_count",
        actions.alias("action_count"),
        F.lit(enabled).alias("enabled"),
        (F.col("candidate_count") > actions).alias("limited"),
    )


def bounded_preview(
    target: str, candidates: DataFrame, at: str, limit: int, covered_id: Column, complete: Column
) -> DataFrame:
    """What a step capped by archive coverage would take; nothing unless the audit is complete."""
    allowed = candidates.filter(complete)
    chosen = oldest_first(allowed.select("id", at), at, limit)
    picked = chosen.agg(
        F.count(F.lit(1)).alias("action_count"),
        F.min("id").alias("selected_min_id"),
        F.max("id").alias("selected_max_id"),
    )
    return picked.select(
        F.lit(target).alias("target"),
        covered_id.alias("source_id_covered"),
        allowed.agg(F.count(F.lit(1))).scalar().alias("candidate_count"),
        "action_count",
        "selected_min_id",
        "selected_max_id",
    )


def archive_bounded_previews(targets: dict[str, tuple[str, DataFrame, str]], coverage: DataFrame, limit: int) -> DataFrame:
    """One row for each target, capped by what the archive covers of its dataset; no rows unless every dataset is complete.

    ``targets[name]`` is (dataset key, candidates with id, their time column). ``coverage`` is the audit of the checkpoint chains by
    dataset (status, source_id_covered). A dataset that the audit does not know makes it incomplete.
    """
    keys = sorted({key for key, _, _ in targets.values()})
    complete = (F.count_if(F.col("status") != "complete") == 0) & (F.count_if(F.col("dataset_key").isin(keys)) == len(keys))
    audit = coverage.agg(complete.alias("complete"), *[F.max(F.when(F.col("dataset_key") == k, F.col("source_id_covered"))).alias(k) for k in keys]).first()
    rows = []
    for name, (key, candidates, at) in targets.items():
        covered = F.lit(audit[key]).cast("long")
        capped = candidates.filter(F.col("id") <= covered)
        rows.append(bounded_preview(name, capped, at, limit, covered, F.lit(True)).filter(F.lit(audit["complete"])))
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def run_cascade_counts(run_ids: DataFrame, partitions: DataFrame, events: DataFrame) -> DataFrame:
    """Partitions and sightings that go together with the runs, per run."""
    ids = run_ids.select(F.col("id").alias("crawl_run_id"))
    p = partitions.groupBy("crawl_run_id").agg(F.count(F.lit(1)).alias("partition_count"))
    e = events.groupBy("crawl_run_id").agg(F.count(F.lit(1)).alias("seen_event_count"))
    return (
        ids.join(p, "crawl_run_id", "left").join(e, "crawl_run_id", "left")
        .na.fill(0, ["partition_count", "seen_event_count"])
    )


def without_runs(children: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Rows left after the cascade."""
    return children.join(run_ids.select(F.col("id").alias("crawl_run_id")), "crawl_run_id", "left_anti")


def run_set_null(referrers: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Referring rows stay, but lose the reference to removed runs."""
    gone = run_ids.select(F.col("id").alias("crawl_run_id"), F.lit(True).alias("_gone"))
    marked = referrers.join(gone, "crawl_run_id", "left")
    return marked.withColumn("crawl_run_id", F.when(F.col("_gone").isNull(), F.col("crawl_run_id"))).drop("_gone")


# Reasons shown for dated generations.
REASON_PROTECTED = "protected milestone backup"
REASON_LATEST = "latest verified generation"
REASON_WEEKLY = "weekly verified checkpoint"
REASON_NEWEST = "no newer verified generation exists"


def generation_plan(
    generations: DataFrame,
    row_id: str,
    at: str,
    keep_latest: int,
    keep_weekly: int,
    protected: str = "protected",
    verified: str = "verified",
) -> DataFrame:
    """Action and reason for dated generations: protected, latest n, newest of each ISO week for m weeks.

    A week's newest takes a weekly slot even if it is kept as one of the latest. Only verified
    generations take part; the newest is never a candidate.
    """
    usable = generations.filter(F.col(verified))
    order = [F.desc(at), F.desc(row_id)]
    latest = usable.select(row_id, at).orderBy(*order).limit(max(keep_latest, 0))
    newest = usable.select(row_id, at).orderBy(*order).limit(1)
    per_week = (
        usable.groupBy(F.extract(F.lit("YEAROFWEEK"), at).alias("_y"), F.extract(F.lit("WEEK"), at).alias("_w"))
        .agg(F.max(F.struct(at, row_id)).alias("_g"))
        .orderBy(F.desc("_y"), F.desc("_w"))
        .limit(max(keep_weekly, 0))
        .select(F.col(f"_g.{row_id}").alias(row_id))
    )

    def flag(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(row_id, F.lit(True).alias(name))

    marked = (
        generations.join(flag(latest, "_latest"), row_id, "left")
        .join(flag(per_week, "_weekly"), row_id, "left")
        .join(flag(newest, "_newest"), row_id, "left")
    )
    reason = (
        F.when(~F.col(verified), "receipts do not match")
        .when(F.col(protected), REASON_PROTECTED)
        .when(F.col("_latest"), REASON_LATEST)
        .when(F.col("_weekly"), REASON_WEEKLY)
        .when(F.col("_newest"), REASON_NEWEST)
    )
    action = F.when(~F.col(verified), "skipped").when(F.col("reason").isNotNull(), "retained").otherwise("delete_candidate")
    return marked.withColumn("reason", reason).withColumn("action", action).drop("_latest", "_weekly", "_newest")


def archive_before_delete(target: str, rows: DataFrame, path: str | None = None) -> DataFrame:
    """Write the rows due for removal and count them back from the files."""
    spark = rows.sparkSession
    path = path or scratch_path(spark, f"retention-{target}")
    selected = cut_lineage(rows)
    selected.write.options(compression="gzip", **JSON_TIMES).json(path)
    stored = spark.read.schema(selected.schema).options(**JSON_TIMES).json(path)
    return selected.agg(F.count(F.lit(1)).alias("selected_count")).select(
        F.lit(target).alias("target"),
        "selected_count",
        stored.agg(F.count(F.lit(1))).scalar().alias("archived_count"),
    ).withColumn("archived", F.col("selected_count") == F.col("archived_count"))


def apply_removal(target: str, table: DataFrame, ids: DataFrame, path: str | None = None) -> DataFrame:
    """Write the survivors as a new version and check that exactly the selected rows are gone.

    The caller switches to the new version only if ``exact`` is true.
    """
    spark = table.sparkSession
    path = path or scratch_path(spark, f"survivors-{target}")
    chosen = cut_lineage(ids.select("id"))
    table.join(chosen, "id", "left_anti").select(*table.columns).write.parquet(path)
    survivors = spark.read.schema(table.schema).parquet(path)
    return table.agg(F.count(F.lit(1)).alias("before_count")).select(
        F.lit(target).alias("target"),
        "before_count",
        chosen.agg(F.count(F.lit(1))).scalar().alias("selected_count"),
        survivors.agg(F.count(F.lit(1))).scalar().alias("survivor_count"),
    ).withColumn("exact", F.col("before_count") - F.col("survivor_count") == F.col("selected_count"))
