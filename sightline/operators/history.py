"""Observation histories: change points, state folds, reconciliation, refetch reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.latest import latest_per_key, latest_value
from sightline.operators.segments import with_lag, with_ordered, with_running

FETCH_CLOSED = ("succeeded", "terminal_404")
INACTIVE_AFTER_MISSING_RUNS = 2


def change_points(
    events: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
) -> DataFrame:
    """Sightings where the value appeared first or differs from the previous one of the key."""
    lagged = with_lag(events, keys, order, {"previous_value": value})
    reason = F.when(F.col("previous_value").isNull(), "first_seen").when(
        F.col("previous_value") != F.col(value), "short_hash_changed"
    )
    return lagged.withColumn("change_reason", reason).filter("change_reason is not null")


def fold_observations(
    events: DataFrame,
    key: str = "vacancy_id",
    at: str = "seen_at",
    tie: str = "id",
    run: str = "crawl_run_id",
    value: str = "short_hash",
) -> DataFrame:
    """State per key from sightings; the latest by (time, tie) wins."""
    newest = F.struct(at, tie)
    return events.groupBy(key).agg(
        F.min(at).alias("first_seen_at"),
        F.max(at).alias("last_seen_at"),
        F.count(F.lit(1)).alias("seen_count"),
        F.max_by(run, newest).alias("last_seen_run_id"),
        F.max_by(value, newest).alias("last_short_hash"),
    )


def merge_states(old: DataFrame, new: DataFrame, key: str = "vacancy_id") -> DataFrame:
    """Continue an old state with a newer fold. A sighting resets the missing counter."""
    o, n = old.alias("o"), new.alias("n")
    seen = F.col("n.seen_count").isNotNull()

    def newer(name: str) -> Column:
        return F.when(seen, F.col(f"n.{name}")).otherwise(F.col(f"o.{name}")).alias(name)

    columns = [
        F.coalesce("o.first_seen_at", "n.first_seen_at").alias("first_seen_at"),
        newer("last_seen_at"),
        (F.coalesce("o.seen_count", F.lit(0)) + F.coalesce("n.seen_count", F.lit(0))).alias("seen_count"),
        newer("last_seen_run_id"),
        newer("last_short_hash"),
    ]
    if "consecutive_missing_runs" in old.columns:
        columns += [
            F.when(seen, 0).otherwise(F.col("o.consecutive_missing_runs")).cast("int").alias("consecutive_missing_runs"),
            F.when(seen, False).otherwise(F.col("o.is_probably_inactive")).alias("is_probably_inactive"),
        ]
    return o.join(n, key, "full_outer").select(key, *columns)


def seen_in_run(states: DataFrame, events: DataFrame, run_id: str, key: str = "vacancy_id") -> DataFrame:
    """Every state with a flag: was the key sighted in this run."""
    sighted = events.filter(F.col("crawl_run_id") == run_id).select(key).distinct()
    return states.join(sighted.withColumn("_hit", F.lit(True)), key, "left").withColumn(
        "seen_in_run", F.col("_hit").isNotNull()
    ).drop("_hit")


def reconcile(flagged: DataFrame, threshold: int = INACTIVE_AFTER_MISSING_RUNS) -> DataFrame:
    """Reset or advance the missing counter of each state and decide probable inactivity."""
    missing = F.when(F.col("seen_in_run"), 0).otherwise(F.col("consecutive_missing_runs") + 1)
    return flagged.withColumn("consecutive_missing_runs", missing.cast("int")).withColumn(
        "is_probably_inactive",
        F.when(F.col("seen_in_run"), False).otherwise(F.col("consecutive_missing_runs") >= threshold),
    )


def reconcile_counts(flagged: DataFrame, threshold: int = INACTIVE_AFTER_MISSING_RUNS) -> DataFrame:
    """Seen and missing states, and those that turn inactive now (not those that already were)."""
    before = flagged.withColumn("_was", F.coalesce("is_probably_inactive", F.lit(False)))
    return reconcile(before, threshold).agg(
        F.count_if("seen_in_run").alias("observed_in_run_count"),
        F.count_if(~F.col("seen_in_run")).alias("missing_updated_count"),
        F.count_if(F.col("is_probably_inactive") & ~F.col("_was")).alias("marked_inactive_count"),
    )


def missing_run_counts(
    events: DataFrame, key: str = "vacancy_id", run: str = "crawl_run_id", at: str = "seen_at", threshold: int = 2,
    runs: DataFrame | None = None,
) -> DataFrame:
    """The counter after all runs: runs since the last one that sighted the key.

    Runs follow each other by their start (``runs``: run and started_at; without it their first sighting), never by
    their id, which carries no order.
    """
    started = events.groupBy(run).agg(F.min(at).alias("started_at")) if runs is None else runs.select(run, "started_at")
    numbered = with_running(started, [], ["started_at", run], {"run_index": ("rows", F.lit(1))})
    last = numbered.agg(F.max("run_index").alias("n"))
    newest = events.join(numbered.select(run, "run_index"), run).groupBy(key).agg(
        F.max("run_index").alias("run_index"), F.max_by(run, "run_index").alias("last_seen_run_id")
    )
    gap = (last.scalar() - F.col("run_index")).cast("int")
    return newest.select(
        key, "last_seen_run_id", gap.alias("consecutive_missing_runs"), (gap >= threshold).alias("is_probably_inactive")
    )


def latest_failed_attempts(attempts: DataFrame, key: str = "vacancy_id") -> DataFrame:
    """Latest failed attempt per key with the time it ended, or was asked for."""
    failed = attempts.filter(F.col("status") == "failed")
    return latest_per_key(failed, [key], ["requested_at", "id"], ["id", "attempt", "requested_at", "finished_at"]).select(
        key, "id", "attempt", F.coalesce("finished_at", "requested_at").alias("attempted_at")
    )


def repair_backlog(attempts: DataFrame, run: str = "crawl_run_id", key: str = "vacancy_id") -> DataFrame:
    """Latest attempt per (run, key) first, then only those that failed."""
    return latest_per_key(attempts, [run, key], ["requested_at", "id"]).filter(F.col("status") == "failed")


def next_attempt_numbers(attempts: DataFrame, keys: DataFrame, key: str = "vacancy_id") -> DataFrame:
    """Attempt number to use next for each requested key; 1 if it was never tried."""
    latest = attempts.groupBy(key).agg(latest_value(attempts, "attempt", ["requested_at", "id"]).alias("_last"))
    return keys.join(latest, key, "left").select(
        key, (F.coalesce("_last", F.lit(0)) + 1).cast("int").alias("next_attempt")
    )


def latest_hash_of_other_runs(events: DataFrame, run_id: str, key: str = "vacancy_id") -> DataFrame:
    """Latest hash per key among all runs but the given one, even later ones."""
    other = events.filter(F.col("crawl_run_id") != run_id)
    return other.groupBy(key).agg(F.max_by("short_hash", F.struct("seen_at", "id")).alias("previous_short_hash"))


def snapshot_reason(previous: Column, current: Column) -> Column:
    """Why a short snapshot is due: no earlier hash, or a different one; else null."""
    return F.when(previous.isNull(), "first_seen").when(~previous.eqNullSafe(current), "short_hash_changed")


def due_short_snapshots(
    observed: DataFrame, state_before: DataFrame, key: str = "vacancy_id", arrival: list[str] | None = None
) -> DataFrame:
    """Sightings that need a snapshot: each is judged by the sighting of its key before it.

    ``arrival`` orders the sightings of one batch, and only the first of a key is judged by ``state_before``. Without it
    every sighting is, as on a page that shows an item once.
    """
    before = state_before.select(key, F.col("last_short_hash").alias("_before"))
    if arrival:
        lagged = with_ordered(observed, [key], arrival, {"_earlier": "short_hash"}, {"_nth": ("rows", F.lit(1))})
        joined = lagged.join(before, key, "left").withColumn("_before", F.when(F.col("_nth") > 1, F.col("_earlier")).otherwise(F.col("_before")))
        joined = joined.drop("_earlier", "_nth")
    else:
        joined = observed.join(before, key, "left")
    reason = snapshot_reason(F.col("_before"), F.col("short_hash"))
    return joined.withColumn("change_reason", reason).filter("change_reason is not null").drop("_before")


def outcome_status(status_code: Column, succeeded: Column) -> Column:
    """succeeded, terminal_404 for a 404, failed for the rest."""
    return F.when(succeeded, "succeeded").when(status_code == 404, "terminal_404").otherwise("failed")


def refetch_reason(ttl_cutoff: Column) -> Column:
    """first_seen, short_changed, ttl_refresh or null, from the state and the hash of other runs."""
    changed = F.coalesce(F.col("previous_short_hash") != F.col("last_short_hash"), F.lit(False))
    fetched = F.col("last_detail_fetched_at")
    gone = F.coalesce(F.col("detail_fetch_status") == "terminal_404", F.lit(False))
    open_ = fetched.isNull() | ~F.coalesce(F.col("detail_fetch_status").isin(*FETCH_CLOSED), F.lit(False))
    return (
        F.when(~gone & open_, "first_seen")
        .when(changed, "short_changed")
        .when(fetched <= ttl_cutoff, "ttl_refresh")
    )


def append_unique(existing: DataFrame, incoming: DataFrame, unique: list[str], arrival: list[str]) -> DataFrame:
    """New rows to append: first arrival per unique key that is not stored yet."""
    from sightline.operators.latest import earliest_per_key

    fresh = earliest_per_key(incoming, unique, arrival).select(*incoming.columns)
    return fresh.join(existing.select(*unique), unique, "left_anti").select(*incoming.columns)


def attempt_lifecycle(starts: DataFrame, finishes: DataFrame, attempt_id: str = "id") -> DataFrame:
    """Attempts with the outcome of their finish record; those without one are still running."""
    return starts.join(finishes, attempt_id, "left").withColumn(
        "status", F.coalesce("status", F.lit("running"))
    )
