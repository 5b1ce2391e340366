"""Refetch backlog: who waits, who is ready, in which order, and how it changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON_RANK = {"first_seen": 0, "short_changed": 1, "ttl_refresh": 2}
MAX_BACKOFF_EXPONENT = 16


def in_first_backlog(include_inactive: bool = False) -> Column:
    """States still owed a first detail. Null statuses and times count as not done."""
    done = F.coalesce(
        (F.col("detail_fetch_status") == "succeeded") & F.col("last_detail_fetched_at").isNotNull(), F.lit(False)
    ) | F.coalesce(F.col("detail_fetch_status") == "terminal_404", F.lit(False))
    waiting = ~done
    if not include_inactive:
        waiting = waiting & F.coalesce(~F.col("is_probably_inactive"), F.lit(False))
    return waiting


def retry_ready(
    now: Column, base_seconds: int, max_seconds: int, attempt: str = "attempt", attempted_at: str = "attempted_at"
) -> Column:
    """Exponential back-off after a failed attempt; no failed attempt or no base means ready."""
    if base_seconds <= 0:
        return F.lit(True)
    exponent = F.least(F.greatest(F.col(attempt) - 1, F.lit(0)), F.lit(MAX_BACKOFF_EXPONENT))
    wait = F.least(F.lit(float(max_seconds)), F.lit(float(base_seconds)) * F.pow(F.lit(2.0), exponent))
    due = F.col(attempted_at) + F.make_interval(secs=wait.cast("int"))
    return F.col(attempted_at).isNull() | (due <= now)


def lease_ready(now: Column, expires: str = "first_detail_lease_expires_at") -> Column:
    return F.col(expires).isNull() | (F.col(expires) <= now)


def with_latest_failure(states: DataFrame, failures: DataFrame, key: str = "vacancy_id") -> DataFrame:
    """States with attempt number and time of the latest failed attempt, if there is one."""
    return states.join(failures.select(key, "attempt", "attempted_at"), key, "left")


def backlog_order() -> list[Column]:
    return [F.asc("first_seen_at"), F.desc("last_seen_at"), F.asc("vacancy_id")]


def ready_backlog(
    states: DataFrame, now: Column, base_seconds: int, max_seconds: int, include_inactive: bool = False
) -> DataFrame:
    """Backlog rows whose retry wait is over and that nobody holds; ``states`` carries the latest failure."""
    free = retry_ready(now, base_seconds, max_seconds) & lease_ready(now)
    return states.filter(in_first_backlog(include_inactive) & free)


def claim_batch(
    states: DataFrame, ready: DataFrame, batch: int, owner: str, now: Column, lease_seconds: int
) -> DataFrame:
    """The state table after the first ``batch`` ready rows are claimed."""
    chosen = ready.orderBy(*backlog_order()).limit(max(batch, 0))
    marked = states.join(
        chosen.select("vacancy_id", F.lit(True).alias("_claimed")), "vacancy_id", "left"
    )
    claimed = F.col("_claimed").isNotNull()
    held_by = F.col("first_detail_lease_owner") if "first_detail_lease_owner" in states.columns else F.lit(None)
    return (
        marked.withColumn("detail_fetch_status", F.when(claimed, "running").otherwise(F.col("detail_fetch_status")))
        .withColumn("first_detail_lease_owner", F.when(claimed, owner).otherwise(held_by))
        .withColumn(
            "first_detail_lease_expires_at",
            F.when(claimed, now + F.make_interval(secs=F.lit(lease_seconds))).otherwise(
                F.col("first_detail_lease_expires_at")
            ),
        )
        .drop("_claimed")
    )


def backlog_sizes(states: DataFrame, now: Column, base_seconds: int, max_seconds: int) -> DataFrame:
    """Total, ready and cooling-down rows for the active and the whole scope, in one pass."""
    ready = retry_ready(now, base_seconds, max_seconds) & lease_ready(now)
    aggs = []
    for scope, inactive in (("active", False), ("all", True)):
        waiting = in_first_backlog(inactive)
        aggs += [F.count_if(waiting).alias(f"{scope}_n"), F.count_if(waiting & ready).alias(f"{scope}_r")]
    rows = states.agg(*aggs).select(
        F.expr("stack(2, 'active', active_n, active_r, 'all', all_n, all_r) as (scope, backlog_size, ready_size)")
    )
    cooling = F.greatest(F.col("backlog_size") - F.col("ready_size"), F.lit(0))
    return rows.withColumn("cooldown_size", cooling)


def last_seen_in(states: DataFrame, run_id: str) -> DataFrame:
    """The states whose latest sighting belongs to this run: the candidates of the run."""
    return states.filter(F.col("last_seen_run_id") == run_id)


def refetch_selection(candidates: DataFrame, limit: int, run_id: str | None = None) -> DataFrame:
    """The most urgent candidates, of one run if it is named: by reason, latest sighting to the second, then id."""
    if run_id is not None:
        candidates = last_seen_in(candidates, run_id)
    rank = F.lit(len(REASON_RANK))
    for reason, value in REASON_RANK.items():
        rank = F.when(F.col("reason") == reason, value).otherwise(rank)
    ordered = candidates.filter("reason is not null").withColumn("_rank", rank)
    return (
        ordered.orderBy("_rank", F.desc(F.date_trunc("second", "last_seen_at")), "vacancy_id")
        .limit(max(limit, 0))
        .drop("_rank")
    )


def refetch_counts(candidates: DataFrame, limit: int) -> DataFrame:
    """Candidates per reason, and how many the limit leaves out."""
    one = candidates.agg(*[F.count_if(F.col("reason") == r).alias(r) for r in REASON_RANK])
    total = sum((F.col(r) for r in REASON_RANK), F.lit(0))
    return one.withColumn("skipped_due_to_limit", F.greatest(total - max(limit, 0), F.lit(0)).cast("long"))


def outcome_counts(attempts: DataFrame, by: list[str]) -> DataFrame:
    """Attempts that succeeded, ended for good, or failed."""
    return attempts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("selected_count"),
        F.count_if(F.col("status") == "succeeded").alias("detail_fetch_succeeded"),
        F.count_if(F.col("status") == "terminal_404").alias("detail_fetch_terminal"),
        F.count_if(F.col("status") == "failed").alias("detail_fetch_failed"),
    )


def repaired_counts(before: DataFrame, after: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Backlog rows before and after a repair, and those gone in between."""
    marked = before.select(*keys).join(after.select(*keys, F.lit(True).alias("_left")), keys, "left")
    return marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("backlog_before"),
        F.count("_left").alias("backlog_after"),
        F.count_if(F.col("_left").isNull()).alias("repaired"),
    )


def metric_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two (metric, value) frames side by side; a missing metric counts as 0."""
    b = before.select("metric", F.col("value").alias("before_value"))
    a = after.select("metric", F.col("value").alias("after_value"))
    joined = b.join(a, "metric", "full_outer").na.fill(0, ["before_value", "after_value"])
    return joined.withColumn("delta", F.col("after_value") - F.col("before_value"))


def lease_health(states: DataFrame, now: Column) -> DataFrame:
    expires = F.col("first_detail_lease_expires_at")
    return states.agg(
        F.count_if(expires > now).alias("active_leases"),
        F.count_if(expires <= now).alias("expired_leases"),
        F.count_if(F.col("detail_fetch_status") == "failed").alias("failed_rows"),
    )


def gate_scalars(runs: DataFrame, states: DataFrame, run_type: str, now: Column) -> DataFrame:
    """One row for a start gate: open runs, backlog sizes and the last success of a run type."""
    waiting = in_first_backlog(False)
    s = states.agg(
        F.count_if(waiting).alias("backlog"), F.count_if(waiting & lease_ready(now)).alias("ready_backlog")
    )
    good = (F.col("run_type") == run_type) & (F.col("status") == "succeeded")
    last = F.max(F.when(good, F.col("finished_at")))
    r = runs.agg(F.count_if(F.col("status") == "created").alias("active_runs"), last.alias("_last"))
    return r.select(
        "active_runs",
        s.select("backlog").scalar().alias("backlog"),
        s.select("ready_backlog").scalar().alias("ready_backlog"),
        F.coalesce(F.unix_seconds(F.col("_last").cast("timestamp")), F.lit(0)).alias("last_success_epoch"),
        F.coalesce(F.date_format("_last", "yyyy-MM-dd HH:mm:ss"), F.lit("-")).alias("last_success_at"),
    )
