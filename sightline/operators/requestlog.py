"""Request-log analytics: sessions, first blocks, percentiles, counters, windows and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions import json_ops as j
from sightline.functions.scalars import CAPTCHA, endpoint_kind, endpoint_template, status_class
from sightline.operators.segments import exact_percentiles, with_lag, with_ordered, with_running

# Upper bounds of the duration histogram, in seconds.
DURATION_BUCKETS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0)


def seconds_between(earlier: Column, later: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.when(micros < 0, 0.0).otherwise(micros / F.lit(1e6))


def annotate(log: DataFrame, session: list[str], at: str, row_id: str) -> DataFrame:
    """Request index, gap to the previous request, first captcha so far and minutes since it."""
    captcha_at = F.when(F.col("error_type") == CAPTCHA, F.col(at))
    running = {"request_index": ("rows", F.lit(1)), "first_captcha_at": ("min", captcha_at)}
    lagged = with_ordered(log, session, [at, row_id], {"_previous_at": at}, running)
    since = F.col("first_captcha_at")
    minutes = F.when(F.col(at) >= since, F.round(seconds_between(since, F.col(at)) / 60, 3))
    return lagged.withColumns(
        {
            "seconds_since_previous": F.round(seconds_between(F.col("_previous_at"), F.col(at)), 6),
            "minutes_since_first_captcha": minutes,
        }
    ).drop("_previous_at")


def with_first(log: DataFrame, session: list[str], at: str, row_id: str, firsts: dict[str, Column]) -> DataFrame:
    """Attach, per session, the (time, id) of the first row that meets each condition.

    One combinable aggregate and one join, so a long session is never sorted in one task.
    """
    here = F.struct(F.col(at), F.col(row_id))
    found = log.groupBy(*session).agg(*[F.min(F.when(c, here)).alias(n) for n, c in firsts.items()])
    return log.join(found, session, "left").withColumn("_here", here)


def prefix_before_first(
    log: DataFrame, session: list[str], at: str, row_id: str, stop: Column, include: bool = False
) -> DataFrame:
    """Rows of each session before (or up to) the first stop row; whole sessions without one."""
    marked = with_first(log, session, at, row_id, {"_stop": stop})
    inside = F.col("_here") <= F.col("_stop") if include else F.col("_here") < F.col("_stop")
    return marked.filter(F.col("_stop").isNull() | inside).select(*log.columns)


def session_summary(log: DataFrame, session: list[str], at: str, row_id: str) -> DataFrame:
    """Successes before and after the first 403, when it came, and the last success before it."""
    code = F.col("status_code")
    marked = with_first(
        log, session, at, row_id, {"_f403": code == 403, "_fcap": F.col("error_type") == CAPTCHA}
    )
    here, f403 = F.col("_here"), F.col("_f403")
    before = f403.isNull() | (here < f403)
    after = here > f403
    good = code == 200
    g = marked.groupBy(*session).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.min(at).alias("window_started_at"),
        F.max(at).alias("window_finished_at"),
        F.count_if(good & before).alias("ok_before_first_403"),
        F.count_if(good & after).alias("ok_after_first_403"),
        F.count_if((code == 403) & after).alias("forbidden_after_first_403"),
        F.max(F.when(f403.isNotNull() & good & (here < f403), here)).alias("_last_ok"),
        F.first("_f403").alias("_f403"),
        F.first("_fcap").alias("_fcap"),
        F.count_if(here <= f403).alias("_n403"),
        F.count_if(here <= F.col("_fcap")).alias("_ncap"),
    )
    start = F.col("window_started_at")
    return g.select(
        *session, "total_requests", "window_started_at", "window_finished_at",
        "ok_before_first_403", "ok_after_first_403", "forbidden_after_first_403",
        F.when(F.col("_f403").isNotNull(), F.col("_n403")).alias("requests_until_first_403"),
        F.when(F.col("_fcap").isNotNull(), F.col("_ncap")).alias("requests_until_first_captcha"),
        F.round(seconds_between(start, F.col(f"_f403.{at}")), 6).alias("seconds_until_first_403"),
        F.col(f"_last_ok.{row_id}").alias("last_success_id"),
        F.col(f"_f403.{row_id}").alias("first_403_id"),
    )


def status_counts(log: DataFrame, by: list[str]) -> DataFrame:
    return log.groupBy(*by, "status_code").agg(F.count(F.lit(1)).alias("request_count"))


def endpoint_breakdown(annotated: DataFrame, by: list[str]) -> DataFrame:
    """Requests per endpoint kind and the session index of its first captcha."""
    rows = annotated.withColumn("endpoint_kind", endpoint_kind(F.col("endpoint")))
    index = F.min(F.when(F.col("error_type") == CAPTCHA, F.col("request_index")))
    return rows.groupBy(*by, "endpoint_kind").agg(
        F.count(F.lit(1)).alias("requests"), index.alias("first_captcha_request_index")
    )


def search_only(log: DataFrame, session: list[str], at: str, row_id: str) -> DataFrame:
    """First captcha counted in search requests only, successes before it, and detail statuses."""
    rows = log.withColumn("_kind", endpoint_kind(F.col("endpoint")))
    search, code = F.col("_kind") == "search", F.col("status_code")
    marked = with_first(rows, session, at, row_id, {"_cap": search & (F.col("error_type") == CAPTCHA)})
    here, cap = F.col("_here"), F.col("_cap")
    g = marked.groupBy(*session).agg(
        F.count_if(search & (code == 200) & (cap.isNull() | (here < cap))).alias("search_ok_before_first_captcha"),
        F.count_if(search & (here <= cap)).alias("_n"),
        F.first(cap).alias("_cap"),
        F.count_if((F.col("_kind") == "detail") & (code == 200)).alias("detail_200_count"),
        F.count_if((F.col("_kind") == "detail") & (code == 403)).alias("detail_403_count"),
    )
    index = F.when(F.col("_cap").isNotNull(), F.col("_n"))
    return g.withColumn("first_search_captcha_index", index).drop("_n", "_cap")


def session_aggregate(slots: DataFrame, by: list[str]) -> DataFrame:
    """Outcome of seed and recovery runs over the slots of a session."""
    seed, rec = F.col("seed_search_ok"), F.col("recovery_search_ok")
    return slots.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_slots"),
        F.count_if(F.col("status") == "completed").alias("completed_slots"),
        F.count_if(F.col("status") == "aborted").alias("aborted_slots"),
        F.count_if("seed_clean").alias("seed_clean_count"),
        F.count_if("recovery_clean").alias("recovery_clean_count"),
        F.count_if(rec > seed).alias("recovery_better_than_seed_count"),
        F.round(F.avg("seed_attempts"), 2).alias("avg_seed_gate_attempts"),
        F.round(F.avg("recovery_attempts"), 2).alias("avg_recovery_gate_attempts"),
        F.min(seed).alias("min_seed_search_ok"),
        F.max(seed).alias("max_seed_search_ok"),
        F.min(rec).alias("min_recovery_search_ok"),
        F.max(rec).alias("max_recovery_search_ok"),
        F.min_by("window_label", F.when(F.col("recovery_clean"), F.col("slot_no"))).alias("first_clean_window"),
    )


def first_seen_ids(pages: DataFrame, order: list[str], items: str, n: int) -> DataFrame:
    """Distinct item ids in the order of first appearance, the first n."""
    rows = pages.select(*order, F.posexplode(items).alias("_pos", "item_id"))
    first = rows.groupBy("item_id").agg(F.min(F.struct(*order, "_pos")).alias("_first"))
    return first.orderBy("_first").limit(n).select("item_id", *[F.col("_first")[c].alias(c) for c in order])


def replay_sequence(log: DataFrame, payloads: DataFrame) -> DataFrame:
    """Log with what its payload says: found, pages, number of items, first error."""
    v = F.col("_v")
    p = payloads.select("api_request_log_id", "payload_json")
    joined = log.join(p, log["id"] == p["api_request_log_id"], "left").withColumn("_v", j.parse("payload_json"))
    return joined.select(
        *[log[c] for c in log.columns],
        j.optional_int(v, "$.found").alias("found"),
        j.optional_int(v, "$.pages").alias("pages"),
        F.size(F.try_variant_get(v, "$.items", "array<variant>")).alias("items_count"),
        j.api_error(v)["error_type"].alias("payload_error_type"),
    )


def overlap_summary(rows: DataFrame, item: str, role: str) -> DataFrame:
    """How many items carry several roles. ``rows`` is long: one row per (item, role)."""
    per_item = rows.groupBy(item).agg(F.count_distinct(role).alias("_n"))
    out = per_item.agg(
        F.count(F.lit(1)).alias("sampled_items"),
        F.count_if(F.col("_n") > 1).alias("multi_role_items"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("max_roles_per_item"),
    )
    share = F.when(F.col("sampled_items") == 0, 0.0).otherwise(F.col("multi_role_items") / F.col("sampled_items"))
    return out.withColumn("multi_role_share", F.round(share, 4))


def role_hits(rows: DataFrame, role: str, name: str, order: list[str]) -> DataFrame:
    """Hits per role, repeats inside an item included, with its first name."""
    usable = F.when(F.coalesce(F.col(name), F.lit("")) != "", F.struct(*order))
    return rows.groupBy(role).agg(
        F.count(F.lit(1)).alias("sample_hits"), F.min_by(name, usable).alias("role_name")
    )


def top_roles(hits: DataFrame, role: str, n: int) -> DataFrame:
    return hits.orderBy(F.desc("sample_hits"), role).limit(n)


def assess_dimensions(results: DataFrame, by: str, multi_role_items: Column) -> DataFrame:
    """Per area: best page count of each split dimension, what it saves, and the one to prefer."""

    def of(dimension: str, value: Column) -> Column:
        return F.when(F.col("dimension") == dimension, value)

    ok = F.col("status_code") == 200
    g = results.groupBy(by).agg(
        F.min(of("baseline", F.col("pages"))).alias("baseline_pages"),
        F.min(of("time_window", F.col("pages"))).alias("time_best_pages"),
        F.min(of("professional_role", F.col("pages"))).alias("role_best_pages"),
        F.coalesce(F.bool_and(of("time_window", ok)), F.lit(True)).alias("time_supported"),
        F.coalesce(F.bool_and(of("professional_role", ok)), F.lit(True)).alias("role_supported"),
    )
    prefer = F.when((multi_role_items > 0) | F.col("time_best_pages").isNotNull(), "time_window").otherwise("undecided")
    return g.withColumns(
        {
            "time_reduction": F.col("baseline_pages") - F.col("time_best_pages"),
            "role_reduction": F.col("baseline_pages") - F.col("role_best_pages"),
            "preferred_first_fallback": prefer,
        }
    )


def request_counters(log: DataFrame) -> DataFrame:
    return log.groupBy(
        endpoint_template(F.col("endpoint")).alias("endpoint"),
        status_class(F.col("status_code"), F.col("error_type")).alias("status_class"),
    ).agg(F.count(F.lit(1)).alias("request_count"))


def duration_histogram(log: DataFrame, by: list[str], seconds: Column) -> DataFrame:
    """Cumulative buckets per group in long form; the last bound is infinite."""
    bounds = [*DURATION_BUCKETS, float("inf")]
    value = F.col("_seconds")
    wide = log.withColumn("_seconds", seconds).groupBy(*by).agg(
        F.round(F.sum(value), 4).alias("duration_sum"),
        *[F.count_if(value <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
    )
    cells = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("bucket_count")) for i, b in enumerate(bounds)])
    return wide.select(*by, "duration_sum", F.col(f"b{len(bounds) - 1}").alias("duration_count"), F.inline(cells))


def histogram_quantile(buckets: DataFrame, by: list[str], q: float) -> DataFrame:
    """Quantile by linear interpolation inside the bucket that holds the rank."""
    w = Window.partitionBy(*by).orderBy("le")  # a group is one histogram: ten rows
    rows = buckets.select(
        *by, "le", "bucket_count",
        F.lag("le", 1, 0.0).over(w).alias("_low"),
        F.lag("bucket_count", 1, 0).over(w).alias("_below"),
        F.max("bucket_count").over(Window.partitionBy(*by)).alias("_total"),
    )
    rank = F.lit(q) * F.col("_total")
    hit = rows.filter((F.col("bucket_count") >= rank) & (F.col("_total") > 0)).groupBy(*by).agg(
        F.min_by(F.struct("le", "_low", "_below", "bucket_count", "_total"), "le").alias("_b")
    )
    b = F.col("_b")
    inside = b["_low"] + (b["le"] - b["_low"]) * (F.lit(q) * b["_total"] - b["_below"]) / (b["bucket_count"] - b["_below"])
    value = F.when(b["le"] == float("inf"), b["_low"]).otherwise(inside)
    return hit.select(*by, F.round(value, 6).alias("quantile_value"))


def interval_counts(log: DataFrame, at: str, length: str, by: list[Column], slide: str | None = None) -> DataFrame:
    """Requests and errors per time window."""
    w = F.window(F.col(at), length, slide) if slide else F.window(F.col(at), length)
    return log.groupBy(w.alias("w"), *by).agg(
        F.count(F.lit(1)).alias("request_count"), F.count_if(F.col("status_code") >= 400).alias("error_count")
    ).withColumns({"window_start": F.col("w.start")}).drop("w")


def operation_summary(ops: DataFrame, by: list[str], at: str) -> DataFrame:
    ok = F.col("succeeded")
    return ops.groupBy(*by).agg(
        F.count_if(ok).alias("succeeded_count"),
        F.count_if(~ok).alias("failed_count"),
        F.max(F.when(ok, F.col(at))).alias("last_success_at"),
        F.sum(F.when(ok, F.col("records_written")).otherwise(0)).alias("records_written"),
    )


# How old the last success of an operation may be, in seconds.
FRESHNESS_LIMITS = (
    ("reconcile_run", 604800),
    ("triggered_run", 691200),
    ("housekeeping", 604800),
    ("backup", 259200),
)


def freshness_violations(last_success: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """Operations whose last success is older than their rule allows."""
    age = F.greatest(
        F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last_success_at").cast("timestamp")), F.lit(0)
    )
    aged = last_success.withColumn("age_seconds", age)
    return aged.join(rules, "operation").filter(F.col("age_seconds") > F.col("max_age_seconds"))


def windows_above(counts: DataFrame, column: str, threshold: int) -> DataFrame:
    return counts.filter(F.col(column) > threshold)


def unless(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows whose key does not occur on the right."""
    return left.join(right.select(*keys), keys, "left_anti")


def held_for(
    violations: DataFrame, series: list[str], at: str, step_seconds: int, hold_seconds: int
) -> DataFrame:
    """Runs of consecutive violating windows that lasted long enough to fire."""
    slot = F.expr(f"unix_seconds(cast(`{at}` as timestamp)) div {step_seconds}")
    rows = violations.select(*series, slot.alias("_slot")).distinct()
    numbered = with_running(rows, series, ["_slot"], {"_n": ("rows", F.lit(1))})
    islands = numbered.groupBy(*series, (F.col("_slot") - F.col("_n")).alias("_island")).agg(
        (F.min("_slot") * step_seconds).alias("from_epoch"), ((F.max("_slot") + 1) * step_seconds).alias("to_epoch")
    )
    lasted = F.col("to_epoch") - F.col("from_epoch")
    return islands.withColumn("held_seconds", lasted).filter(lasted >= hold_seconds).drop("_island")


def throughput(log: DataFrame, by: list[str], at: str, row_id: str, latency: str) -> DataFrame:
    """Requests per hour, and p50 / p95 of latency and of the gap between requests."""
    gaps = with_lag(log, by, [at, row_id], {"_previous_at": at}).withColumn(
        "_gap", seconds_between(F.col("_previous_at"), F.col(at))
    )
    span = seconds_between(F.col("_a"), F.col("_b"))
    base = log.groupBy(*by).agg(F.count(F.lit(1)).alias("request_count"), F.min(at).alias("_a"), F.max(at).alias("_b"))
    rate = F.round(F.when(span > 0, F.col("request_count") * 3600 / span), 1)
    lat = exact_percentiles(log, by, latency, {"latency_p50": 0.5, "latency_p95": 0.95})
    gap = exact_percentiles(gaps, by, "_gap", {"gap_p50": 0.5, "gap_p95": 0.95}, 3)
    return base.withColumn("requests_per_hour", rate).drop("_a", "_b").join(lat, by).join(gap, by)


def sweep_completeness(events: DataFrame, attempts: DataFrame, at: str = "seen_at") -> DataFrame:
    """Per sweep: new entities, detail outcome of those, and the delay to their first success."""
    first = events.groupBy("vacancy_id").agg(
        F.min_by("crawl_run_id", F.struct(at, "id")).alias("crawl_run_id"), F.min(at).alias("first_seen_at")
    )
    done = attempts.groupBy("vacancy_id").agg(
        F.min(F.when(F.col("status") == "succeeded", F.coalesce("finished_at", "requested_at"))).alias("first_success_at"),
        F.count_if(F.col("status") == "terminal_404").alias("_gone"),
    )
    joined = first.join(done, "vacancy_id", "left")
    lag = seconds_between(F.col("first_seen_at"), F.col("first_success_at"))
    rows = joined.withColumns(
        {"_lag": F.when(F.col("first_success_at").isNotNull(), lag),
         "_ok": F.col("first_success_at").isNotNull(),
         "_lost": F.col("first_success_at").isNull() & (F.coalesce("_gone", F.lit(0)) > 0)}
    )
    base = rows.groupBy("crawl_run_id").agg(
        F.count(F.lit(1)).alias("new_vacancies"),
        F.count_if("_ok").alias("first_detail_succeeded"),
        F.count_if("_lost").alias("gone_before_detail"),
    )
    rate = F.round(F.col("first_detail_succeeded") / F.col("new_vacancies"), 4)
    lags = exact_percentiles(rows, ["crawl_run_id"], "_lag", {"detail_lag_p50": 0.5, "detail_lag_p95": 0.95})
    return base.withColumn("first_detail_success_rate", rate).join(lags, "crawl_run_id", "left")
