"""Search-space coverage: partition trees, splitting, statuses and run decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions import json_ops as j
from sightline.operators.hierarchy import with_root_flag

SATURATION_PAGES = 100
FALLBACK_WINDOW_START = 946684800  # 2000-01-01T00:00:00Z
MIN_SPLIT_SECONDS = 2
POLICY = "area_exhaustive_v2"
POLICY_VERSION = "v2"
LIST_PAGE_SIZE = 20
RUNNABLE = ("pending", "running", "done")
RESUMABLE = ("created", "completed_with_unresolved", "failed")


def is_saturated(pages: Column, threshold: int = SATURATION_PAGES) -> Column:
    return F.coalesce(F.greatest(pages, F.lit(0)) >= threshold, F.lit(False))


def saturation_reason(pages: Column, threshold: int = SATURATION_PAGES) -> Column:
    shown = F.greatest(pages, F.lit(0)).cast("string")
    return F.when(
        is_saturated(pages, threshold), F.concat(F.lit("too many pages: "), shown, F.lit(f" >= {threshold}"))
    )


def coverage_summary(partitions: DataFrame, run: str = "crawl_run_id") -> DataFrame:
    """Counts per run; a row may count in several of them."""
    status, cover = F.col("status"), F.col("coverage_status")
    rooted = with_root_flag(partitions, "id", "parent_partition_id", [run])
    out = rooted.groupBy(run).agg(
        F.count(F.lit(1)).alias("total_partitions"),
        F.count_if("is_root").alias("root_partitions"),
        F.count_if("is_terminal").alias("terminal_partitions"),
        F.count_if(F.col("is_terminal") & (cover == "covered")).alias("covered_terminal_partitions"),
        F.count_if(status == "pending").alias("pending_partitions"),
        F.count_if(F.col("is_terminal") & (status == "pending")).alias("pending_terminal_partitions"),
        F.count_if(status == "running").alias("running_partitions"),
        F.count_if(status.isin("split_required", "split_done") | cover.isin("saturated", "split")).alias("split_partitions"),
        F.count_if((status == "unresolved") | (cover == "unresolved")).alias("unresolved_partitions"),
        F.count_if(status == "failed").alias("failed_partitions"),
    )
    terminal, covered = F.col("terminal_partitions"), F.col("covered_terminal_partitions")
    ratio = F.when(terminal > 0, covered / terminal).otherwise(0.0)
    full = (terminal > 0) & (covered == terminal)
    for left in ("pending_terminal_partitions", "running_partitions", "unresolved_partitions", "failed_partitions"):
        full = full & (F.col(left) == 0)
    return out.withColumns({"coverage_ratio": ratio, "is_fully_covered": full})


def stage_status(summary: DataFrame) -> DataFrame:
    """Decision of the list stage, in fixed order; null while work is left."""
    decision = (
        F.when(F.col("is_fully_covered"), "completed")
        .when(F.col("failed_partitions") > 0, "failed")
        .when(F.col("unresolved_partitions") > 0, "completed_with_unresolved")
        .when((F.col("pending_terminal_partitions") == 0) & (F.col("running_partitions") == 0), "failed")
    )
    return summary.withColumn("stage_status", decision)


def resumable(runs: DataFrame, summary: DataFrame, run: str = "crawl_run_id") -> DataFrame:
    """Runs with the decision whether they may be resumed and why not."""
    joined = runs.join(summary, run, "left").na.fill(0)
    nothing_left = F.lit(True)
    for c in ("failed_partitions", "unresolved_partitions", "pending_terminal_partitions", "running_partitions"):
        nothing_left = nothing_left & (F.col(c) == 0)
    full = F.coalesce(F.col("is_fully_covered"), F.lit(False))
    refused = (
        F.when(~F.col("run_status").isin(*RESUMABLE), F.concat(F.lit("status="), F.col("run_status")))
        .when((F.col("run_status") == "failed") & nothing_left & ~full, F.lit("failed run has nothing to resume"))
    )
    return joined.withColumn("refused_reason", refused).withColumn("can_resume", F.col("refused_reason").isNull())


def runnable(partitions: DataFrame) -> DataFrame:
    """Reason why a partition cannot be processed; null for a runnable one."""
    reason = (
        F.when(F.col("planner_policy_version") != POLICY_VERSION, F.concat(F.lit("policy version "), "planner_policy_version"))
        .when(~F.col("is_terminal"), "partition is not terminal")
        .when(F.col("coverage_status") == "covered", "partition is already covered")
        .when(~F.col("status").isin(*RUNNABLE), F.concat(F.lit("status="), F.col("status")))
    )
    return partitions.withColumn("refused_reason", reason)


def pending_terminal(partitions: DataFrame) -> DataFrame:
    return partitions.filter(F.col("is_terminal") & (F.col("status") == "pending"))


def completion_counts(partitions: DataFrame, run: str = "crawl_run_id") -> DataFrame:
    status = F.col("status")
    return partitions.groupBy(run).agg(
        F.count(F.lit(1)).alias("partitions_total"),
        F.count_if(status.isin("done", "split_done")).alias("partitions_done"),
        F.count_if(status.isin("failed", "unresolved")).alias("partitions_failed"),
    )


def requeue(partitions: DataFrame, from_status: str) -> DataFrame:
    """Put failed or unresolved terminal partitions back: pending, unassessed, one more retry."""
    hit = F.col("is_terminal") & (F.col("status") == from_status)
    return partitions.withColumns(
        {
            "status": F.when(hit, "pending").otherwise(F.col("status")),
            "coverage_status": F.when(hit, "unassessed").otherwise(F.col("coverage_status")),
            "retry_count": (F.col("retry_count") + F.when(hit, 1).otherwise(0)).cast("int"),
            "requeued": hit,
        }
    )


def partition_totals(pages: DataFrame, by: list[str]) -> DataFrame:
    """Page log per partition: attempts, distinct vacancies over good pages, the first failure."""
    ok = ~F.col("failed")
    order = F.struct("page_at", "id")
    return pages.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pages_attempted"),
        F.count_if(ok).alias("pages_processed"),
        F.count_distinct(F.when(ok, F.col("vacancy_id"))).alias("vacancies_found"),
        F.count_if(ok & F.col("created")).alias("vacancies_created"),
        F.min_by("error_type", F.when(~ok, order)).alias("first_error_type"),
        F.min(F.when(~ok, F.col("page_at"))).alias("first_failure_at"),
    )


def stage_totals(partition_rows: DataFrame, by: list[str]) -> DataFrame:
    failed = F.col("first_failure_at").isNotNull()
    return partition_rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("partitions_attempted"),
        F.count_if(~failed).alias("partitions_completed"),
        F.count_if(failed).alias("partitions_failed"),
        F.sum("pages_attempted").alias("pages_attempted"),
        F.sum("pages_processed").alias("pages_processed"),
        F.sum("vacancies_found").alias("vacancies_found"),
        F.sum("vacancies_created").alias("vacancies_created"),
    )


def roll_up_status(pages: DataFrame, key: list[str], threshold: int = SATURATION_PAGES) -> DataFrame:
    """Partition status after its pages: failed, split_required, done or still pending."""
    order = F.struct("page_at", "id")
    g = pages.groupBy(*key).agg(
        F.count_if(~F.col("failed")).alias("pages_processed"),
        F.bool_or("failed").alias("_failed"),
        F.min_by("pages_total_expected", F.when(~F.col("failed"), order)).alias("pages_total_expected"),
    )
    wanted = F.greatest(F.coalesce("pages_total_expected", F.lit(0)), F.lit(1))
    saturated = is_saturated(F.col("pages_total_expected"), threshold)
    status = (
        F.when(saturated, "split_required")
        .when(F.col("_failed"), "failed")
        .when(F.col("pages_processed") >= wanted, "done")
        .otherwise("pending")
    )
    cover = F.when(saturated, "saturated").when(status == "done", "covered").otherwise("unassessed")
    return g.select(*key, "pages_processed", "pages_total_expected", status.alias("status"), cover.alias("coverage_status"))


# What each event of a partition's life sets. Null means: leave as it is.
TRANSITIONS = (
    # event, status, is_terminal, is_saturated, coverage_status, finishes
    ("running", "running", None, None, None, False),
    ("pending", "pending", None, None, None, False),
    ("covered", "done", True, False, "covered", True),
    ("split_required", "split_required", False, True, "saturated", False),
    ("split_done", "split_done", False, True, "split", True),
    ("unresolved", "unresolved", True, True, "unresolved", True),
    ("failed", "failed", None, None, None, True),
)
TRANSITION_SCHEMA = (
    "event string, new_status string, sets_terminal boolean, sets_saturated boolean, "
    "sets_coverage string, finishes boolean"
)


def partition_states(events: DataFrame, key: str = "partition_id") -> DataFrame:
    """State of each partition from its events: status of the last, flags of the last that set them."""
    table = events.sparkSession.createDataFrame(list(TRANSITIONS), TRANSITION_SCHEMA)
    e = events.join(F.broadcast(table), "event")  # seven fixed rows
    order = F.struct("at", "id")

    def last_set(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), order))

    starts = F.col("event").isin("running", "failed")
    out = e.groupBy(key).agg(
        F.max_by("new_status", order).alias("status"),
        last_set("sets_terminal").alias("is_terminal"),
        last_set("sets_saturated").alias("is_saturated"),
        last_set("sets_coverage").alias("coverage_status"),
        F.min(F.when(starts, F.col("at"))).alias("started_at"),
        F.max_by(F.when(F.col("finishes"), F.col("at")), order).alias("finished_at"),
        F.max_by(F.when(F.col("event").isin("failed", "unresolved"), F.col("error")), order).alias("last_error_message"),
    )
    return out.withColumns(
        {
            "is_terminal": F.coalesce("is_terminal", F.lit(True)),
            "is_saturated": F.coalesce("is_saturated", F.lit(False)),
            "coverage_status": F.coalesce("coverage_status", F.lit("unassessed")),
        }
    )


def area_scope_key(area: Column) -> Column:
    return F.concat(F.lit("area:"), F.trim(area))


def _utc_text(seconds: Column, pattern: str) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), pattern)


def window_scope_key(area: Column, start: Column, end: Column) -> Column:
    compact = "yyyyMMdd'T'HHmmss'Z'"
    return F.concat_ws(":", F.lit("time_window"), F.trim(area), _utc_text(start, compact), _utc_text(end, compact))


def window_text(seconds: Column) -> Column:
    return F.concat(_utc_text(seconds, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def area_partitions(
    areas: DataFrame, run_type: str, parent: Column | None = None, depth: Column | None = None,
    per_page: int = LIST_PAGE_SIZE,
) -> DataFrame:
    """Partition plan rows for areas, with the parameters as JSON."""
    level = F.coalesce(depth, F.lit(0)) if depth is not None else F.lit(0)
    key = area_scope_key(F.col("hh_area_id"))
    scope = F.struct(
        F.lit("area").alias("dimension"), key.alias("scope_key"), "hh_area_id",
        F.col("name").alias("area_name"), "path_text", level.alias("depth"),
    )
    params = F.struct(F.col("hh_area_id").alias("area"), F.lit(0).alias("page"), F.lit(per_page).alias("per_page"))
    body = F.struct(
        F.lit(POLICY).alias("planner_policy"), F.lit(POLICY_VERSION).alias("planner_policy_version"),
        scope.alias("scope"), params.alias("params"), F.lit(run_type).alias("run_type"),
    )
    return areas.select(
        (parent if parent is not None else F.lit(None).cast("string")).alias("parent_partition_id"),
        key.alias("partition_key"),
        key.alias("scope_key"),
        level.cast("int").alias("depth"),
        F.lit("area").alias("split_dimension"),
        F.col("hh_area_id").alias("split_value"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("params_json"),
    )


def split_to_areas(saturated: DataFrame, areas: DataFrame, run_type: str) -> DataFrame:
    """Children of saturated area partitions: one per active child area."""
    from sightline.operators.hierarchy import active_children

    kids = active_children(areas)
    parents = saturated.select(
        F.col("id").alias("_parent"), F.col("depth").alias("_depth"), F.col("area").alias("parent_hh_area_id")
    )
    joined = kids.join(parents, "parent_hh_area_id")
    return area_partitions(joined, run_type, F.col("_parent"), F.col("_depth") + 1)


def window_partitions(halves: DataFrame, run_type: str, per_page: int = LIST_PAGE_SIZE) -> DataFrame:
    """Partition plan rows for time windows of an area, with the parameters as JSON.

    ``halves``: parent_partition_id, depth, area, area_name, path_text, window_from, window_to (seconds, half-open).
    """
    area = F.trim("area")
    key = window_scope_key(F.col("area"), F.col("window_from"), F.col("window_to"))
    start, end = window_text(F.col("window_from")), window_text(F.col("window_to"))
    scope = F.struct(
        F.lit("time_window").alias("dimension"), key.alias("scope_key"), area.alias("hh_area_id"), "area_name", "path_text",
        F.col("depth").cast("int").alias("depth"), start.alias("date_from"), end.alias("date_to"),
    )
    params = F.struct(
        area.alias("area"), start.alias("date_from"), end.alias("date_to"), F.lit(0).alias("page"), F.lit(per_page).alias("per_page")
    )
    body = F.struct(
        F.lit(POLICY).alias("planner_policy"), F.lit(POLICY_VERSION).alias("planner_policy_version"),
        scope.alias("scope"), params.alias("params"), F.lit(run_type).alias("run_type"),
    )
    return halves.select(
        "parent_partition_id",
        key.alias("partition_key"),
        key.alias("scope_key"),
        F.col("depth").cast("int").alias("depth"),
        F.lit("time_window").alias("split_dimension"),
        F.concat_ws("|", start, end).alias("split_value"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("params_json"),
    )


def split_saturated(saturated: DataFrame, areas: DataFrame, run_type: str, run_started: Column) -> tuple[DataFrame, DataFrame]:
    """(plan rows of children, unresolved parents with a message) for saturated partitions.

    ``saturated``: id, depth, split_dimension, area, area_name, path_text, window_from, window_to. An area is split to its
    active children. An area without any, and a time window, is split into two halves of its window, which is by
    default that from the fallback start to the start of the run. A window too short to halve is unresolved, and so
    is a partition without an area or of another dimension.
    """
    from sightline.operators.hierarchy import active_children

    known = F.coalesce(F.col("split_dimension").isin("area", "time_window"), F.lit(False)) & F.col("area").isNotNull()
    able = saturated.filter(known)
    by_area = split_to_areas(able.filter("split_dimension = 'area'"), areas, run_type)
    parents = active_children(areas).select(F.col("parent_hh_area_id").alias("area")).distinct()
    leaves = able.filter("split_dimension = 'area'").join(parents, "area", "left_anti").select(*saturated.columns)
    windows = with_default_window(leaves.unionByName(able.filter("split_dimension = 'time_window'")), run_started)
    halves = bisected(windows).withColumns({"parent_partition_id": F.col("id"), "depth": F.col("depth") + 1})
    by_window = window_partitions(halves.filter("not unresolved"), run_type)
    span = F.concat_ws("..", window_text(F.col("window_from")), window_text(F.col("window_to")))
    short = halves.filter("unresolved").select(
        "parent_partition_id", F.concat(F.lit("window cannot be halved; area="), "area", F.lit(" interval="), span).alias("message")
    )
    unknown = saturated.filter(~known).select(F.col("id").alias("parent_partition_id"), F.lit("partition cannot be split").alias("message"))
    return by_area.unionByName(by_window), short.unionByName(unknown)


def bisected(windows: DataFrame, start: str = "window_from", end: str = "window_to") -> DataFrame:
    """Two half-open halves per window (whole seconds); too short a window is unresolved."""
    a, b = F.col(start), F.col(end)
    can = (b - a) >= MIN_SPLIT_SECONDS
    middle = a + F.expr(f"(`{end}` - `{start}`) div 2")
    halves = F.when(can, F.array(F.struct(a.alias("f"), middle.alias("t")), F.struct(middle.alias("f"), b.alias("t")))).otherwise(
        F.array(F.struct(a.alias("f"), b.alias("t")))
    )
    rows = windows.withColumn("unresolved", ~can).withColumn("_h", F.explode(halves))
    return rows.withColumns({start: F.col("_h.f"), end: F.col("_h.t")}).drop("_h")


def with_default_window(partitions: DataFrame, run_started: Column) -> DataFrame:
    """Window from the parameters, else from the fallback start to the start of the run."""
    return partitions.withColumns(
        {
            "window_from": F.coalesce("window_from", F.lit(FALLBACK_WINDOW_START).cast("long")),
            "window_to": F.coalesce("window_to", F.unix_seconds(run_started.cast("timestamp"))),
        }
    )


def new_children(existing: DataFrame, planned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, conflicts): known keys are skipped; one of another parent is a conflict."""
    keys = existing.select(
        "crawl_run_id", "partition_key", F.col("parent_partition_id").alias("_owner"), F.lit(True).alias("_known")
    )
    joined = planned.join(keys, ["crawl_run_id", "partition_key"], "left")
    fresh = joined.filter(F.col("_known").isNull()).drop("_owner", "_known")
    conflicts = joined.filter(
        F.col("_known").isNotNull() & ~F.col("_owner").eqNullSafe(F.col("parent_partition_id"))
    ).drop("_known").withColumnRenamed("_owner", "owner_partition_id")
    return fresh, conflicts


def _seconds(text: Column) -> Column:
    t = j.strip(text)
    zoned = F.when(t.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), t).otherwise(F.concat(t, F.lit("Z")))
    parsed = F.try_to_timestamp(zoned, F.lit("yyyy-MM-dd['T'][ ]HH:mm:ss[.SSSSSS][XXX][XX]"))
    return F.unix_seconds(parsed)


def partition_area(params: Column, dimension: Column, value: Column) -> Column:
    """Area of a partition: its split value, else params.area, else scope.hh_area_id."""
    return F.coalesce(
        F.when(dimension == "area", F.nullif(value, F.lit(""))),
        j.optional_string(params, "$.params.area"),
        j.optional_string(params, "$.scope.hh_area_id"),
    )


def partition_window(params: Column) -> Column:
    """struct(window_from, window_to) in seconds from params, else from scope; null if neither is valid."""

    def of(place: str) -> Column:
        a = _seconds(j.optional_string(params, f"$.{place}.date_from"))
        b = _seconds(j.optional_string(params, f"$.{place}.date_to"))
        return F.when(b > a, F.struct(a.alias("window_from"), b.alias("window_to")))

    return F.coalesce(of("params"), of("scope"))


def windows_of(second: Column, start: Column, end: Column) -> Column:
    """The windows that ``second`` falls into when [start, end) is halved over and over, by depth from the root on.

    The windows are (window_from, window_to); the last ones are single seconds and may repeat.
    """

    def halve(path: Column, _step: Column) -> Column:
        last = F.element_at(path, -1)
        middle = last["window_from"] + F.shiftright(last["window_to"] - last["window_from"], 1)
        right = F.struct(middle.alias("window_from"), last["window_to"].alias("window_to"))
        left = F.struct(last["window_from"].alias("window_from"), middle.alias("window_to"))
        return F.concat(path, F.array(F.when(second >= middle, right).otherwise(left)))

    # Halving as often as the width has binary digits leaves single seconds.
    steps = F.sequence(F.lit(1), F.length(F.bin(end - start)).cast("int"))
    return F.aggregate(steps, F.array(F.struct(start.alias("window_from"), end.alias("window_to"))), halve)


def split_to_fixpoint(density: DataFrame, roots: DataFrame, area: str, second: str, limit: int) -> DataFrame:
    """Plan a whole tree from measured density: halve every window holding more than ``limit`` rows.

    ``density`` has one row per observation (area, second); ``roots`` are windows of an area that do not overlap.
    Returns all windows with their counts and what became of them. A second names all windows it falls into, so
    one aggregate counts each window and its right half, without a checkpoint; a window holds no more than the one around it, so the
    windows reached are the roots and the halves of each window over the limit. A root without rows is covered,
    rows outside all roots are left out.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    a, b = F.col("window_from").cast("long"), F.col("window_to").cast("long")
    bounds = roots.select(area, a.alias("window_from"), b.alias("window_to"))
    # Seconds are counted first: a crowded second names its windows once, and small files are spread.
    counts = density.select(area, F.col(second).cast("long").alias("_s")).groupBy(area, "_s").agg(F.count(F.lit(1)).alias("_n"))
    inside = counts.join(bounds, area)
    inside = inside.filter((F.col("_s") >= F.col("window_from")) & (F.col("_s") < F.col("window_to")))
    path = F.posexplode(windows_of(F.col("_s"), F.col("window_from"), F.col("window_to"))).alias("depth", "_w")
    seen = inside.select(area, "_s", "_n", path).filter(f"depth = 0 or _w.window_to - _w.window_from >= {MIN_SPLIT_SECONDS}")
    empty = bounds.select(area, F.lit(None).cast("long").alias("_s"), F.lit(0).cast("long").alias("_n"), F.lit(0).alias("depth"), F.struct("window_from", "window_to").alias("_w"))
    at = seen.unionByName(empty).select(area, "_s", "_n", "depth", "_w.*")
    middle = F.expr("window_from + (window_to - window_from) div 2")
    held = at.groupBy(area, "window_from", "window_to", "depth").agg(
        F.sum("_n").alias("row_count"), F.sum(F.when(F.col("_s") >= middle, F.col("_n")).otherwise(0)).alias("_right")
    )
    heavy = F.col("row_count") > limit
    tiny = (F.col("window_to") - F.col("window_from")) < MIN_SPLIT_SECONDS

    def row(start: Column, end: Column, depth: Column, n: Column) -> Column:
        return F.struct(start.alias("window_from"), end.alias("window_to"), depth.alias("depth"), n.alias("row_count"))

    own = F.array(row(F.col("window_from"), F.col("window_to"), F.col("depth"), F.col("row_count")))
    deeper = F.col("depth") + 1
    halves = F.array(
        row(F.col("window_from"), middle, deeper, F.col("row_count") - F.col("_right")),
        row(middle, F.col("window_to"), deeper, F.col("_right")),
    )
    none = F.filter(own, lambda _w: F.lit(False))
    reached = F.concat(F.when(F.col("depth") == 0, own).otherwise(none), F.when(heavy & ~tiny, halves).otherwise(none))
    state = F.when(~heavy, "covered").when(tiny, "unresolved").otherwise("split")
    return held.select(area, F.explode(reached).alias("_w")).select(area, "_w.*").withColumn("status", state)


# Trailing windows in hours.
TRAILING_WINDOWS = (("trailing_1h", 1), ("trailing_6h", 6), ("trailing_24h", 24), ("trailing_7d", 168))


def trailing_counts(events: DataFrame, at: str, anchor: Column, by: list[str]) -> DataFrame:
    """Rows in each trailing window before the anchor, in one pass."""
    time = F.col(at)
    aggs = [
        F.count_if((time >= anchor - F.make_interval(hours=F.lit(h))) & (time < anchor)).alias(label)
        for label, h in TRAILING_WINDOWS
    ]
    wide = events.groupBy(*by).agg(*aggs)
    return wide.unpivot(by, [label for label, _h in TRAILING_WINDOWS], "label", "row_count")


def latest_run(runs: DataFrame, statuses: list[str]) -> DataFrame:
    return runs.filter(F.col("run_status").isin(*statuses)).orderBy(F.desc("started_at"), F.desc("crawl_run_id")).limit(1)
