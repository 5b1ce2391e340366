"""Request-log queries: events as requests, one session per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.functions.scalars import endpoint_kind, endpoint_template, status_class
from sightline.operators import coverage as cov
from sightline.operators import requestlog as rl
from sightline.operators.segments import exact_percentiles
from sightline.plans.bindings import (
    ATTEMPTS,
    PARTITIONS,
    REQUESTS,
    SEEN,
    as_of,
    attempts,
    partitions,
    request_log,
    seen_events,
    table,
)
from sightline.plans.payloads import K, search_pages
from sightline.plans.registry import query

SESSION = ["session_id"]
AT, ID = "requested_at", "id"
NOW = "2024-01-31"


@query(
    "J13_replay_sequence",
    f"""with {REQUESTS} select r.id, r.requested_at, r.status_code, o.o_custkey as found, o.o_custkey % 150 as pages,
cast(case when o.o_orderkey is not null then o.o_orderkey % 3 + 1 end as int) as items_count,
cast(null as varchar) as payload_error_type
from reqs r left join (select * from orders where o_orderkey % 5 <> 0) o on o.o_orderkey = r.id
where r.endpoint = '/vacancies' and r.crawl_run_id = '2024-01-08'""",
)
def replay(spark, d):
    log = request_log(spark, d).filter("endpoint = '/vacancies' and crawl_run_id = '2024-01-08'").drop("payload_json")
    pages = search_pages(spark, d).filter(F.pmod("page_id", F.lit(5)) != 0)
    out = rl.replay_sequence(log, pages.withColumnRenamed("page_id", "api_request_log_id"))
    return out.orderBy(AT, ID).select(
        "id", "requested_at", "status_code", "found", "pages", "items_count", "payload_error_type"
    )


@query(
    "W5_annotated_requests",
    f"""with {REQUESTS}, w as (select *, row_number() over s as request_index,
  lag(requested_at) over s as prev, min(case when error_type = 'captcha_required' then requested_at end)
    over (partition by session_id order by requested_at, id rows unbounded preceding) as first_captcha_at
  from reqs window s as (partition by session_id order by requested_at, id))
select id, request_index, first_captcha_at,
  round((epoch_us(requested_at) - epoch_us(prev)) / 1e6, 6) as seconds_since_previous,
  round((epoch_us(requested_at) - epoch_us(first_captcha_at)) / 1e6 / 60, 3) as minutes_since_first_captcha from w""",
)
def annotated(spark, d):
    out = rl.annotate(request_log(spark, d), SESSION, AT, ID)
    return out.select("id", "request_index", "first_captcha_at", "seconds_since_previous", "minutes_since_first_captcha")


@query(
    "W6_prefix_before_first_403",
    f"""with {REQUESTS}, w as (select *, sum(case when status_code = 403 then 1 else 0 end)
  over (partition by session_id order by requested_at, id rows unbounded preceding) as blocked from reqs)
select id, session_id from w where blocked = 0""",
)
def prefix(spark, d):
    out = rl.prefix_before_first(request_log(spark, d), SESSION, AT, ID, F.col("status_code") == 403)
    return out.select("id", "session_id")


@query(
    "W6_prefix_including_first_403",
    f"""with {REQUESTS}, w as (select *, sum(case when status_code = 403 then 1 else 0 end)
  over (partition by session_id order by requested_at, id rows unbounded preceding) as blocked from reqs)
select id, session_id from w where blocked = 0 or (blocked = 1 and status_code = 403)""",
)
def prefix_with(spark, d):
    out = rl.prefix_before_first(request_log(spark, d), SESSION, AT, ID, F.col("status_code") == 403, True)
    return out.select("id", "session_id")


@query(
    "W7_session_summary",
    f"""with {REQUESTS}, n as (select *, row_number() over (partition by session_id order by requested_at, id) as i from reqs),
f as (select session_id, min(i) filter (where status_code = 403) as f403,
             min(i) filter (where error_type = 'captcha_required') as fcap from n group by 1)
select n.session_id, count(*) as total_requests, min(requested_at) as window_started_at, max(requested_at) as window_finished_at,
  count(*) filter (where status_code = 200 and (f403 is null or i < f403)) as ok_before_first_403,
  count(*) filter (where status_code = 200 and i > f403) as ok_after_first_403,
  count(*) filter (where status_code = 403 and i > f403) as forbidden_after_first_403,
  any_value(f403) as requests_until_first_403, any_value(fcap) as requests_until_first_captcha,
  round((epoch_us(min(requested_at) filter (where i = f403)) - epoch_us(min(requested_at))) / 1e6, 6) as seconds_until_first_403,
  arg_max(id, i) filter (where status_code = 200 and i < f403) as last_success_id,
  min(id) filter (where i = f403) as first_403_id
from n join f using (session_id) group by 1""",
)
def session_summary(spark, d):
    return rl.session_summary(request_log(spark, d), SESSION, AT, ID)


@query(
    "W8_endpoint_breakdown",
    f"""with {REQUESTS}, n as (select *, row_number() over (partition by session_id order by requested_at, id) as i,
  case when endpoint = '/vacancies' then 'search' when starts_with(endpoint, '/vacancies/') then 'detail' else 'dictionary' end as endpoint_kind
  from reqs)
select session_id, endpoint_kind, count(*) as requests, min(i) filter (where error_type = 'captcha_required') as first_captcha_request_index
from n group by 1, 2""",
)
def breakdown(spark, d):
    return rl.endpoint_breakdown(rl.annotate(request_log(spark, d), SESSION, AT, ID), SESSION)


@query(
    "W8_endpoint_status_counts",
    f"""with {REQUESTS} select session_id, case when endpoint = '/vacancies' then 'search'
  when starts_with(endpoint, '/vacancies/') then 'detail' else 'dictionary' end as endpoint_kind, status_code,
  count(*) as request_count from reqs group by 1, 2, 3""",
)
def breakdown_status(spark, d):
    log = request_log(spark, d).withColumn("endpoint_kind", endpoint_kind(F.col("endpoint")))
    return rl.status_counts(log, ["session_id", "endpoint_kind"])


def search_log(spark, d):
    """Every third detail request goes to the search endpoint, so that searches meet a captcha."""
    to_search = F.pmod("id", F.lit(3)) == 0
    return request_log(spark, d).withColumn(
        "endpoint", F.when(to_search, "/vacancies").otherwise(F.col("endpoint"))
    )


@query(
    "W9_search_only_analysis",
    f"""with {REQUESTS}, k as (select *, case when id % 3 = 0 or endpoint = '/vacancies' then 'search'
  when starts_with(endpoint, '/vacancies/') then 'detail' else 'dictionary' end as kind from reqs),
n as (select *, row_number() over (partition by session_id, kind order by requested_at, id) as i from k),
f as (select session_id, min(i) filter (where kind = 'search' and error_type = 'captcha_required') as cap from n group by 1)
select n.session_id, count(*) filter (where kind = 'search' and status_code = 200 and (cap is null or i < cap)) as search_ok_before_first_captcha,
  count(*) filter (where kind = 'detail' and status_code = 200) as detail_200_count,
  count(*) filter (where kind = 'detail' and status_code = 403) as detail_403_count,
  any_value(cap) as first_search_captcha_index from n join f using (session_id) group by 1""",
)
def search_only(spark, d):
    return rl.search_only(search_log(spark, d), SESSION, AT, ID)


@query(
    "W10_session_aggregates",
    """select o_custkey % 100 as session_id, count(*) as total_slots, count(*) filter (where o_orderstatus = 'F') as completed_slots,
count(*) filter (where o_orderstatus = 'P') as aborted_slots, count(*) filter (where o_orderkey % 7 < 3) as seed_clean_count,
count(*) filter (where o_orderkey % 11 = 5) as recovery_clean_count,
count(*) filter (where o_orderkey % 17 > o_orderkey % 13) as recovery_better_than_seed_count,
round(avg(o_orderkey % 4), 2) as avg_seed_gate_attempts, round(avg(o_orderkey % 6), 2) as avg_recovery_gate_attempts, min(o_orderkey % 13) as min_seed_search_ok, max(o_orderkey % 13) as max_seed_search_ok,
min(o_orderkey % 17) as min_recovery_search_ok, max(o_orderkey % 17) as max_recovery_search_ok,
arg_min(o_orderpriority, o_orderkey) filter (where o_orderkey % 11 = 5) as first_clean_window from orders group by 1""",
)
def aggregates(spark, d):
    k = K()
    slots = table(spark, d, "orders").select(
        F.pmod("o_custkey", F.lit(100)).alias("session_id"), k.alias("slot_no"), F.col("o_orderpriority").alias("window_label"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "aborted").otherwise("running").alias("status"),
        F.pmod(k, F.lit(13)).alias("seed_search_ok"), F.pmod(k, F.lit(17)).alias("recovery_search_ok"),
        F.pmod(k, F.lit(4)).alias("seed_attempts"), F.pmod(k, F.lit(6)).alias("recovery_attempts"),
        (F.pmod(k, F.lit(7)) < 3).alias("seed_clean"), (F.pmod(k, F.lit(11)) == 5).alias("recovery_clean"),
    )
    return rl.session_aggregate(slots, ["session_id"])


@query(
    "W11_first_seen_ids",
    """with x as (select o_orderkey, o_orderdate, unnest([o_custkey, o_orderkey % 100]) as item_id, unnest([0, 1]) as pos from orders),
f as (select item_id, min({'d': o_orderdate, 'k': o_orderkey, 'p': pos}) as o from x group by 1)
select item_id, o.d as o_orderdate, o.k as o_orderkey from f order by o limit 200""",
)
def first_ids(spark, d):
    o = table(spark, d, "orders").withColumn("items", F.array("o_custkey", F.pmod("o_orderkey", F.lit(100))))
    return rl.first_seen_ids(o, ["o_orderdate", "o_orderkey"], "items", 200)


@query(
    "G20_exact_percentiles",
    f"""with {REQUESTS} select request_type, round(quantile_cont(latency_ms, 0.5), 2) as latency_p50,
round(quantile_cont(latency_ms, 0.95), 2) as latency_p95 from reqs group by 1""",
)
def percentiles(spark, d):
    return exact_percentiles(
        request_log(spark, d), ["request_type"], "latency_ms", {"latency_p50": 0.5, "latency_p95": 0.95}
    )


def order_roles(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("item"), F.pmod("l_partkey", F.lit(40)).alias("role"),
        F.when(F.pmod("l_linenumber", F.lit(2)) == 0, F.format_string("role-%d-%d", F.pmod("l_partkey", F.lit(40)), F.pmod("l_orderkey", F.lit(3)))).alias("name"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


@query(
    "G22_role_overlap",
    """with i as (select l_orderkey, count(distinct l_partkey % 40) as n from lineitem group by 1)
select count(*) as sampled_items, count(*) filter (where n > 1) as multi_role_items, coalesce(max(n), 0) as max_roles_per_item,
round(count(*) filter (where n > 1) / count(*), 4) as multi_role_share from i""",
)
def overlap(spark, d):
    return rl.overlap_summary(order_roles(spark, d), "item", "role")


HITS = """
hits as (select l_partkey % 40 as role, count(*) as sample_hits,
  arg_min('role-' || (l_partkey % 40) || '-' || (l_orderkey % 3), (l_orderkey, l_linenumber, l_partkey, l_suppkey)) filter (where l_linenumber % 2 = 0) as role_name
  from lineitem group by 1)
"""


@query("G22_role_hits", f"with {HITS} select * from hits")
def hits(spark, d):
    return rl.role_hits(order_roles(spark, d), "role", "name", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("T6_top_roles", f"with {HITS} select * from hits order by sample_hits desc, role limit 5")
def top_roles(spark, d):
    return rl.top_roles(hits(spark, d), "role", 5)


@query(
    "G23_split_dimensions",
    """with r as (select o_custkey % 30 as area, case o_orderkey % 3 when 0 then 'baseline' when 1 then 'time_window' else 'professional_role' end as dimension,
  case when o_orderkey % 50 = 49 then 403 else 200 end as status_code, case when o_orderkey % 5 <> 0 then o_orderkey % 120 end as pages from orders)
select area, min(pages) filter (where dimension = 'baseline') as baseline_pages, min(pages) filter (where dimension = 'time_window') as time_best_pages,
  min(pages) filter (where dimension = 'professional_role') as role_best_pages,
  coalesce(bool_and(status_code = 200) filter (where dimension = 'time_window'), true) as time_supported,
  coalesce(bool_and(status_code = 200) filter (where dimension = 'professional_role'), true) as role_supported,
  min(pages) filter (where dimension = 'baseline') - min(pages) filter (where dimension = 'time_window') as time_reduction,
  min(pages) filter (where dimension = 'baseline') - min(pages) filter (where dimension = 'professional_role') as role_reduction,
  'time_window' as preferred_first_fallback from r group by 1""",
)
def dimensions(spark, d):
    k = K()
    results = table(spark, d, "orders").select(
        F.pmod("o_custkey", F.lit(30)).alias("area"),
        F.when(F.pmod(k, F.lit(3)) == 0, "baseline").when(F.pmod(k, F.lit(3)) == 1, "time_window").otherwise("professional_role").alias("dimension"),
        F.when(F.pmod(k, F.lit(50)) == 49, 403).otherwise(200).alias("status_code"),
        F.when(F.pmod(k, F.lit(5)) != 0, F.pmod(k, F.lit(120))).alias("pages"),
    )
    multi = overlap(spark, d).select("multi_role_items").scalar()
    return rl.assess_dimensions(results, "area", multi)


@query(
    "O1_request_counters",
    f"""with {REQUESTS} select case when starts_with(endpoint, '/vacancies/') then '/vacancies/{{vacancy_id}}' else endpoint end as endpoint,
(status_code // 100) || 'xx' as status_class, count(*) as request_count from reqs group by 1, 2""",
)
def counters(spark, d):
    return rl.request_counters(request_log(spark, d))


BUCKETS = f"""
{REQUESTS}, le as (select unnest([0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, cast('inf' as double)]::double[]) as le)
"""


@query(
    "O2_duration_histogram",
    f"""with {BUCKETS} select request_type, round(sum(latency_ms / 10), 4) as duration_sum, count(*) as duration_count, le,
count(*) filter (where latency_ms / 10 <= le) as bucket_count from reqs, le group by request_type, le""",
)
def histogram(spark, d):
    return rl.duration_histogram(request_log(spark, d), ["request_type"], F.col("latency_ms") / 10)


@query(
    "O4_histogram_quantile",
    f"""with {BUCKETS}, b as (select request_type, date_trunc('day', requested_at) as day, le,
  count(*) filter (where latency_ms / 10 <= le) as n from reqs, le group by 1, 2, 3),
w as (select *, lag(le, 1, 0.0) over g as lo, lag(n, 1, 0) over g as below, max(n) over (partition by request_type, day) as total
      from b window g as (partition by request_type, day order by le)),
h as (select request_type, day, arg_min({{'le': le, 'lo': lo, 'below': below, 'n': n, 'total': total}}, le) as x
      from w where n >= 0.95 * total group by 1, 2)
select request_type, day, round(case when x.le = cast('inf' as double) then x.lo
  else x.lo + (x.le - x.lo) * (0.95 * x.total - x.below) / (x.n - x.below) end, 6) as quantile_value from h""",
)
def quantile(spark, d):
    log = request_log(spark, d).withColumn("day", F.date_trunc("day", AT).cast("timestamp_ntz"))
    by = ["request_type", "day"]
    return rl.histogram_quantile(rl.duration_histogram(log, by, F.col("latency_ms") / 10), by, 0.95)


@query(
    "O3_interval_counts",
    f"""with {REQUESTS} select time_bucket(interval 5 minute, requested_at) as window_start,
case when starts_with(endpoint, '/vacancies/') then '/vacancies/{{vacancy_id}}' else endpoint end as endpoint,
count(*) as request_count, count(*) filter (where status_code >= 400) as error_count from reqs group by 1, 2""",
)
def intervals(spark, d):
    out = rl.interval_counts(request_log(spark, d), AT, "5 minutes", [endpoint_template(F.col("endpoint")).alias("endpoint")])
    return out.select("window_start", "endpoint", "request_count", "error_count")


def operations(spark, d):
    names = F.element_at(F.array(*[F.lit(x) for x in ("reconcile_run", "triggered_run", "housekeeping", "backup")]), F.pmod("event_id", F.lit(4)).cast("int") + 1)
    e = table(spark, d, "events")
    stop = as_of("2024-01-22")
    return e.select(
        names.alias("operation"), F.col("ts").alias("at"),
        ((F.col("event_type") != "error") & ((F.pmod("event_id", F.lit(4)) < 2) | (F.col("ts") < stop))).alias("succeeded"),
        F.pmod("user_id", F.lit(9)).alias("records_written"),
    )


OPS = """
ops as (select ['reconcile_run', 'triggered_run', 'housekeeping', 'backup'][event_id % 4 + 1] as operation, ts,
  event_type <> 'error' and (event_id % 4 < 2 or ts < timestamp '2024-01-22') as succeeded, user_id % 9 as records_written from events),
opsum as (select operation, count(*) filter (where succeeded) as succeeded_count, count(*) filter (where not succeeded) as failed_count,
  max(ts) filter (where succeeded) as last_success_at, cast(sum(case when succeeded then records_written else 0 end) as bigint) as records_written
  from ops group by 1)
"""


@query("O5_operation_summary", f"with {OPS} select * from opsum")
def operation_summary(spark, d):
    return rl.operation_summary(operations(spark, d), ["operation"], "at")


@query(
    "O6_freshness_violations",
    f"""with {OPS}, rules(operation, lim) as (values ('reconcile_run', 604800), ('triggered_run', 691200), ('housekeeping', 604800), ('backup', 259200))
select operation, cast(epoch(timestamp '{NOW}') - floor(epoch(last_success_at)) as bigint) as age_seconds, lim as max_age_seconds
from opsum join rules using (operation) where epoch(timestamp '{NOW}') - floor(epoch(last_success_at)) > lim""",
)
def freshness(spark, d):
    rules = spark.createDataFrame(list(rl.FRESHNESS_LIMITS), "operation string, max_age_seconds int")
    out = rl.freshness_violations(operation_summary(spark, d), rules, as_of(NOW))
    return out.select("operation", "age_seconds", "max_age_seconds")


@query(
    "O7_open_and_increase_rules",
    f"""with {OPS}, w as (select time_bucket(interval 15 minute, ts) as window_start, operation,
  count(*) filter (where not succeeded) as error_count from ops group by 1, 2) select * from w where error_count > 0""",
)
def increases(spark, d):
    log = operations(spark, d).withColumn("status_code", F.when(F.col("succeeded"), 200).otherwise(500))
    counts = rl.interval_counts(log, "at", "15 minutes", [F.col("operation")])
    return rl.windows_above(counts, "error_count", 0).select("window_start", "operation", "error_count")


@query(
    "O8_backlog_not_draining",
    """with w as (select time_bucket(interval 6 hour, ts) as window_start, user_id, count(*) filter (where event_type = 'view') as ready,
  count(*) filter (where event_type = 'purchase') as drained from events group by 1, 2)
select window_start, user_id, ready from w where ready > 0 and drained = 0""",
)
def not_draining(spark, d):
    w = table(spark, d, "events").groupBy(F.window("ts", "6 hours").alias("w"), "user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("ready"), F.count_if(F.col("event_type") == "purchase").alias("drained")
    ).withColumn("window_start", F.col("w.start"))
    out = rl.unless(w.filter("ready > 0"), w.filter("drained > 0"), ["window_start", "user_id"])
    return out.select("window_start", "user_id", "ready")


@query(
    "O9_held_for",
    f"""with {REQUESTS}, s as (select distinct request_type, cast(floor(epoch(requested_at)) as bigint) // 1800 as slot from reqs where latency_ms > 60),
n as (select *, slot - row_number() over (partition by request_type order by slot) as g from s)
select request_type, min(slot) * 1800 as from_epoch, (max(slot) + 1) * 1800 as to_epoch, (max(slot) + 1 - min(slot)) * 1800 as held_seconds
from n group by request_type, g having (max(slot) + 1 - min(slot)) * 1800 >= 3600""",
)
def held(spark, d):
    return rl.held_for(request_log(spark, d).filter("latency_ms > 60"), ["request_type"], AT, 1800, 3600)


@query(
    "O10_coverage_gauges",
    f"""with {PARTITIONS}, s as (select crawl_run_id, count(*) filter (where status = 'failed') as failed_partitions,
  count(*) filter (where status = 'unresolved' or coverage_status = 'unresolved') as unresolved_partitions,
  count(*) filter (where is_terminal) as t, count(*) filter (where is_terminal and coverage_status = 'covered') as c,
  max(created_at) as finished_at from parts group by 1)
select case when cast(crawl_run_id as int) % 2 = 0 then 'weekly_sweep' else 'resume' end as run_type, count(*) as run_count,
  cast(sum(failed_partitions) as bigint) as failed_partitions, cast(sum(unresolved_partitions) as bigint) as unresolved_partitions,
  cast(sum(c) as double) / cast(sum(t) as double) as coverage_ratio, max(finished_at) as last_finished_at from s group by 1""",
)
def gauges(spark, d):
    p = partitions(spark, d)
    ends = p.groupBy("crawl_run_id").agg(F.max("created_at").alias("finished_at"))
    s = cov.coverage_summary(p).join(ends, "crawl_run_id")
    kind = F.when(F.col("crawl_run_id").cast("int") % 2 == 0, "weekly_sweep").otherwise("resume")
    return s.groupBy(kind.alias("run_type")).agg(
        F.count(F.lit(1)).alias("run_count"),
        F.sum("failed_partitions").alias("failed_partitions"),
        F.sum("unresolved_partitions").alias("unresolved_partitions"),
        (F.sum("covered_terminal_partitions") / F.sum("terminal_partitions")).alias("coverage_ratio"),
        F.max("finished_at").alias("last_finished_at"),
    )


@query(
    "O11_throughput",
    f"""with {REQUESTS}, g as (select *, (epoch_us(requested_at) - epoch_us(lag(requested_at) over (partition by request_type order by requested_at, id))) / 1e6 as gap from reqs)
select request_type, count(*) as request_count,
  round(count(*) * 3600 / ((epoch_us(max(requested_at)) - epoch_us(min(requested_at))) / 1e6), 1) as requests_per_hour,
  round(quantile_cont(latency_ms, 0.5), 2) as latency_p50, round(quantile_cont(latency_ms, 0.95), 2) as latency_p95,
  round(quantile_cont(gap, 0.5), 3) as gap_p50, round(quantile_cont(gap, 0.95), 3) as gap_p95 from g group by 1""",
)
def throughput(spark, d):
    return rl.throughput(request_log(spark, d), ["request_type"], AT, ID, "latency_ms")


@query(
    "O12_sweep_completeness",
    f"""with {SEEN}, {ATTEMPTS}, f as (select vacancy_id, arg_min(crawl_run_id, (seen_at, id)) as crawl_run_id, min(seen_at) as t from seen group by 1),
a as (select vacancy_id, min(coalesce(finished_at, requested_at)) filter (where status = 'succeeded') as ok,
  count(*) filter (where status = 'terminal_404') as gone from attempts group by 1),
j as (select f.*, a.ok, greatest(epoch_us(a.ok) - epoch_us(f.t), 0) / 1e6 as lag, a.ok is null and coalesce(gone, 0) > 0 as lost
      from f left join a using (vacancy_id))
select crawl_run_id, count(*) as new_vacancies, count(ok) as first_detail_succeeded, count(*) filter (where lost) as gone_before_detail,
  round(count(ok) / count(*), 4) as first_detail_success_rate,
  round(quantile_cont(case when ok is not null then lag end, 0.5), 2) as detail_lag_p50,
  round(quantile_cont(case when ok is not null then lag end, 0.95), 2) as detail_lag_p95 from j group by 1""",
)
def completeness(spark, d):
    return rl.sweep_completeness(seen_events(spark, d), attempts(spark, d))
