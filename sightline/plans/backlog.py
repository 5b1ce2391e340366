"""Backlog queries, evaluated at a fixed time."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import backlog as b
from sightline.operators import history as h
from sightline.operators.inventory import metric_rows
from sightline.plans.bindings import ATTEMPTS, SEEN, STATE, as_of, attempts, current_state, table
from sightline.plans.history import CANDIDATES_SQL, RUN, candidates
from sightline.plans.registry import query

NOW = "2024-01-30 12:00:00"
BASE, CAP = 3600, 86400

FAILED = f"""
{SEEN}, {ATTEMPTS}, {STATE}, failed as (
  select vacancy_id, attempt, coalesce(finished_at, requested_at) as attempted_at from (
    select *, row_number() over (partition by vacancy_id order by requested_at desc, id desc) as rn
    from attempts where status = 'failed') where rn = 1),
full_state as (
  select s.*, f.attempt, f.attempted_at,
         not ((detail_fetch_status = 'succeeded' and last_detail_fetched_at is not null)
              or detail_fetch_status = 'terminal_404') as waiting,
         f.attempted_at is null or f.attempted_at <= timestamp '{NOW}'
           - to_seconds(least({CAP}, {BASE} * pow(2, least(greatest(f.attempt - 1, 0), 16)))) as ready
  from state s left join failed f on f.vacancy_id = s.vacancy_id)
"""


def states_with_failures(spark, d):
    return b.with_latest_failure(current_state(spark, d), h.latest_failed_attempts(attempts(spark, d)))


@query(
    "F1_first_detail_backlog",
    f"with {FAILED} select vacancy_id from full_state where waiting and not is_probably_inactive",
)
def first_backlog(spark, d):
    return current_state(spark, d).filter(b.in_first_backlog()).select("vacancy_id")


@query("F2_retry_ready", f"with {FAILED} select vacancy_id, ready from full_state")
def retry(spark, d):
    return states_with_failures(spark, d).select("vacancy_id", b.retry_ready(as_of(NOW), BASE, CAP).alias("ready"))


@query(
    "F3_lease_ready",
    f"""with {FAILED} select vacancy_id from full_state
where first_detail_lease_expires_at is null or first_detail_lease_expires_at <= timestamp '{NOW}'""",
)
def lease(spark, d):
    return current_state(spark, d).filter(b.lease_ready(as_of(NOW))).select("vacancy_id")


@query(
    "J5_states_with_latest_failure",
    f"with {FAILED} select vacancy_id, detail_fetch_status, attempt, attempted_at from full_state",
)
def with_failure(spark, d):
    return states_with_failures(spark, d).select("vacancy_id", "detail_fetch_status", "attempt", "attempted_at")


@query(
    "T1_backlog_top_k",
    f"""with {FAILED} select vacancy_id, first_seen_at, last_seen_at from full_state
where waiting and ready and (first_detail_lease_expires_at is null or first_detail_lease_expires_at <= timestamp '{NOW}')
order by first_seen_at, last_seen_at desc, vacancy_id limit 100""",
)
def backlog_top(spark, d):
    ready = b.ready_backlog(states_with_failures(spark, d), as_of(NOW), BASE, CAP, include_inactive=True)
    return ready.orderBy(*b.backlog_order()).limit(100).select("vacancy_id", "first_seen_at", "last_seen_at")


@query(
    "T2_refetch_top_k",
    f"""with {CANDIDATES_SQL} select vacancy_id, reason from reasons where reason is not null and last_seen_run_id = '{RUN}'
order by case reason when 'first_seen' then 0 when 'short_changed' then 1 else 2 end,
         date_trunc('second', last_seen_at) desc, vacancy_id limit 700""",
)
def refetch_top(spark, d):
    return b.refetch_selection(candidates(spark, d), 700, RUN).select("vacancy_id", "reason")


@query(
    "T2_refetch_counts",
    f"""with {CANDIDATES_SQL} select count(*) filter (where reason = 'first_seen') as first_seen,
count(*) filter (where reason = 'short_changed') as short_changed,
count(*) filter (where reason = 'ttl_refresh') as ttl_refresh,
greatest(count(reason) - 700, 0) as skipped_due_to_limit from reasons where last_seen_run_id = '{RUN}'""",
)
def refetch_counts(spark, d):
    return b.refetch_counts(b.last_seen_in(candidates(spark, d), RUN), 700)


@query(
    "G16_backlog_sizes",
    f"""with {FAILED}, states_ as (select *, ready and (first_detail_lease_expires_at is null or first_detail_lease_expires_at <= timestamp '{NOW}') as free from full_state), sized as (
  select 'active' as scope, count(*) filter (where waiting and not is_probably_inactive) as backlog_size,
         count(*) filter (where waiting and free and not is_probably_inactive) as ready_size from states_
  union all select 'all', count(*) filter (where waiting), count(*) filter (where waiting and free) from states_)
select *, greatest(backlog_size - ready_size, 0) as cooldown_size from sized""",
)
def sizes(spark, d):
    return b.backlog_sizes(states_with_failures(spark, d), as_of(NOW), BASE, CAP)


@query(
    "G17_outcome_counts",
    f"""with {ATTEMPTS} select crawl_run_id, count(*) as selected_count,
count(*) filter (where status = 'succeeded') as detail_fetch_succeeded,
count(*) filter (where status = 'terminal_404') as detail_fetch_terminal,
count(*) filter (where status = 'failed') as detail_fetch_failed from attempts group by 1""",
)
def outcome(spark, d):
    return b.outcome_counts(attempts(spark, d), ["crawl_run_id"])


REPAIR_SQL = """
before as (select crawl_run_id, vacancy_id from (
    select distinct on (crawl_run_id, vacancy_id) * from attempts where attempt <= 4
    order by crawl_run_id, vacancy_id, requested_at desc, id desc) where status = 'failed'),
aft as (select crawl_run_id, vacancy_id from (
    select distinct on (crawl_run_id, vacancy_id) * from attempts
    order by crawl_run_id, vacancy_id, requested_at desc, id desc) where status = 'failed')
"""


@query(
    "G17_repaired_counts",
    f"""with {ATTEMPTS}, {REPAIR_SQL}
select b.crawl_run_id, count(*) as backlog_before, count(a.vacancy_id) as backlog_after,
       count(*) - count(a.vacancy_id) as repaired
from before b left join aft a on a.crawl_run_id = b.crawl_run_id and a.vacancy_id = b.vacancy_id group by 1""",
)
def repaired(spark, d):
    a = attempts(spark, d)
    before, after = h.repair_backlog(a.filter("attempt <= 4")), h.repair_backlog(a)
    return b.repaired_counts(before, after, ["crawl_run_id", "vacancy_id"], ["crawl_run_id"])


@query(
    "G18_metric_delta",
    """
with m as (select 'failed' as metric, count(*) filter (where ts < timestamp '2024-01-15') as b, count(*) as a
           from events where event_type = 'error'
           union all select 'users', count(distinct user_id) filter (where ts < timestamp '2024-01-15'),
                            count(distinct user_id) from events where event_type = 'error')
select metric, b as before_value, a as after_value, a - b as delta from m
""",
)
def delta(spark, d):
    e = table(spark, d, "events").filter("event_type = 'error'")
    metrics = {"failed": F.count(F.lit(1)), "users": F.count_distinct("user_id")}
    early = metric_rows(e.filter(F.col("ts") < as_of("2024-01-15")), metrics)
    return b.metric_delta(early, metric_rows(e, metrics))


@query(
    "G24_lease_health",
    f"""with {FAILED} select
count(*) filter (where first_detail_lease_expires_at > timestamp '{NOW}') as active_leases,
count(*) filter (where first_detail_lease_expires_at <= timestamp '{NOW}') as expired_leases,
count(*) filter (where detail_fetch_status = 'failed') as failed_rows from full_state""",
)
def leases(spark, d):
    return b.lease_health(current_state(spark, d), as_of(NOW))


def collection_runs(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        F.when(F.pmod("o_custkey", F.lit(2)) == 0, "weekly_sweep").otherwise("detail_catchup").alias("run_type"),
        F.when(F.col("o_orderstatus") == "O", "created").otherwise("succeeded").alias("status"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("finished_at"),
    )


@query(
    "G25_gate_scalars",
    f"""with {FAILED} select
(select count(*) from orders where o_orderstatus = 'O') as active_runs,
count(*) filter (where waiting and not is_probably_inactive) as backlog,
count(*) filter (where waiting and not is_probably_inactive and (first_detail_lease_expires_at is null
      or first_detail_lease_expires_at <= timestamp '{NOW}')) as ready_backlog,
(select cast(epoch(max(o_orderdate)) as bigint) from orders where o_orderstatus <> 'O' and o_custkey % 2 = 0) as last_success_epoch,
(select strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') from orders where o_orderstatus <> 'O' and o_custkey % 2 = 0) as last_success_at
from full_state""",
)
def gate(spark, d):
    return b.gate_scalars(collection_runs(spark, d), current_state(spark, d), "weekly_sweep", as_of(NOW))


@query(
    "M17_claim_batch",
    f"""with {FAILED}, chosen as (
  select vacancy_id from full_state where waiting and ready and not is_probably_inactive
    and (first_detail_lease_expires_at is null or first_detail_lease_expires_at <= timestamp '{NOW}')
  order by first_seen_at, last_seen_at desc, vacancy_id limit 200)
select s.vacancy_id, case when c.vacancy_id is not null then 'running' else detail_fetch_status end as detail_fetch_status,
       case when c.vacancy_id is not null then 'worker-1' end as first_detail_lease_owner,
       case when c.vacancy_id is not null then timestamp '{NOW}' + interval 900 second
            else first_detail_lease_expires_at end as first_detail_lease_expires_at
from full_state s left join chosen c on c.vacancy_id = s.vacancy_id""",
)
def claim(spark, d):
    states = states_with_failures(spark, d)
    ready = b.ready_backlog(states, as_of(NOW), BASE, CAP)
    out = b.claim_batch(states, ready, 200, "worker-1", as_of(NOW), 900)
    return out.select(
        "vacancy_id", "detail_fetch_status", "first_detail_lease_owner", "first_detail_lease_expires_at"
    )
