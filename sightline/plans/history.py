"""Queries over sightings and attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import history as h
from sightline.operators.latest import dedupe_last_wins, latest_per_key
from sightline.plans.bindings import (
    ATTEMPTS,
    SEEN,
    STATE,
    as_of,
    attempts,
    current_state,
    seen_events,
    table,
)
from sightline.plans.registry import query

RUN = "2024-01-29"


@query(
    "W1_change_points",
    f"""
with {SEEN}, lagged as (
  select *, lag(short_hash) over (partition by vacancy_id order by seen_at, id) as previous_value from seen)
select vacancy_id, id, seen_at, short_hash,
       case when previous_value is null then 'first_seen' else 'short_hash_changed' end as change_reason
from lagged where previous_value is null or previous_value <> short_hash
""",
)
def change_points(spark, d):
    out = h.change_points(seen_events(spark, d), ["vacancy_id"], ["seen_at", "id"], "short_hash")
    return out.select("vacancy_id", "id", "seen_at", "short_hash", "change_reason")


@query(
    "W2_latest_failed_attempt",
    f"""
with {ATTEMPTS}
select vacancy_id, id, attempt, coalesce(finished_at, requested_at) as attempted_at from (
  select *, row_number() over (partition by vacancy_id order by requested_at desc, id desc) as rn
  from attempts where status = 'failed') where rn = 1
""",
)
def latest_failed(spark, d):
    return h.latest_failed_attempts(attempts(spark, d))


@query(
    "W3_repair_backlog",
    f"""
with {ATTEMPTS}, latest as (
  select distinct on (crawl_run_id, vacancy_id) * from attempts
  order by crawl_run_id, vacancy_id, requested_at desc, id desc)
select crawl_run_id, vacancy_id, id, attempt from latest where status = 'failed'
""",
)
def repair(spark, d):
    return h.repair_backlog(attempts(spark, d)).select("crawl_run_id", "vacancy_id", "id", "attempt")


@query(
    "W3_latest_hash_of_other_runs",
    f"""
with {SEEN}
select vacancy_id, arg_max(short_hash, (seen_at, id)) as previous_short_hash
from seen where crawl_run_id <> '2024-01-15' group by vacancy_id
""",
)
def other_runs(spark, d):
    return h.latest_hash_of_other_runs(seen_events(spark, d), "2024-01-15")


@query(
    "W3_study_candidates",
    f"""
with {SEEN}
select vacancy_id, id, seen_at from (
  select distinct on (vacancy_id) * from seen order by vacancy_id, seen_at desc, id desc)
order by seen_at desc, id desc limit 50
""",
)
def study_candidates(spark, d):
    newest = latest_per_key(seen_events(spark, d), ["vacancy_id"], ["seen_at", "id"], ["id", "seen_at"])
    return newest.orderBy(F.desc("seen_at"), F.desc("id")).limit(50)


@query(
    "W4_sync_latest_hash",
    f"""
with {SEEN}, {ATTEMPTS}, {STATE}
select vacancy_id, (select arg_max(sha256(cast(a.attempt as varchar)), (a.requested_at, a.id)) from attempts a
                    where a.vacancy_id = state.vacancy_id and a.status = 'succeeded') as last_detail_hash
from state
""",
)
def sync_hash(spark, d):
    done = attempts(spark, d).filter("status = 'succeeded'")
    newest = done.groupBy("vacancy_id").agg(
        F.max_by(F.sha2(F.col("attempt").cast("string"), 256), F.struct("requested_at", "id")).alias("last_detail_hash")
    )
    return h.fold_observations(seen_events(spark, d)).select("vacancy_id").join(newest, "vacancy_id", "left")


@query("U2_distinct_entities_of_run", f"with {SEEN} select distinct vacancy_id from seen where crawl_run_id = '{RUN}'")
def distinct_of_run(spark, d):
    return seen_events(spark, d).filter(F.col("crawl_run_id") == RUN).select("vacancy_id").distinct()


@query(
    "U5_dedupe_last_wins",
    f"""
with {SEEN}
select * exclude (rn) from (select *, row_number() over (partition by vacancy_id, crawl_partition_id order by id desc) as rn
                            from seen) where rn = 1
""",
)
def dedupe(spark, d):
    return dedupe_last_wins(seen_events(spark, d), ["vacancy_id", "crawl_partition_id"], ["id"])


@query(
    "J12_seen_in_run",
    f"""
with {SEEN}
select vacancy_id, coalesce(bool_or(crawl_run_id = '{RUN}'), false) as seen_in_run from seen group by vacancy_id
""",
)
def membership(spark, d):
    s = seen_events(spark, d)
    return h.seen_in_run(h.fold_observations(s), s, RUN).select("vacancy_id", "seen_in_run")


@query(
    "M6_observe_fold",
    f"""
with {SEEN}
select vacancy_id, min(seen_at) as first_seen_at, max(seen_at) as last_seen_at, count(*) as seen_count,
       arg_max(crawl_run_id, (seen_at, id)) as last_seen_run_id,
       arg_max(short_hash, (seen_at, id)) as last_short_hash
from seen group by vacancy_id
""",
)
def observe(spark, d):
    s = seen_events(spark, d)
    cut = as_of("2024-01-15")
    old = h.fold_observations(s.filter(F.col("seen_at") < cut))
    return h.merge_states(old, h.fold_observations(s.filter(F.col("seen_at") >= cut)))


@query(
    "M8_reconcile_run",
    f"""
with {SEEN}, old as (
  select vacancy_id, cast(vacancy_id % 3 as int) as missing from seen group by vacancy_id),
hit as (select distinct vacancy_id from seen where crawl_run_id = '{RUN}')
select old.vacancy_id, hit.vacancy_id is not null as seen_in_run,
       case when hit.vacancy_id is not null then 0 else missing + 1 end as consecutive_missing_runs,
       hit.vacancy_id is null and missing + 1 >= 2 as is_probably_inactive
from old left join hit on hit.vacancy_id = old.vacancy_id
""",
)
def reconcile_run(spark, d):
    s = seen_events(spark, d)
    old = h.fold_observations(s).select(
        "vacancy_id", F.pmod("vacancy_id", F.lit(3)).cast("int").alias("consecutive_missing_runs")
    )
    out = h.reconcile(h.seen_in_run(old, s, RUN))
    return out.select("vacancy_id", "seen_in_run", "consecutive_missing_runs", "is_probably_inactive")


@query(
    "M8_reconcile_counts",
    f"""
with {SEEN}, old as (
  select vacancy_id, cast(vacancy_id % 3 as int) as missing from seen group by vacancy_id),
hit as (select distinct vacancy_id from seen where crawl_run_id = '{RUN}')
select count(*) filter (where hit.vacancy_id is not null) as observed_in_run_count,
       count(*) filter (where hit.vacancy_id is null) as missing_updated_count,
       count(*) filter (where hit.vacancy_id is null and missing + 1 >= 2 and missing < 2) as marked_inactive_count
from old left join hit on hit.vacancy_id = old.vacancy_id
""",
)
def reconcile_counts(spark, d):
    s = seen_events(spark, d)
    missing = F.pmod("vacancy_id", F.lit(3)).cast("int")
    old = h.fold_observations(s).select(
        "vacancy_id", missing.alias("consecutive_missing_runs"), (missing >= 2).alias("is_probably_inactive")
    )
    return h.reconcile_counts(h.seen_in_run(old, s, RUN))


@query(
    "M8_missing_runs_over_history",
    f"""
with {SEEN}, named as (select *, md5(crawl_run_id) as run from seen),
runs as (select run, row_number() over (order by min(seen_at), run) as i from named group by run),
last as (select vacancy_id, max(i) as i from named join runs using (run) group by vacancy_id)
select vacancy_id, run as last_seen_run_id,
       cast((select max(i) from runs) - i as int) as consecutive_missing_runs,
       (select max(i) from runs) - i >= 2 as is_probably_inactive
from last join runs using (i)
""",
)
def missing_history(spark, d):
    return h.missing_run_counts(seen_events(spark, d).withColumn("crawl_run_id", F.md5(F.col("crawl_run_id").cast("binary"))))


@query(
    "M9_append_seen_events",
    f"""
with {SEEN}, incoming as (
  select *, date_trunc('day', seen_at) as day from seen where seen_at >= timestamp '2024-01-10'),
stored as (select distinct vacancy_id, crawl_partition_id, date_trunc('day', seen_at) as day
           from seen where seen_at < timestamp '2024-01-10' + interval 12 hour),
fresh as (select *, row_number() over (partition by vacancy_id, crawl_partition_id, day order by id) as rn from incoming)
select id, vacancy_id, crawl_partition_id, day as seen_at, short_hash from fresh
where rn = 1 and not exists (select 1 from stored s where s.vacancy_id = fresh.vacancy_id
  and s.crawl_partition_id = fresh.crawl_partition_id and s.day = fresh.day)
""",
)
def append_events(spark, d):
    cols = ["id", "vacancy_id", "crawl_partition_id", "seen_at", "short_hash"]
    s = seen_events(spark, d)
    day = F.date_trunc("day", "seen_at").cast("timestamp_ntz")
    incoming = s.filter(F.col("seen_at") >= as_of("2024-01-10")).withColumn("seen_at", day).select(*cols)
    stored = s.filter(F.col("seen_at") < as_of("2024-01-10 12:00:00")).withColumn("seen_at", day).select(*cols)
    return h.append_unique(stored, incoming, ["vacancy_id", "crawl_partition_id", "seen_at"], ["id"])


@query(
    "M10_due_short_snapshots",
    f"""
with {SEEN}, before as (
  select vacancy_id, arg_max(short_hash, (seen_at, id)) as h from seen
  where seen_at < timestamp '2024-01-08' group by vacancy_id)
select s.id, s.vacancy_id, s.short_hash,
       case when b.vacancy_id is null then 'first_seen' else 'short_hash_changed' end as change_reason
from seen s left join before b on b.vacancy_id = s.vacancy_id
where s.crawl_run_id = '2024-01-08' and (b.vacancy_id is null or b.h <> s.short_hash)
""",
)
def due_snapshots(spark, d):
    s = seen_events(spark, d)
    before = h.fold_observations(s.filter(F.col("seen_at") < as_of("2024-01-08")))
    page = s.filter(F.col("crawl_run_id") == "2024-01-08")
    return h.due_short_snapshots(page, before).select("id", "vacancy_id", "short_hash", "change_reason")


@query(
    "M12_outcome_status",
    """
select o_orderkey, case when o_orderstatus = 'F' then 'succeeded'
                        when o_orderkey % 5 = 0 then 'terminal_404' else 'failed' end as status from orders
""",
)
def outcomes(spark, d):
    o = table(spark, d, "orders")
    code = F.when(F.pmod("o_orderkey", F.lit(5)) == 0, 404).otherwise(500)
    return o.select("o_orderkey", h.outcome_status(code, F.col("o_orderstatus") == "F").alias("status"))


CANDIDATES_SQL = f"""
{SEEN}, {ATTEMPTS}, {STATE}, prev as (
  select vacancy_id, arg_max(short_hash, (seen_at, id)) as previous_short_hash
  from seen where crawl_run_id <> '{RUN}' group by vacancy_id),
reasons as (
  select s.*, case
    when detail_fetch_status <> 'terminal_404' and
         (last_detail_fetched_at is null or detail_fetch_status not in ('succeeded', 'terminal_404')) then 'first_seen'
    when previous_short_hash <> last_short_hash then 'short_changed'
    when last_detail_fetched_at <= timestamp '2024-01-20' then 'ttl_refresh' end as reason
  from state s left join prev p on p.vacancy_id = s.vacancy_id)
"""


def candidates(spark, d):
    previous = h.latest_hash_of_other_runs(seen_events(spark, d), RUN)
    states = current_state(spark, d).join(previous, "vacancy_id", "left")
    return states.withColumn("reason", h.refetch_reason(as_of("2024-01-20")))


@query(
    "M13_refetch_reason",
    f"with {CANDIDATES_SQL} select vacancy_id, reason from reasons where reason is not null",
)
def refetch(spark, d):
    return candidates(spark, d).filter("reason is not null").select("vacancy_id", "reason")


@query(
    "M18_next_attempt_number",
    f"""
with {SEEN}, {ATTEMPTS}
select vacancy_id, cast(coalesce(n, 0) + 1 as int) as next_attempt
from (select distinct vacancy_id from seen) left join
     (select vacancy_id, arg_max(attempt, (requested_at, id)) as n from attempts group by vacancy_id) using (vacancy_id)
""",
)
def next_attempt(spark, d):
    keys = seen_events(spark, d).select("vacancy_id").distinct()
    return h.next_attempt_numbers(attempts(spark, d), keys)


@query(
    "M20_attempt_lifecycle",
    f"""
with {ATTEMPTS}
select id, vacancy_id, requested_at, finished_at,
       case when finished_at is null then 'running' else status end as status from attempts
""",
)
def lifecycle(spark, d):
    a = attempts(spark, d)
    starts = a.select("id", "vacancy_id", "requested_at")
    finishes = a.filter("finished_at is not null").select("id", "finished_at", "status")
    return h.attempt_lifecycle(starts, finishes)
