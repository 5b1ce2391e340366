"""Retention queries, evaluated at a fixed time."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import retention as r
from sightline.operators.inventory import union_rows
from sightline.operators.latest import superseded
from sightline.plans.bindings import (
    ATTEMPTS,
    SEEN,
    as_of,
    attempts,
    entity_id,
    seen_events,
    table,
)
from sightline.plans.registry import query
from sightline.sources import audit as au

CUTOFF = "2024-01-20"


def _run():
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    return F.when(F.pmod("user_id", F.lit(6)) != 0, week)


def payloads(spark, d):
    return table(spark, d, "events").select(
        F.col("event_id").alias("id"), _run().alias("crawl_run_id"), F.col("ts").alias("received_at")
    )


def snapshots(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    version = F.when(F.pmod(k, F.lit(3)) == 0, '{"schema_version":2}').when(
        F.pmod(k, F.lit(3)) == 1, '{"schema_version":1}'
    )
    return (
        table(spark, d, "events")
        .filter(kind.isin("view", "click", "purchase"))
        .select(
            F.col("event_id").alias("id"),
            entity_id().alias("vacancy_id"),
            _run().alias("crawl_run_id"),
            F.when(kind == "view", "short").otherwise("detail").alias("snapshot_type"),
            F.col("ts").alias("captured_at"),
            F.when(kind == "view", F.col("event_id") + 1).alias("short_payload_ref_id"),
            F.when(kind != "view", F.col("event_id") + 2).alias("detail_payload_ref_id"),
            version.alias("normalized_json"),
        )
    )


def runs(spark, d):
    weeks = table(spark, d, "events").select(F.date_trunc("week", "ts").cast("timestamp_ntz").alias("w")).distinct()
    active = F.date_format("w", "yyyy-MM-dd").isin("2024-01-15", "2024-01-29")
    return weeks.select(
        F.date_format("w", "yyyy-MM-dd").alias("id"),
        F.when(active, "created").otherwise("completed").alias("status"),
        F.when(~active, F.col("w") + F.expr("interval 7 days")).alias("finished_at"),
    )


def covered_id(spark, d):
    """Highest event id before a day, standing for what the archive covers."""
    e = table(spark, d, "events").filter(F.col("ts") < as_of("2024-01-18"))
    return e.agg(F.max("event_id")).scalar()


TABLES = f"""
{SEEN}, {ATTEMPTS}, runs as (
  select strftime(w, '%Y-%m-%d') as id,
         case when strftime(w, '%Y-%m-%d') in ('2024-01-15', '2024-01-29') then 'created' else 'completed' end as status,
         case when strftime(w, '%Y-%m-%d') not in ('2024-01-15', '2024-01-29') then cast(w as timestamp) + interval 7 day end as finished_at
  from (select distinct date_trunc('week', ts) as w from events)),
payloads as (select event_id as id, case when user_id % 6 <> 0 then strftime(date_trunc('week', ts), '%Y-%m-%d') end
             as crawl_run_id, ts as received_at from events),
snapshots as (
  select event_id as id, user_id * 10 + cast(json_extract_string(props, '$.k') as bigint) % 10 as vacancy_id,
         case when user_id % 6 <> 0 then strftime(date_trunc('week', ts), '%Y-%m-%d') end as crawl_run_id,
         case when event_type = 'view' then 'short' else 'detail' end as snapshot_type, ts as captured_at,
         case when event_type = 'view' then event_id + 1 end as short_payload_ref_id,
         case when event_type <> 'view' then event_id + 2 end as detail_payload_ref_id,
         cast(json_extract_string(props, '$.k') as int) % 3 <> 0 as legacy
  from events where event_type in ('view', 'click', 'purchase')),
covered as (select max(event_id) as id from events where ts < timestamp '2024-01-18'),
payload_candidates as (
  select p.* from payloads p left join runs on runs.id = p.crawl_run_id
  where received_at < timestamp '{CUTOFF}' and (runs.id is null or runs.status <> 'created')
    and not exists (select 1 from snapshots s where legacy and (s.short_payload_ref_id = p.id or s.detail_payload_ref_id = p.id))),
snapshot_candidates as (
  select s.* from (select *, row_number() over (partition by vacancy_id, snapshot_type
                             order by captured_at desc, id desc) as rn from snapshots) s
  left join runs on runs.id = s.crawl_run_id
  where rn > 1 and captured_at < timestamp '{CUTOFF}' and (runs.id is null or runs.status <> 'created')),
attempt_candidates as (
  select a.* from attempts a left join runs on runs.id = a.crawl_run_id
  where requested_at < timestamp '{CUTOFF}' and (runs.id is null or runs.status <> 'created')
    and a.id not in (select max(id) from attempts group by vacancy_id, crawl_run_id)),
run_candidates as (select * from runs where status <> 'created' and finished_at < timestamp '2024-01-30')
"""


def payload_candidates(spark, d, cap=None):
    return r.payload_candidates(payloads(spark, d), runs(spark, d), snapshots(spark, d), as_of(CUTOFF), cap)


def snapshot_candidates(spark, d, cap=None):
    return r.snapshot_candidates(snapshots(spark, d), runs(spark, d), as_of(CUTOFF), cap)


def attempt_candidates(spark, d, cap=None):
    return r.attempt_candidates(attempts(spark, d), runs(spark, d), as_of(CUTOFF), cap)


def run_candidates(spark, d):
    return r.finished_runs(runs(spark, d), as_of("2024-01-30"))


@query("F4_legacy_snapshots", f"with {TABLES} select id from snapshots where legacy")
def legacy(spark, d):
    return snapshots(spark, d).filter(r.is_legacy_snapshot()).select("id")


@query(
    "J3_superseded_snapshots",
    f"""with {TABLES} select s.id from snapshots s where exists (
  select 1 from snapshots n where n.vacancy_id = s.vacancy_id and n.snapshot_type = s.snapshot_type
    and (n.captured_at > s.captured_at or (n.captured_at = s.captured_at and n.id > s.id)))""",
)
def older(spark, d):
    s = snapshots(spark, d).select("id", "vacancy_id", "snapshot_type", "captured_at")
    return superseded(s, ["vacancy_id", "snapshot_type"], ["captured_at", "id"], "id").select("id")


@query(
    "J4_protected_payloads",
    f"""with {TABLES} select p.id from payloads p where exists (select 1 from snapshots s
  where legacy and (s.short_payload_ref_id = p.id or s.detail_payload_ref_id = p.id))""",
)
def protected(spark, d):
    return payloads(spark, d).join(r.protected_payload_ids(snapshots(spark, d)), "id", "left_semi").select("id")


@query(
    "J6_not_latest_attempts",
    f"with {TABLES} select id from attempts where id not in (select max(id) from attempts group by vacancy_id, crawl_run_id)",
)
def not_latest(spark, d):
    a = attempts(spark, d)
    return a.join(r.latest_ids(a), "id", "left_anti").select("id")


@query(
    "J7_runs_blocked_by_uncovered_events",
    f"""with {TABLES} select id, exists (select 1 from seen where seen.crawl_run_id = run_candidates.id
  and seen.id > (select id from covered)) as blocked from run_candidates""",
)
def blocked_runs(spark, d):
    c, e, cap = run_candidates(spark, d), seen_events(spark, d), covered_id(spark, d)
    bad = r.runs_with_events_after(c, e, cap, True).select("id", F.lit(True).alias("blocked"))
    return bad.unionByName(r.runs_with_events_after(c, e, cap, False).select("id", F.lit(False).alias("blocked")))


@query("R1_payload_candidates", f"with {TABLES} select id, received_at from payload_candidates where id <= (select id from covered)")
def r1(spark, d):
    return payload_candidates(spark, d, covered_id(spark, d)).select("id", "received_at")


@query("R2_snapshot_candidates", f"with {TABLES} select id, captured_at from snapshot_candidates")
def r2(spark, d):
    return snapshot_candidates(spark, d).select("id", "captured_at")


@query("R3_attempt_candidates", f"with {TABLES} select id, requested_at from attempt_candidates")
def r3(spark, d):
    return attempt_candidates(spark, d).select("id", "requested_at")


@query("R4_finished_run_candidates", f"with {TABLES} select id, finished_at from run_candidates")
def r4(spark, d):
    return run_candidates(spark, d).select("id", "finished_at")


@query(
    "T3_oldest_first_selection",
    f"with {TABLES} select id, received_at from payload_candidates order by received_at, id limit 300",
)
def t3(spark, d):
    return r.oldest_first(payload_candidates(spark, d).select("id", "received_at"), "received_at", 300)


@query(
    "R5_retention_plan",
    f"""with {TABLES}, n as (
  select 'raw_api_payload' as target, true as enabled, count(*) as candidate_count, 300 as lim from payload_candidates
  union all select 'vacancy_snapshot', false, 0, 300
  union all select 'detail_fetch_attempt', true, count(*), 100000000 from attempt_candidates)
select target, case when enabled then timestamp '{CUTOFF}' end as cutoff, candidate_count,
       cast(least(candidate_count, lim) as bigint) as action_count, enabled, candidate_count > lim as limited from n""",
)
def r5(spark, d):
    cut = as_of(CUTOFF)
    return union_rows(
        [
            r.plan_row("raw_api_payload", payload_candidates(spark, d), 10, cut, 300),
            r.plan_row("vacancy_snapshot", snapshot_candidates(spark, d), 0, cut, 300),
            r.plan_row("detail_fetch_attempt", attempt_candidates(spark, d), 10, cut, 100_000_000),
        ]
    )


@query(
    "R6_generation_retention",
    """
with g as (select o_orderkey as id, o_orderdate as backup_at, o_custkey % 50 = 0 as protected,
                  o_orderstatus <> 'P' as verified from orders),
ranked as (
  select *, row_number() over (partition by verified order by backup_at desc, id desc) as rn,
         row_number() over (partition by verified, isoyear(backup_at), week(backup_at) order by backup_at desc, id desc) as wrn,
         dense_rank() over (partition by verified order by isoyear(backup_at) desc, week(backup_at) desc) as weeks from g)
select id, case when not verified then 'receipts do not match'
                when protected then 'protected milestone backup'
                when rn <= 10 then 'latest verified generation'
                when wrn = 1 and weeks <= 40 then 'weekly verified checkpoint'
                when rn = 1 then 'no newer verified generation exists' end as reason,
       case when not verified then 'skipped'
            when protected or rn <= 10 or (wrn = 1 and weeks <= 40) or rn = 1 then 'retained'
            else 'delete_candidate' end as action
from ranked
""",
)
def r6(spark, d):
    g = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("backup_at"),
        (F.pmod("o_custkey", F.lit(50)) == 0).alias("protected"),
        (F.col("o_orderstatus") != "P").alias("verified"),
    )
    return r.generation_plan(g, "id", "backup_at", 10, 40).select("id", "reason", "action")


@query(
    "W12_newest_per_iso_week",
    """
select id, backup_at from (select o_orderkey as id, o_orderdate as backup_at,
  row_number() over (partition by isoyear(o_orderdate), week(o_orderdate) order by o_orderdate desc, o_orderkey desc) as rn
  from orders) where rn = 1
""",
)
def w12(spark, d):
    o = table(spark, d, "orders")
    weeks = [F.extract(F.lit(p), F.col("o_orderdate")).alias(p) for p in ("YEAROFWEEK", "WEEK")]
    newest = o.groupBy(*weeks).agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("g"))
    return newest.select(F.col("g.o_orderkey").alias("id"), F.col("g.o_orderdate").alias("backup_at"))


@query(
    "R7_cascade_counts",
    f"""with {TABLES} select c.id as crawl_run_id,
  (select count(*) from payloads p where p.crawl_run_id = c.id) as partition_count,
  (select count(*) from seen s where s.crawl_run_id = c.id) as seen_event_count from run_candidates c""",
)
def r7(spark, d):
    return r.run_cascade_counts(run_candidates(spark, d), payloads(spark, d), seen_events(spark, d))


@query(
    "R7_cascade_survivors",
    f"with {TABLES} select id, crawl_run_id from seen where crawl_run_id not in (select id from run_candidates)",
)
def r7_survivors(spark, d):
    return r.without_runs(seen_events(spark, d), run_candidates(spark, d)).select("id", "crawl_run_id")


@query(
    "R7_set_null",
    f"""with {TABLES} select id, case when crawl_run_id in (select id from run_candidates) then null
  else crawl_run_id end as crawl_run_id from snapshots""",
)
def r7_null(spark, d):
    return r.run_set_null(snapshots(spark, d), run_candidates(spark, d)).select("id", "crawl_run_id")


@query(
    "R8_archive_before_delete",
    f"""with {TABLES} select 'raw_api_payload' as target, count(*) as selected_count, count(*) as archived_count,
  true as archived from payload_candidates""",
)
def r8(spark, d):
    return r.archive_before_delete("raw_api_payload", payload_candidates(spark, d))


@query(
    "R9_coverage_bounded_preview",
    f"""with {TABLES}, allowed as (select * from payload_candidates where id <= (select id from covered)),
chosen as (select id from allowed order by received_at, id limit 200)
select 'raw_api_payload' as target, (select id from covered) as source_id_covered,
  (select count(*) from allowed) as candidate_count, count(*) as action_count,
  min(id) as selected_min_id, max(id) as selected_max_id from chosen""",
)
def r9(spark, d):
    cap = covered_id(spark, d)
    candidates = payload_candidates(spark, d, cap)
    return r.bounded_preview("raw_api_payload", candidates, "received_at", 200, cap, F.lit(True))


DAYS = {"bronze/raw_api_payload": "2024-01-18", "silver/vacancy_snapshot": "2024-01-16", "silver/detail_fetch_attempt": "2024-01-20"}


def checkpoint_coverage(spark, d, issue=None):
    """Audit of three chains of daily checkpoints; with ``issue`` the last one of the snapshots is damaged."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    chains = []
    for key, until in DAYS.items():
        days = e.filter(F.col("day") < F.lit(until).cast("date")).groupBy("day").agg(F.max("event_id").alias("source_id_after"), F.count("*").alias("row_count"))
        bad = F.lit(key == "silver/vacancy_snapshot" and issue is not None) & (F.col("day") == F.date_sub(F.lit(until).cast("date"), 1))
        chains.append(days.select(F.lit(key).alias("dataset_key"), ~bad, F.when(bad, F.lit(issue)), F.lit(1), "row_count", "source_id_after").toDF(
            "dataset_key", "valid", "issue", "file_count", "row_count", "source_id_after"))
    return au.coverage(union_rows(chains))


def _bounded(target, at, source, day):
    return f"""select '{target}' as target, (select max(event_id) from events where ts < timestamp '{day}') as source_id_covered,
  (select count(*) from {source} where id <= (select max(event_id) from events where ts < timestamp '{day}')) as candidate_count,
  count(*) as action_count, min(id) as selected_min_id, max(id) as selected_max_id, 'complete' as audit from (
    select id from {source} where id <= (select max(event_id) from events where ts < timestamp '{day}') order by {at}, id limit 200)"""


@query(
    "R9_archive_bounded_previews",
    f"with {TABLES} " + " union all ".join(_bounded(*x) for x in (
        ("raw_api_payload", "received_at", "payload_candidates", DAYS["bronze/raw_api_payload"]),
        ("vacancy_snapshot", "captured_at", "snapshot_candidates", DAYS["silver/vacancy_snapshot"]),
        ("detail_fetch_attempt", "requested_at", "attempt_candidates", DAYS["silver/detail_fetch_attempt"]))),
)
def r9_all(spark, d):
    """All row targets under a complete audit, and under one with a damaged checkpoint, which allows none."""
    keys = list(DAYS)
    targets = {
        "raw_api_payload": (keys[0], payload_candidates(spark, d), "received_at"),
        "vacancy_snapshot": (keys[1], snapshot_candidates(spark, d), "captured_at"),
        "detail_fetch_attempt": (keys[2], attempt_candidates(spark, d), "requested_at"),
    }
    audits = {"complete": checkpoint_coverage(spark, d), "damaged": checkpoint_coverage(spark, d, "data checksum mismatch")}
    return union_rows([r.archive_bounded_previews(targets, c, 200).withColumn("audit", F.lit(name)) for name, c in audits.items()])


@query(
    "R9_run_tree_preview",
    f"""with {TABLES}, safe as (select id from run_candidates c where not exists (
  select 1 from seen where seen.crawl_run_id = c.id and seen.id > (select id from covered)))
select (select count(*) from run_candidates) as candidate_count, count(*) as coverage_safe_candidate_count,
  (select count(*) from run_candidates) - count(*) as coverage_blocked_candidate_count,
  (select count(*) from seen where crawl_run_id in (select id from safe)) as selected_vacancy_seen_event_count from safe""",
)
def r9_tree(spark, d):
    c, e = run_candidates(spark, d), seen_events(spark, d)
    safe = r.runs_with_events_after(c, e, covered_id(spark, d), False)
    events = e.join(safe.select(F.col("id").alias("crawl_run_id")), "crawl_run_id", "left_semi")
    total = c.agg(F.count(F.lit(1))).scalar()
    return safe.agg(F.count(F.lit(1)).alias("coverage_safe_candidate_count")).select(
        total.alias("candidate_count"),
        "coverage_safe_candidate_count",
        (total - F.col("coverage_safe_candidate_count")).alias("coverage_blocked_candidate_count"),
        events.agg(F.count(F.lit(1))).scalar().alias("selected_vacancy_seen_event_count"),
    )


@query(
    "R10_apply_exact_removal",
    f"""with {TABLES} select 'detail_fetch_attempt' as target, (select count(*) from attempts) as before_count,
  count(*) as selected_count, (select count(*) from attempts) - count(*) as survivor_count, true as exact
  from attempt_candidates""",
)
def r10(spark, d):
    return r.apply_removal("detail_fetch_attempt", attempts(spark, d), attempt_candidates(spark, d))
