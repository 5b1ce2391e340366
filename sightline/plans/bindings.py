"""Roles of the reference data model played by the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import fine_splits, prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fine_splits(prepare(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def entity_id():
    """About seven sightings per entity at every scale."""
    return F.col("user_id") * 10 + F.pmod(F.get_json_object("props", "$.k").cast("long"), F.lit(10))


def seen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as sightings: entity = user and last digit of k, run = week, partition and hash = type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        entity_id().alias("vacancy_id"),
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("crawl_run_id"),
        F.col("event_type").alias("crawl_partition_id"),
        F.col("ts").alias("seen_at"),
        F.sha2("event_type", 256).alias("short_hash"),
    )


SEEN = """
seen as (
  select event_id as id, 
         user_id * 10 + cast(json_extract_string(props, '$.k') as bigint) % 10 as vacancy_id,
         strftime(date_trunc('week', ts), '%Y-%m-%d') as crawl_run_id,
         event_type as crawl_partition_id, ts as seen_at, sha256(event_type) as short_hash
  from events)
"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """error / purchase events as detail attempts. The attempt number is the event's k modulo 7."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("error", "purchase"))
        .select(
            F.col("event_id").alias("id"),
            entity_id().alias("vacancy_id"),
            F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("crawl_run_id"),
            (F.pmod(k, F.lit(7)) + 1).cast("int").alias("attempt"),
            F.when(F.col("event_type") == "purchase", "succeeded")
            .when(F.pmod(k, F.lit(5)) == 0, "terminal_404")
            .otherwise("failed")
            .alias("status"),
            F.col("ts").alias("requested_at"),
            F.when(F.pmod(k, F.lit(3)) != 0, F.col("ts") + F.expr("interval 2 seconds")).alias("finished_at"),
        )
    )


ATTEMPTS = """
attempts as (
  select event_id as id, 
         user_id * 10 + cast(json_extract_string(props, '$.k') as bigint) % 10 as vacancy_id,
         strftime(date_trunc('week', ts), '%Y-%m-%d') as crawl_run_id,
         cast(cast(json_extract_string(props, '$.k') as int) % 7 + 1 as int) as attempt,
         case when event_type = 'purchase' then 'succeeded'
              when cast(json_extract_string(props, '$.k') as int) % 5 = 0 then 'terminal_404'
              else 'failed' end as status,
         ts as requested_at,
         case when cast(json_extract_string(props, '$.k') as int) % 3 <> 0
              then ts + interval 2 second end as finished_at
  from events where event_type in ('error', 'purchase'))
"""


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a request log: status by type, latency = value, session = user."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("session_id"),
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("crawl_run_id"),
        F.when(kind == "view", "/vacancies")
        .when(kind.isin("click", "error"), F.concat(F.lit("/vacancies/"), F.col("event_id")))
        .otherwise("/dictionaries")
        .alias("endpoint"),
        kind.alias("request_type"),
        F.when(kind == "error", 403).when(kind == "signup", 500).otherwise(200).cast("int").alias("status_code"),
        F.when((kind == "error") & (F.col("value") > 50), "captcha_required").alias("error_type"),
        F.col("value").alias("latency_ms"),
        F.col("ts").alias("requested_at"),
        F.col("props").alias("payload_json"),
    )


REQUESTS = """
reqs as (
  select event_id as id, user_id as session_id,
         strftime(date_trunc('week', ts), '%Y-%m-%d') as crawl_run_id,
         case when event_type = 'view' then '/vacancies'
              when event_type in ('click', 'error') then '/vacancies/' || event_id
              else '/dictionaries' end as endpoint,
         event_type as request_type,
         case event_type when 'error' then 403 when 'signup' then 500 else 200 end as status_code,
         case when event_type = 'error' and value > 50 then 'captcha_required' end as error_type,
         value as latency_ms, ts as requested_at, props as payload_json
  from events)
"""


def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a partition tree: run = order year, parent = order key divided by four."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    state = F.col("o_orderstatus")
    prio = F.substring("o_orderpriority", 1, 1)
    return o.select(
        F.date_format("o_orderdate", "yyyy").alias("crawl_run_id"),
        key.alias("id"),
        F.when(key > 0, F.floor(key / 4)).cast("long").alias("parent_partition_id"),
        F.concat(F.lit("p"), F.pmod(key, F.lit(97)).cast("string")).alias("partition_key"),
        F.when(state == "F", "done")
        .when(state == "O", F.when(prio.isin("1", "2"), "running").otherwise("pending"))
        .otherwise(
            F.when(prio == "1", "failed").when(prio == "2", "unresolved")
            .when(prio == "3", "split_required").otherwise("split_done")
        ).alias("status"),
        (~((state == "P") & prio.isin("3", "4", "5"))).alias("is_terminal"),
        F.when(state == "F", "covered")
        .when((state == "P") & (prio == "2"), "unresolved")
        .when((state == "P") & (prio == "3"), "saturated")
        .when((state == "P") & prio.isin("4", "5"), "split")
        .otherwise("unassessed").alias("coverage_status"),
        F.pmod(key, F.lit(3)).cast("int").alias("retry_count"),
        F.pmod(F.col("o_custkey"), F.lit(150)).cast("int").alias("pages_total_expected"),
        F.col("o_orderdate").alias("created_at"),
    )


PARTITIONS = """
parts as (
  select strftime(o_orderdate, '%Y') as crawl_run_id, o_orderkey as id,
         case when o_orderkey > 0 then cast(o_orderkey // 4 as bigint) end as parent_partition_id,
         'p' || (o_orderkey % 97) as partition_key,
         case when o_orderstatus = 'F' then 'done'
              when o_orderstatus = 'O' then
                case when o_orderpriority[1] in ('1', '2') then 'running' else 'pending' end
              when o_orderpriority[1] = '1' then 'failed'
              when o_orderpriority[1] = '2' then 'unresolved'
              when o_orderpriority[1] = '3' then 'split_required' else 'split_done' end as status,
         not (o_orderstatus = 'P' and o_orderpriority[1] in ('3', '4', '5')) as is_terminal,
         case when o_orderstatus = 'F' then 'covered'
              when o_orderstatus = 'P' and o_orderpriority[1] = '2' then 'unresolved'
              when o_orderstatus = 'P' and o_orderpriority[1] = '3' then 'saturated'
              when o_orderstatus = 'P' and o_orderpriority[1] in ('4', '5') then 'split'
              else 'unassessed' end as coverage_status,
         cast(o_orderkey % 3 as int) as retry_count,
         cast(o_custkey % 150 as int) as pages_total_expected, o_orderdate as created_at
  from orders)
"""


def as_of(ts: str):
    """A fixed evaluation time, so that results can be compared."""
    return F.lit(ts).cast("timestamp_ntz")


def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State per entity: folded sightings joined with the folded attempts."""
    from sightline.operators.history import fold_observations

    folded = fold_observations(seen_events(spark, sf_dir), "vacancy_id")
    a = attempts(spark, sf_dir)
    detail = a.groupBy("vacancy_id").agg(
        F.max_by("status", F.struct("requested_at", "id")).alias("detail_fetch_status"),
        F.max(
            F.when(F.col("status").isin("succeeded", "terminal_404"), F.coalesce("finished_at", "requested_at"))
        ).alias("last_detail_fetched_at"),
    )
    lease_hours = F.pmod(F.col("vacancy_id"), F.lit(48)).cast("int")
    return (
        folded.join(detail, "vacancy_id", "left")
        .withColumn("detail_fetch_status", F.coalesce("detail_fetch_status", F.lit("not_requested")))
        .withColumn("is_probably_inactive", F.col("last_seen_at") < as_of("2024-01-22"))
        .withColumn(
            "first_detail_lease_expires_at",
            F.when(
                F.pmod(F.col("vacancy_id"), F.lit(4)) == 0,
                as_of("2024-01-30") + F.make_interval(hours=lease_hours),
            ),
        )
    )


STATE = """
state as (
  select s.*, coalesce(d.detail_fetch_status, 'not_requested') as detail_fetch_status,
         d.last_detail_fetched_at, s.last_seen_at < timestamp '2024-01-22' as is_probably_inactive,
         case when s.vacancy_id % 4 = 0
              then timestamp '2024-01-30' + to_hours(cast(s.vacancy_id % 48 as int)) end
           as first_detail_lease_expires_at
  from (select vacancy_id, min(seen_at) as first_seen_at, max(seen_at) as last_seen_at,
               count(*) as seen_count, arg_max(crawl_run_id, (seen_at, id)) as last_seen_run_id,
               arg_max(short_hash, (seen_at, id)) as last_short_hash
        from seen group by vacancy_id) s
  left join (select vacancy_id, arg_max(status, (requested_at, id)) as detail_fetch_status,
                    max(case when status in ('succeeded', 'terminal_404')
                             then coalesce(finished_at, requested_at) end) as last_detail_fetched_at
             from attempts group by vacancy_id) d using (vacancy_id))
"""
