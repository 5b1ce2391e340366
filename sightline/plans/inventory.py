"""Inventory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.functions.scalars import observed_day
from sightline.operators import history as h
from sightline.operators import inventory as inv
from sightline.plans.bindings import (
    PARTITIONS,
    REQUESTS,
    SEEN,
    as_of,
    partitions,
    request_log,
    seen_events,
    table,
)
from sightline.plans.registry import query


def raw_payloads(spark, d):
    return table(spark, d, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.pmod("event_id", F.lit(7)) != 0, F.col("event_id")).alias("api_request_log_id"),
        F.nullif("event_type", F.lit("signup")).alias("endpoint_type"),
        F.col("props").alias("payload_json"),
        F.sha2("props", 256).alias("payload_hash"),
        F.col("ts").alias("received_at"),
    )


@query(
    "G1_payload_summary",
    """
select coalesce(nullif(event_type, 'signup'), '-') as endpoint_type, count(*) as payload_count,
       cast(sum(strlen(props)) as bigint) as payload_bytes, count(distinct sha256(props)) as distinct_hashes,
       min(ts) as first_received_at, max(ts) as last_received_at
from events group by 1
""",
)
def payload_summary(spark, d):
    return inv.payload_summary(raw_payloads(spark, d), "endpoint_type", "payload_json", "payload_hash", "received_at")


@query(
    "G2_request_summary",
    f"""
with {REQUESTS}
select request_type, status_code, count(*) as request_count, min(requested_at) as first_requested_at,
       max(requested_at) as last_requested_at, round(avg(latency_ms), 2) as avg_latency_ms
from reqs group by 1, 2
""",
)
def request_summary(spark, d):
    return inv.request_summary(request_log(spark, d), ["request_type", "status_code"], "latency_ms", "requested_at")


def order_documents(spark, d):
    """Orders as JSON objects; optional keys are left out, every order has an array of items."""
    items = F.transform(
        F.sequence(F.lit(0), F.pmod("o_orderkey", F.lit(3)).cast("int")),
        lambda i: F.struct(
            (F.col("o_orderkey") * 3 + i).alias("id"),
            F.when(i == 0, F.col("o_orderpriority")).alias("name"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("owner"),
        ),
    )
    doc = F.struct(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") > 250000, F.col("o_totalprice")).alias("price"),
        items.alias("items"),
    )
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.to_json(doc).alias("payload_json"))


@query(
    "G3_key_frequency",
    """
with sample as (select * from orders order by o_orderkey desc limit 5000),
keys as (select unnest(list_filter(['id', 'items', case when o_orderstatus <> 'P' then 'status' end,
                case when o_totalprice > 250000 then 'price' end], lambda x: x is not null)) as key from sample)
select key, count(*) as key_count,
       round(100.0 * count(*) / (select count(*) from sample), 2) as sample_percent
from keys group by key order by key_count desc, key limit 30
""",
)
def key_frequency(spark, d):
    return inv.key_frequency_of_newest(order_documents(spark, d), "id", "payload_json", 5000, 30)


@query(
    "G4_item_key_frequency",
    """
with sample as (select * from orders order by o_orderkey desc limit 5000),
items as (select o_orderpriority, o_orderstatus, unnest(range(o_orderkey % 3 + 1)) as i from sample),
keys as (select unnest(list_filter(['id', case when i = 0 then 'name' end,
                case when o_orderstatus = 'F' then 'owner' end], lambda x: x is not null)) as key from items)
select key, count(*) as key_count,
       round(100.0 * count(*) / (select count(*) from items), 2) as sample_percent
from keys group by key order by key_count desc, key limit 30
""",
)
def item_key_frequency(spark, d):
    return inv.key_frequency_of_newest(order_documents(spark, d), "id", "payload_json", 5000, 30, "$.items")


@query(
    "J10_classified_payloads",
    f"""
with {REQUESTS}
select e.event_id as id, r.request_type from events e
left join reqs r on r.id = case when e.event_id % 7 <> 0 then e.event_id end
where r.request_type = 'view' or nullif(e.event_type, 'signup') in ('view', 'click')
""",
)
def classified(spark, d):
    out = inv.classified_payloads(raw_payloads(spark, d), request_log(spark, d), "view", ["view", "click"])
    return out.select("id", "request_type")


@query(
    "G5_snapshot_summary",
    f"""
with {SEEN}, lagged as (
  select *, lag(short_hash) over (partition by vacancy_id order by seen_at, id) as p from seen),
snaps as (select *, case when p is null then 'first_seen' else 'short_hash_changed' end as change_reason
          from lagged where p is null or p <> short_hash)
select 'short' as snapshot_type, change_reason, count(*) as snapshot_count,
       count(distinct vacancy_id) as vacancy_count, min(seen_at) as first_captured_at,
       max(seen_at) as last_captured_at
from snaps group by change_reason
""",
)
def snapshot_summary(spark, d):
    snaps = h.change_points(seen_events(spark, d), ["vacancy_id"], ["seen_at", "id"], "short_hash")
    snaps = snaps.withColumn("snapshot_type", F.lit("short"))
    return inv.snapshot_summary(snaps, ["snapshot_type", "change_reason"], "vacancy_id", "seen_at")


@query(
    "G6_conditional_counts",
    """
select event_type, count(*) as total, count(nullif(event_type, 'signup')) as with_type,
       count(*) filter (where value > 50) as large, count(*) filter (where user_id % 2 = 0) as even_users
from events group by event_type
""",
)
def conditional_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.nullif("event_type", F.lit("signup"))).alias("with_type"),
        F.count_if(F.col("value") > 50).alias("large"),
        F.count_if(F.pmod("user_id", F.lit(2)) == 0).alias("even_users"),
    )


def _fill_sql(label, view, columns):
    return " union all ".join(
        f"select '{label}.{c}' as field_name, count({c}) as filled_count, count(*) as total_count, "
        f"round(100.0 * count({c}) / nullif(count(*), 0), 2) as filled_percent from {view}"
        for c in columns
    )


@query(
    "G7_fill_rates",
    "with c as (select c_custkey, c_name, nullif(c_nationkey, 3) as c_nationkey, "
    "nullif(c_mktsegment, 'BUILDING') as c_mktsegment from customer), "
    "p as (select p_partkey, nullif(p_type, 'SMALL') as p_type, nullif(p_size, 11) as p_size from part) "
    + _fill_sql("customer", "c", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    + " union all "
    + _fill_sql("part", "p", ["p_partkey", "p_type", "p_size"]),
)
def fill_rates(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        "c_name",
        F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )
    p = table(spark, d, "part").select(
        "p_partkey",
        F.nullif("p_type", F.lit("SMALL")).alias("p_type"),
        F.nullif("p_size", F.lit(11)).alias("p_size"),
    )
    return inv.union_rows([inv.fill_rates(c, "customer", c.columns), inv.fill_rates(p, "part", p.columns)])


@query(
    "G8_corpus_counts",
    """
select 'orders' as metric, count(*) as value from orders
union all select 'orders_open', count(*) filter (where o_orderstatus = 'O') from orders
union all select 'events', count(*) from events
union all select 'events_users', count(distinct user_id) from events
union all select 'lineitem', count(*) from lineitem
""",
)
def corpus_counts(spark, d):
    return inv.union_rows(
        [
            inv.metric_rows(
                table(spark, d, "orders"),
                {"orders": F.count(F.lit(1)), "orders_open": F.count_if(F.col("o_orderstatus") == "O")},
            ),
            inv.metric_rows(
                table(spark, d, "events"),
                {"events": F.count(F.lit(1)), "events_users": F.count_distinct("user_id")},
            ),
            inv.metric_rows(table(spark, d, "lineitem"), {"lineitem": F.count(F.lit(1))}),
        ]
    )


@query(
    "G9_time_ranges",
    """
select 'orders.o_orderdate' as field_name, count(o_orderdate) as value_count, min(o_orderdate) as min_at,
       max(o_orderdate) as max_at from orders
union all select 'lineitem.l_shipdate', count(l_shipdate), min(l_shipdate), max(l_shipdate) from lineitem
union all select 'events.ts', count(ts), min(ts), max(ts) from events
""",
)
def time_ranges(spark, d):
    return inv.union_rows(
        [
            inv.time_ranges(table(spark, d, "orders"), "orders", ["o_orderdate"]),
            inv.time_ranges(table(spark, d, "lineitem"), "lineitem", ["l_shipdate"]),
            inv.time_ranges(table(spark, d, "events"), "events", ["ts"]),
        ]
    )


@query(
    "G10_counts_since",
    """
select 'orders.o_orderdate' as field_name, count(*) as value_count, min(o_orderdate) as min_at,
       max(o_orderdate) as max_at from orders where o_orderdate >= timestamp '1999-06-01'
union all select 'events.ts', count(*), min(ts), max(ts) from events where ts >= timestamp '2024-01-20'
""",
)
def counts_since(spark, d):
    o = inv.since(table(spark, d, "orders"), "o_orderdate", as_of("1999-06-01"))
    e = inv.since(table(spark, d, "events"), "ts", as_of("2024-01-20"))
    return inv.union_rows([inv.time_ranges(o, "orders", ["o_orderdate"]), inv.time_ranges(e, "events", ["ts"])])


@query("F6_rows_since_boundary", "select event_id, ts from events where ts >= timestamp '2024-01-15 06:00:00'")
def rows_since(spark, d):
    return inv.since(table(spark, d, "events"), "ts", as_of("2024-01-15 06:00:00")).select("event_id", "ts")


@query(
    "G11_status_distribution",
    f"with {PARTITIONS} select status, coverage_status, count(*) as row_count from parts group by 1, 2",
)
def status_distribution(spark, d):
    return inv.distribution(partitions(spark, d), ["status", "coverage_status"])


@query(
    "G12_monthly_summary",
    """
select strftime(o_orderdate, '%Y-%m') as month, o_orderpriority, o_orderstatus, count(*) as run_count,
       min(o_orderdate) as first_at, max(o_orderdate) as last_at from orders group by 1, 2, 3
""",
)
def monthly(spark, d):
    return inv.monthly_summary(table(spark, d, "orders"), "o_orderdate", ["o_orderpriority", "o_orderstatus"])


@query(
    "G13_rows_by_dataset_and_day",
    """
with rows as (select 'silver/vacancy_seen_event' as dataset_key, strftime(ts, '%Y-%m-%d') as day from events
              union all select 'silver/api_request_log', strftime(o_orderdate, '%Y-%m-%d') from orders
              where o_orderstatus <> 'P'
              union all select 'silver/api_request_log', '-' from orders where o_orderstatus = 'P')
select dataset_key, day, count(*) as row_count from rows where day <> '-' group by 1, 2
""",
)
def by_dataset_and_day(spark, d):
    e = table(spark, d, "events").select(F.lit("silver/vacancy_seen_event").alias("dataset_key"), F.col("ts").alias("seen_at"))
    o = table(spark, d, "orders").select(
        F.lit("silver/api_request_log").alias("dataset_key"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("requested_at"),
    )
    days = e.select("dataset_key", observed_day(e.columns).alias("day")).unionByName(
        o.select("dataset_key", F.coalesce(observed_day(o.columns), F.lit("-")).alias("day"))
    )
    return days.filter("day <> '-'").groupBy("dataset_key", "day").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "N26_observed_day",
    "select event_id, strftime(coalesce(case when event_id % 3 = 0 then ts end, ts + interval 1 day), '%Y-%m-%d') as day from events",
)
def day_of_row(spark, d):
    e = table(spark, d, "events").select(
        "event_id",
        F.when(F.pmod("event_id", F.lit(3)) == 0, F.col("ts")).alias("requested_at"),
        (F.col("ts") + F.expr("interval 1 day")).alias("updated_at"),
    )
    return e.select("event_id", observed_day(e.columns).alias("day"))


@query(
    "N30_safe_ratio_and_percent",
    """
select o_custkey, case when count(*) filter (where o_orderstatus <> 'P') = 0 then 0.0
       else count(*) filter (where o_orderstatus = 'F') / count(*) filter (where o_orderstatus <> 'P') end as done_ratio,
       round(100.0 * count(*) filter (where o_orderstatus = 'F')
             / nullif(count(*) filter (where o_orderstatus <> 'P'), 0), 2) as done_percent
from orders group by o_custkey
""",
)
def ratios(spark, d):
    from sightline.functions.scalars import percent, safe_ratio

    g = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("done"),
        F.count_if(F.col("o_orderstatus") != "P").alias("closed"),
    )
    return g.select(
        "o_custkey",
        safe_ratio(F.col("done"), F.col("closed")).alias("done_ratio"),
        percent(F.col("done"), F.col("closed")).alias("done_percent"),
    )


@query(
    "T5_latest_runs",
    f"""
with {PARTITIONS}, runs as (select crawl_run_id, max(created_at) as started_at, count(*) as partition_count
                            from parts group by 1)
select * from runs order by started_at desc, crawl_run_id desc limit 3
""",
)
def latest_runs(spark, d):
    runs = partitions(spark, d).groupBy("crawl_run_id").agg(
        F.max("created_at").alias("started_at"), F.count(F.lit(1)).alias("partition_count")
    )
    return runs.orderBy(F.desc("started_at"), F.desc("crawl_run_id")).limit(3)


@query(
    "U1_union_of_metrics",
    """
select 'status_' || lower(o_orderstatus) as metric, count(*) as value from orders group by o_orderstatus
union all select 'type_' || event_type, count(*) from events group by event_type
""",
)
def union_metrics(spark, d):
    o = table(spark, d, "orders").groupBy(F.concat(F.lit("status_"), F.lower("o_orderstatus")).alias("metric"))
    e = table(spark, d, "events").groupBy(F.concat(F.lit("type_"), "event_type").alias("metric"))
    count = F.count(F.lit(1)).alias("value")
    return inv.union_rows([o.agg(count), e.agg(count)])
