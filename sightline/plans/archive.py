"""Archive queries: scans over bound tables, exports of events, and audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sightline.operators.inventory import smallest_entries
from sightline.plans.bindings import as_of, table
from sightline.plans.registry import query
from sightline.schemas import TABLES
from sightline.session import scratch_path
from sightline.sources import archive as ar
from sightline.sources import audit as au
from sightline.sources import scans as sc
from sightline.sources.tables import flatten, report_rows, write_csv


def model_tables(spark, d):
    """The tables of the data model, filled from events, orders and customers."""
    e, o, c = table(spark, d, "events"), table(spark, d, "orders"), table(spark, d, "customer")
    log = e.select(
        F.col("event_id").alias("id"), F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("crawl_run_id"),
        F.col("event_type").alias("request_type"), F.col("ts").alias("requested_at"),
        F.pmod("event_id", F.lit(5)).cast("int").alias("attempt"), F.col("value").cast("int").alias("latency_ms"),
    )
    payload = e.filter(F.pmod("event_id", F.lit(3)) != 0).select(
        F.col("event_id").alias("api_request_log_id"), (F.col("event_id") * 2).alias("id"),
        F.col("event_type").alias("endpoint_type"), F.col("props").alias("payload_json"),
        F.sha2("props", 256).alias("payload_hash"), F.col("ts").alias("received_at"),
    )
    vacancy = c.select(
        F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("v"), F.col("c_custkey").cast("string")).alias("hh_vacancy_id"),
        F.col("c_name").alias("name_current"), F.col("c_mktsegment").alias("area_id"),
    )
    snapshot = o.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("vacancy_id"),
        F.when(F.col("o_orderstatus") == "F", "short").otherwise("detail").alias("snapshot_type"),
        F.col("o_orderdate").alias("captured_at"), F.col("o_orderkey").alias("short_payload_ref_id"),
        (F.col("o_orderkey") + 1).alias("detail_payload_ref_id"),
    )
    seen = o.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") + 100).cast("string").alias("vacancy_id"),
        F.col("o_orderdate").alias("seen_at"), F.col("o_orderkey").alias("short_payload_ref_id"),
    )
    state = o.groupBy(F.col("o_custkey").cast("string").alias("vacancy_id")).agg(
        F.max("o_orderdate").alias("last_seen_at"), F.count(F.lit(1)).cast("int").alias("seen_count")
    )
    tries = o.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("vacancy_id"),
        F.col("o_orderpriority").alias("reason"), F.col("o_orderdate").alias("requested_at"),
    )
    bound = {
        "api_request_log": log, "raw_api_payload": payload, "vacancy": vacancy, "vacancy_snapshot": snapshot,
        "vacancy_seen_event": seen, "vacancy_current_state": state, "detail_fetch_attempt": tries,
    }
    return {name: _complete(spark, df, TABLES[name]) for name, df in bound.items()}


def _complete(spark, df, ddl):
    """Columns the binding does not fill are null."""
    fields = spark.createDataFrame([], ddl).schema.fields
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields
    ])


PAYLOADS = "p as (select event_id as log_id, event_id * 2 as id, event_type, sha256(props) as h, ts, props from events where event_id % 3 <> 0)"


@query("S1_raw_payload_scan", f"with {PAYLOADS} select id as raw_api_payload_id, log_id as api_request_log_id, event_type as request_type, h as payload_hash, ts as received_at from p")
def s1(spark, d):
    rows = sc.dataset_rows(model_tables(spark, d), "bronze/raw_api_payload")
    return rows.select("raw_api_payload_id", "api_request_log_id", "request_type", "payload_hash", "received_at")


@query("S2_request_log_scan", f"with {PAYLOADS} select event_id as api_request_log_id, e.event_type as request_type, p.id as raw_api_payload_id, p.h as payload_hash from events e left join p on p.log_id = e.event_id")
def s2(spark, d):
    rows = sc.dataset_rows(model_tables(spark, d), "silver/api_request_log")
    return rows.select("api_request_log_id", "request_type", "raw_api_payload_id", "payload_hash")


@query("S3_vacancy_scan", "select cast(c_custkey as varchar) as vacancy_id, 'v' || c_custkey as hh_vacancy_id, c_name as name_current from customer")
def s3(spark, d):
    return sc.dataset_rows(model_tables(spark, d), "silver/vacancy").select("vacancy_id", "hh_vacancy_id", "name_current")


@query(
    "S4_snapshot_scan",
    f"""with {PAYLOADS} select o_orderkey as snapshot_id, 'v' || c_custkey as hh_vacancy_id, a.h as short_payload_hash, b.h as detail_payload_hash
from orders join customer on c_custkey = o_custkey left join p a on a.id = o_orderkey left join p b on b.id = o_orderkey + 1""",
)
def s4(spark, d):
    rows = sc.dataset_rows(model_tables(spark, d), "silver/vacancy_snapshot")
    return rows.select("snapshot_id", "hh_vacancy_id", "short_payload_hash", "detail_payload_hash")


@query(
    "S5_seen_event_scan",
    f"""with {PAYLOADS} select o_orderkey as seen_event_id, 'v' || c_custkey as hh_vacancy_id, p.h as short_payload_hash
from orders join customer on c_custkey = o_custkey + 100 left join p on p.id = o_orderkey""",
)
def s5(spark, d):
    rows = sc.dataset_rows(model_tables(spark, d), "silver/vacancy_seen_event")
    return rows.select("seen_event_id", "hh_vacancy_id", "short_payload_hash")


@query(
    "S6_current_state_scan",
    "select 'v' || o_custkey as hh_vacancy_id, max(o_orderdate) as last_seen_at, cast(count(*) as int) as seen_count from orders join customer on c_custkey = o_custkey group by o_custkey",
)
def s6(spark, d):
    return sc.dataset_rows(model_tables(spark, d), "silver/vacancy_current_state").select("hh_vacancy_id", "last_seen_at", "seen_count")


@query(
    "S7_attempt_scan",
    "select o_orderkey as detail_fetch_attempt_id, 'v' || c_custkey as hh_vacancy_id, o_orderpriority as reason from orders join customer on c_custkey = o_custkey",
)
def s7(spark, d):
    return sc.dataset_rows(model_tables(spark, d), "silver/detail_fetch_attempt").select("detail_fetch_attempt_id", "hh_vacancy_id", "reason")


@query(
    "S8_dataset_dispatch",
    f"""with {PAYLOADS} select 'bronze/raw_api_payload' as dataset_key, count(*) as row_count from p
union all select 'silver/api_request_log', count(*) from events union all select 'silver/vacancy', count(*) from customer
union all select 'silver/vacancy_snapshot', count(*) from orders join customer on c_custkey = o_custkey
union all select 'silver/vacancy_seen_event', count(*) from orders join customer on c_custkey = o_custkey + 100
union all select 'silver/vacancy_current_state', count(distinct o_custkey) from orders join customer on c_custkey = o_custkey
union all select 'silver/detail_fetch_attempt', count(*) from orders join customer on c_custkey = o_custkey""",
)
def s8(spark, d):
    tables = model_tables(spark, d)
    counts = [
        sc.dataset_rows(tables, key).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(key).alias("dataset_key"), "row_count")
        for key in sc.SCANS
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


SPEC = ar.DatasetSpec("silver/vacancy_seen_event", "seen_event_id", "seen_at", "event_type")
SETTLED = dt.datetime(2024, 1, 25)


def event_rows(spark, d):
    """Events as rows to export, with ids from one and a late arrival that is not settled."""
    late = F.col("event_id") == 0
    return table(spark, d, "events").select(
        (F.col("event_id") + 1).alias("seen_event_id"), F.col("user_id").alias("vacancy_id"), "event_type",
        F.col("ts").alias("seen_at"), F.when(late, None).otherwise(F.col("value")).alias("value"),
    )


ROWS = "rows_ as (select event_id + 1 as id, ts, event_type, value from events)"
READY = f"""
{ROWS}, ready as (select * from rows_ where id < (select min(id) from rows_ where ts > timestamp '2024-01-25'))
"""


@query("F5_settled_prefix", f"with {READY} select id as seen_event_id, ts as seen_at from ready where id > 100 order by id limit 3000")
def f5(spark, d):
    out = ar.settled_prefix(event_rows(spark, d), "seen_event_id", "seen_at", 100, as_of("2024-01-25"), 3000)
    return out.select("seen_event_id", "seen_at")


_EXPORTS: dict[tuple[str, str], str] = {}


def exported(spark, d):
    """Archive root holding two incremental exports of the events; made once per session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _EXPORTS:
        root = scratch_path(spark, "archive")
        rows = event_rows(spark, d)
        ar.export_incremental(rows, root, SPEC, dt.datetime(2024, 1, 12), rows_per_file=500, exported_at=dt.datetime(2024, 2, 1))
        ar.export_incremental(rows, root, SPEC, SETTLED, rows_per_file=500, exported_at=dt.datetime(2024, 2, 2))
        _EXPORTS[key] = root
    return _EXPORTS[key]


def archived(spark, d):
    schema = ar.enveloped(event_rows(spark, d), SPEC).schema
    return ar.read_dataset(spark, exported(spark, d), SPEC, schema)


@query("A1_partition_columns", "select event_id + 1 as seen_event_id, event_type as p_event_type, strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day from events")
def a1(spark, d):
    parts = ar.partition_columns(SPEC, as_of("2024-02-01"))
    return event_rows(spark, d).select("seen_event_id", *[c.alias(n) for n, c in parts.items()])


@query("A3_record_envelope", "select '1' as archive_schema_version, 'vacancy_seen_event' as dataset, event_id + 1 as seen_event_id from events")
def a3(spark, d):
    return ar.enveloped(event_rows(spark, d), SPEC).select("archive_schema_version", "dataset", "seen_event_id")


@query(
    "S9_archive_read",
    f"with {READY} select 'silver/vacancy_seen_event' as dataset_key, id as seen_event_id, ts as seen_at from ready",
)
def s9(spark, d):
    return archived(spark, d).select("dataset_key", "seen_event_id", "seen_at")


@query(
    "S10_archive_write",
    f"""with {READY} select event_type as p_event_type, strftime(ts, '%Y-%m-%d') as day, count(*) as row_count, true as gzip from ready group by 1, 2""",
)
def s10(spark, d):
    f = F.col("data_file")
    return archived(spark, d).groupBy(
        F.regexp_extract(f, "p_event_type=([^/]*)", 1).alias("p_event_type"),
        F.concat_ws("-", *[F.regexp_extract(f, f"{p}=([^/]*)", 1) for p in ("year", "month", "day")]).alias("day"),
    ).agg(F.count(F.lit(1)).alias("row_count"), F.bool_and(f.endswith(".json.gz")).alias("gzip"))


@query("A2_chunk_sizes", f"with {READY} select count(*) as row_count, true as within_limit, true as one_sequence_per_partition from ready")
def a2(spark, d):
    inv = ar.read_inventory(spark, exported(spark, d))
    spans = inv.groupBy("export_id", "partition").agg(
        F.sum(F.col("source_max_id") - F.col("source_min_id")).alias("s"), (F.max("source_max_id") - F.min("source_min_id")).alias("t")
    )
    return inv.agg(
        F.sum("row_count").alias("row_count"), (F.max("row_count") <= 500).alias("within_limit"),
    ).withColumn("one_sequence_per_partition", spans.agg(F.bool_and(F.col("s") <= F.col("t"))).scalar())


@query(
    "A4_manifest_ranges",
    f"""with {READY} select event_type, count(*) as row_count, min(id) as source_min_id, max(id) as source_max_id,
min(ts) as source_min_observed_at, max(ts) as source_max_observed_at from ready group by 1""",
)
def a4(spark, d):
    inv = ar.read_inventory(spark, exported(spark, d))
    return inv.groupBy(F.regexp_extract("partition", "p_event_type=([^/]*)", 1).alias("event_type")).agg(
        F.sum("row_count").alias("row_count"), F.min("source_min_id").alias("source_min_id"), F.max("source_max_id").alias("source_max_id"),
        F.min("source_min_observed_at").cast("timestamp_ntz").alias("source_min_observed_at"),
        F.max("source_max_observed_at").cast("timestamp_ntz").alias("source_max_observed_at"),
    )


@query("A5_inventory")
def a5(spark, d):
    return ar.read_inventory(spark, exported(spark, d)).select("dataset_key", "partition", "row_count", "source_min_id", "source_max_id", "format", "compression")


@query(
    "A5_inventory_totals",
    f"""with {READY} select 'silver/vacancy_seen_event' as dataset_key,
'p_event_type=' || event_type || '/' || strftime(ts, 'year=%Y/month=%m/day=%d') as partition,
count(*) as row_count, min(id) as source_min_id, max(id) as source_max_id, 'jsonl' as format, 'gzip' as compression, true as files_named
from ready group by all""",
)
def a5_totals(spark, d):
    """The inventory without what depends on the number of files."""
    inv = ar.read_inventory(spark, exported(spark, d))
    return inv.groupBy("dataset_key", "partition", "format", "compression").agg(
        F.sum("row_count").alias("row_count"), F.min("source_min_id").alias("source_min_id"), F.max("source_max_id").alias("source_max_id"),
        F.bool_and(F.col("export_id").isNotNull() & (F.col("row_count") > 0)).alias("files_named"),
    )


STEPS = f"""
{ROWS}, cut as (select (select min(id) from rows_ where ts > timestamp '2024-01-12') - 1 as a,
                       (select min(id) from rows_ where ts > timestamp '2024-01-25') - 1 as b)
"""


@query(
    "A6_checkpoints",
    f"""with {STEPS} select 0 as source_id_before, a as source_id_after, a as row_count from cut
union all select a, b, b - a from cut""",
)
def a6(spark, d):
    c = ar.read_checkpoints(spark, exported(spark, d))
    return c.select(F.col("source_id_before").cast("int").cast("long").alias("source_id_before"), "source_id_after", "row_count")


@query("A7_cursor", f"with {STEPS} select 'silver/vacancy_seen_event' as dataset_key, b as source_id from cut")
def a7(spark, d):
    return ar.cursors(ar.read_checkpoints(spark, exported(spark, d)), "incremental")


@query("A8_incremental_export", f"with {STEPS} select a as source_id_before, least(a + 700, b) as source_id_after, least(700, b - a) as row_count from cut")
def a8(spark, d):
    """A second, bounded export continues where the first one ended."""
    root = scratch_path(spark, "archive")
    rows = event_rows(spark, d)
    ar.export_incremental(rows, root, SPEC, dt.datetime(2024, 1, 12))
    out = ar.export_incremental(rows, root, SPEC, SETTLED, limit=700)
    return out.select("source_id_before", "source_id_after", "row_count")


@query("A9_verify_files", "select 'silver/vacancy_seen_event' as dataset_key, 0 as files_with_issue, true as has_files")
def a9(spark, d):
    root = exported(spark, d)
    inv = ar.read_inventory(spark, root)
    counts = archived(spark, d).groupBy("data_file").agg(F.count(F.lit(1)).alias("row_count"))
    checked = au.verify_files(inv, ar.file_digests(spark, f"{root}/data"), counts, inv, root)
    return checked.groupBy("dataset_key").agg(
        F.count("issue").cast("int").alias("files_with_issue"), (F.count(F.lit(1)) > 0).alias("has_files")
    )


def chain(spark, d):
    """Orders as a checkpoint chain per customer group, with some breaks, and one manifest each."""
    from sightline.operators.segments import with_lag

    o = table(spark, d, "orders").select(
        F.format_string("ds%d", F.pmod("o_custkey", F.lit(400))).alias("dataset_key"), F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"), (F.col("o_orderkey") + 1).alias("source_id_after"),
    )
    o = with_lag(o, ["dataset_key"], ["k"], {"p": "source_id_after"})
    broken = F.pmod("k", F.lit(97)) == 5
    points = o.select(
        F.format_string("%012d", "k").alias("checkpoint_id"), "dataset_key",
        F.timestamp_seconds(F.col("k")).alias("created_at"),
        (F.coalesce("p", F.lit(0)) + F.when(broken, 1).otherwise(0)).cast("long").alias("source_id_before"), "source_id_after",
        F.when(F.pmod("k", F.lit(101)) == 7, 2).otherwise(1).cast("long").alias("chunk_count"),
        F.lit(10).cast("long").alias("row_count"),
    )
    receipt = F.when(F.pmod("k", F.lit(103)) == 9, "receipt missing")
    files = o.select(
        F.format_string("%012d", "k").alias("checkpoint_id"), "dataset_key", F.format_string("m%d", "k").alias("manifest_file"),
        F.when(F.pmod("k", F.lit(107)) == 11, 9).otherwise(10).cast("long").alias("row_count"),
        F.col("source_id_after").alias("source_min_id"), F.col("source_id_after").alias("source_max_id"), receipt.alias("receipt_issue"),
    )
    return points, files


CHAIN = """
o as (select 'ds' || (o_custkey % 400) as dataset_key, o_orderkey as k, o_orderkey + 1 as after from orders),
j as (select *, case when k % 97 = 5 then 'chain break' when k % 101 = 7 then 'chunk count mismatch'
      when k % 103 = 9 then 'receipt missing' when k % 107 = 11 then 'row count mismatch' end as raw_issue from o),
b as (select dataset_key, min(k) filter (where raw_issue is not null) as bk from j group by 1),
audited as (select j.*, bk is null or k < bk as valid, case when k = bk then raw_issue end as issue from j join b using (dataset_key))
"""


@query("A10_chain_audit", f"with {CHAIN} select dataset_key, k + 1 as source_id_after, valid, issue from audited")
def a10(spark, d):
    return au.chain_audit(*chain(spark, d)).select("dataset_key", "source_id_after", "valid", "issue")


@query(
    "A12_coverage_summary",
    f"""with {CHAIN} select dataset_key, case when count(issue) = 0 then 'complete' else 'incomplete' end as status,
count(*) as scanned_checkpoint_count, count(*) filter (where valid) as verified_checkpoint_count,
count(*) filter (where valid) as verified_manifest_count, 10 * count(*) filter (where valid) as verified_row_count,
coalesce(max(after) filter (where valid), 0) as source_id_covered, max(issue) as issue from audited group by 1""",
)
def a12(spark, d):
    return au.coverage(au.chain_audit(*chain(spark, d)))


def bundles(spark, d):
    """Orders as archive bundles with receipts; some are missing or differ."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    m = o.select(
        F.format_string("m%d", k).alias("manifest_file"), F.lit("silver/vacancy").alias("dataset_key"), F.lit("silver").alias("layer"),
        F.col("o_custkey").alias("row_count"), (k * 10).alias("data_size_bytes"), F.sha2(k.cast("string"), 256).alias("data_sha256"),
        F.format_string("data/f%d", k).alias("data_file"), k.alias("k"),
    )
    r = m.filter(F.pmod("k", F.lit(5)) != 0).select(
        "manifest_file", "dataset_key", "layer", "row_count",
        F.when(F.pmod("k", F.lit(7)) == 0, -1).otherwise(F.col("data_size_bytes")).alias("data_size_bytes"), "data_sha256",
        F.lit("s3").alias("offsite_url"), F.when(F.pmod("k", F.lit(11)) == 0, "other").otherwise("root").alias("offsite_root"),
        F.when(F.pmod("k", F.lit(13)) == 0, 1).otherwise(2).alias("verified_object_count"), "k",
    )
    return m, r


@query(
    "A11_receipt_match",
    """select 'm' || o_orderkey as manifest_file, case when o_orderkey % 5 = 0 then 'receipt missing' when o_orderkey % 7 = 0 then 'receipt mismatch'
when o_orderkey % 11 = 0 then 'receipt target mismatch' when o_orderkey % 13 = 0 then 'receipt has too few objects' end as receipt_issue from orders""",
)
def a11(spark, d):
    m, r = bundles(spark, d)
    return au.with_receipts(m, r, "s3", "root").select("manifest_file", "receipt_issue")


@query("A13_copy_plan", "select 'm' || o_orderkey as manifest_file, case when o_orderkey % 5 <> 0 and o_orderkey % 7 <> 0 then 'skipped' else 'copy' end as action from orders")
def a13(spark, d):
    m, r = bundles(spark, d)
    return au.copy_plan(m, r).select("manifest_file", "action")


@query(
    "A14_replica_check",
    """select 'data/bronze/day=' || o_orderkey % 40 || '/f' || o_orderkey as data_file, case when o_orderkey % 40 < 20 then null
when o_orderkey % 5 = 0 then 'missing in replica' when o_orderkey % 7 = 0 then 'size differs' when o_orderkey % 11 = 0 then 'content differs' end as issue from orders
union all select 'data/bronze/day=99/f' || o_orderkey, 'unknown file in replica' from orders where o_orderkey % 13 = 0""",
)
def a14(spark, d):
    """Roots that hold a folder ``data`` themselves; half of the folders are alike."""
    k = F.col("k")
    name = F.concat(F.lit("data/bronze/day="), F.pmod(k, F.lit(40)).cast("string"), F.lit("/f"), k.cast("string"))
    files = bundles(spark, d)[0].select(name.alias("data_file"), "data_size_bytes", "data_sha256", "k")
    local = files.withColumn("data_file", F.concat(F.lit("file:///srv/data/arch/"), "data_file"))
    touched = F.pmod(k, F.lit(40)) >= 20
    damaged = F.when(touched & (F.pmod(k, F.lit(11)) == 0), F.lit("x")).otherwise(F.col("data_sha256"))
    size = F.when(touched & (F.pmod(k, F.lit(7)) == 0), -1).otherwise(F.col("data_size_bytes"))
    kept = files.filter(~touched | (F.pmod(k, F.lit(5)) != 0)).withColumns({"data_sha256": damaged, "data_size_bytes": size})
    more = files.filter(F.pmod(k, F.lit(13)) == 0).withColumn("data_file", F.concat(F.lit("data/bronze/day=99/f"), k.cast("string")))
    replica = kept.unionByName(more).withColumn("data_file", F.concat(F.lit("s3a://bucket/data/r/"), "data_file"))
    return au.replica_check(local, replica, "/srv/data/arch", "s3a://bucket/data/r/")


@query(
    "A15_prune_plan",
    """with p as (select o_orderkey as k, case when o_orderkey % 17 = 0 then 'already_pruned' when o_orderdate > timestamp '2001-01-01' then 'too_young'
  when o_orderkey % 5 = 0 or o_orderkey % 7 = 0 then 'upload_receipt_missing' when o_orderkey % 19 = 0 then 'verification_receipt_missing' else 'prune' end as action from orders)
select 'm' || k as manifest_file, action, case when action = 'prune' then k * 10 else 0 end as freed_bytes from p""",
)
def a15(spark, d):
    m, r = bundles(spark, d)
    times = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("modified_at"))
    files = m.filter(F.pmod("k", F.lit(17)) != 0).join(times, "k").select("data_file", "data_size_bytes", "modified_at")
    verified = r.filter(F.pmod("k", F.lit(19)) != 0)
    plan = au.prune_plan(m, files, r, verified, as_of("2001-01-31"), 30)
    return plan.select("manifest_file", "action", "freed_bytes")


@query(
    "T4_smallest_entries",
    """select 'm' || o_orderkey as manifest_file, o_orderkey * 10 as data_size_bytes from orders
where o_custkey > 0 and o_orderkey * 10 <= 50000 order by data_size_bytes, manifest_file limit 25""",
)
def t4(spark, d):
    return smallest_entries(bundles(spark, d)[0], ["silver/vacancy"], 50000, 25).select("manifest_file", "data_size_bytes")


@query(
    "S12_flatten_to_csv",
    """select cast(o_orderkey as varchar) as "id", cast(o_custkey as varchar) as "employer.id", o_orderpriority as "employer.area.name", '["' || o_orderstatus || '"]' as "tags" from orders""",
)
def s12(spark, d):
    """Nested rows written as CSV and read back."""
    nested = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("id"), F.struct(F.col("o_orderpriority").alias("name")).alias("area")).alias("employer"),
        F.array("o_orderstatus").alias("tags"),
    )
    path = scratch_path(spark, "csv")
    write_csv(nested, path)
    schema = ", ".join(f"`{c}` STRING" for c in flatten(nested).columns)
    return spark.read.schema(schema).csv(path, header=True, escape="\\")


@query(
    "S11_probe_log",
    """select endpoint_kind, status_code, count(*) as n from (select case when event_type = 'view' then 'search' else 'detail' end as endpoint_kind,
case when event_type = 'error' then 403 else 200 end as status_code from events) group by 1, 2""",
)
def s11(spark, d):
    """Probe records appended as JSON lines, blank lines between them, and read back."""
    from sightline.sources.tables import read_probe_log

    e = table(spark, d, "events").select(
        F.col("ts").cast("string").alias("timestamp_utc"), F.when(F.col("event_type") == "view", "search").otherwise("detail").alias("endpoint_kind"),
        F.when(F.col("event_type") == "error", 403).otherwise(200).alias("status_code"), F.col("value").alias("latency_ms"),
    )
    path = scratch_path(spark, "probe")
    e.select(F.concat(F.to_json(F.struct(*e.columns)), F.lit("\n")).alias("value")).write.text(path)
    log = read_probe_log(spark, path)
    return log.groupBy("endpoint_kind", "status_code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "S14_report_rows",
    """with r as (select count(*) as n, min(o_orderdate) as a from orders) select 'orders' as metric, cast(n as varchar) as value from r
union all select 'first_order', strftime(a, '%Y-%m-%d %H:%M:%S') from r union all select 'nothing', '-' from r""",
)
def s14(spark, d):
    one = table(spark, d, "orders").agg(
        F.count(F.lit(1)).alias("orders"), F.date_format(F.min("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("first_order"),
        F.max(F.when(F.col("o_orderkey") < 0, F.col("o_orderkey"))).alias("nothing"),
    )
    return report_rows(one)
