"""Coverage queries: orders as a partition tree, region / nation / customer as an area hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.functions import json_ops as j
from sightline.operators import coverage as cov
from sightline.operators import hierarchy as hy
from sightline.operators.segments import with_running
from sightline.plans.bindings import PARTITIONS, as_of, partitions, table
from sightline.plans.registry import query


def areas(spark, d):
    """Regions over nations over customers; some customers are inactive."""
    nothing = F.lit(None).cast("string")
    active = F.lit(True)
    r = table(spark, d, "region").select(
        F.format_string("r%d", "r_regionkey").alias("id"), F.format_string("R%d", "r_regionkey").alias("hh_area_id"),
        F.col("r_name").alias("name"), nothing.alias("parent_area_id"), F.lit(0).alias("level"),
        F.col("r_name").alias("path_text"), active.alias("is_active"),
    )
    nn = table(spark, d, "nation").select(
        F.format_string("n%d", "n_nationkey").alias("id"), F.format_string("N%d", "n_nationkey").alias("hh_area_id"),
        F.col("n_name").alias("name"), F.format_string("r%d", "n_regionkey").alias("parent_area_id"),
        F.lit(1).alias("level"), F.col("n_name").alias("path_text"), (F.col("n_nationkey") != 7).alias("is_active"),
    )
    c = table(spark, d, "customer").select(
        F.format_string("c%d", "c_custkey").alias("id"), F.format_string("C%d", "c_custkey").alias("hh_area_id"),
        F.col("c_name").alias("name"), F.format_string("n%d", "c_nationkey").alias("parent_area_id"),
        F.lit(2).alias("level"), F.when(F.pmod("c_custkey", F.lit(4)) != 0, F.col("c_name")).alias("path_text"),
        ((F.pmod("c_custkey", F.lit(5)) != 0) & (F.col("c_nationkey") % 2 == 0)).alias("is_active"),
    )
    return r.unionByName(nn).unionByName(c)


AREAS = """
areas as (
  select 'r' || r_regionkey as id, 'R' || r_regionkey as hh_area_id, r_name as name, null as parent_area_id, 0 as level,
         r_name as path_text, true as is_active from region
  union all select 'n' || n_nationkey, 'N' || n_nationkey, n_name, 'r' || n_regionkey, 1, n_name, n_nationkey <> 7 from nation
  union all select 'c' || c_custkey, 'C' || c_custkey, c_name, 'n' || c_nationkey, 2,
         case when c_custkey % 4 <> 0 then c_name end, c_custkey % 5 <> 0 and c_nationkey % 2 = 0 from customer)
"""


@query(
    "F7_saturation",
    f"""with {PARTITIONS} select id, coalesce(greatest(pages_total_expected, 0) >= 100, false) as is_saturated,
case when greatest(pages_total_expected, 0) >= 100 then 'too many pages: ' || pages_total_expected || ' >= 100' end as reason from parts""",
)
def saturation(spark, d):
    pages = F.col("pages_total_expected")
    return partitions(spark, d).select("id", cov.is_saturated(pages).alias("is_saturated"), cov.saturation_reason(pages).alias("reason"))


@query("F8_active_root_areas", f"with {AREAS} select hh_area_id, name from areas where is_active and parent_area_id is null")
def roots(spark, d):
    return hy.active_roots(areas(spark, d)).orderBy(*hy.area_order()).select("hh_area_id", "name")


@query(
    "F8_active_children",
    f"""with {AREAS} select p.hh_area_id as parent_hh_area_id, a.hh_area_id from areas a
join areas p on p.id = a.parent_area_id where a.is_active""",
)
def children(spark, d):
    return hy.active_children(areas(spark, d)).select("parent_hh_area_id", "hh_area_id")


@query(
    "J9_leaf_children",
    f"""with {AREAS} select a.hh_area_id, a.level, a.path_text from areas a join areas p on p.id = a.parent_area_id
where p.hh_area_id = 'R2' and a.is_active and not exists (
  select 1 from areas c where c.parent_area_id = a.id and c.is_active)""",
)
def leaves(spark, d):
    return hy.leaf_children(areas(spark, d), "R2").select("hh_area_id", "level", "path_text")


@query(
    "F9_pending_terminal",
    f"""with {PARTITIONS} select id, partition_key from parts where crawl_run_id = '1997' and is_terminal and status = 'pending'
order by partition_key, id limit 50""",
)
def pending(spark, d):
    p = cov.pending_terminal(partitions(spark, d)).filter("crawl_run_id = '1997'")
    return p.orderBy("partition_key", "id").limit(50).select("id", "partition_key")


@query(
    "F9_pending_terminal_counts",
    f"with {PARTITIONS} select crawl_run_id, count(*) as pending_count from parts where is_terminal and status = 'pending' group by 1",
)
def pending_counts(spark, d):
    return cov.pending_terminal(partitions(spark, d)).groupBy("crawl_run_id").agg(F.count(F.lit(1)).alias("pending_count"))


def run_rows(spark, d):
    status = (
        F.when(F.col("crawl_run_id") == "1995", "created").when(F.col("crawl_run_id") == "1996", "failed")
        .when(F.col("crawl_run_id") == "1997", "completed_with_unresolved").otherwise("succeeded")
    )
    runs = partitions(spark, d).groupBy("crawl_run_id").agg(F.min("created_at").alias("started_at"))
    return runs.withColumn("run_status", status)


RUNS = f"""
{PARTITIONS}, runs as (select crawl_run_id, min(created_at) as started_at, case crawl_run_id when '1995' then 'created'
  when '1996' then 'failed' when '1997' then 'completed_with_unresolved' else 'succeeded' end as run_status
  from parts group by 1)
"""


@query(
    "F10_latest_run",
    f"with {RUNS} select * from runs where run_status in ('failed', 'created') order by started_at desc, crawl_run_id desc limit 1",
)
def latest_run(spark, d):
    return cov.latest_run(run_rows(spark, d), ["failed", "created"])


SUMMARY = """
summary as (
  select p.crawl_run_id, count(*) as total_partitions,
    count(*) filter (where q.id is null) as root_partitions,
    count(*) filter (where p.is_terminal) as terminal_partitions,
    count(*) filter (where p.is_terminal and p.coverage_status = 'covered') as covered_terminal_partitions,
    count(*) filter (where p.status = 'pending') as pending_partitions,
    count(*) filter (where p.is_terminal and p.status = 'pending') as pending_terminal_partitions,
    count(*) filter (where p.status = 'running') as running_partitions,
    count(*) filter (where p.status in ('split_required', 'split_done') or p.coverage_status in ('saturated', 'split')) as split_partitions,
    count(*) filter (where p.status = 'unresolved' or p.coverage_status = 'unresolved') as unresolved_partitions,
    count(*) filter (where p.status = 'failed') as failed_partitions
  from parts p left join parts q on q.id = p.parent_partition_id and q.crawl_run_id = p.crawl_run_id group by 1)
"""


@query(
    "C1_coverage_summary",
    f"""with {PARTITIONS}, {SUMMARY} select *,
case when terminal_partitions > 0 then covered_terminal_partitions / terminal_partitions else 0.0 end as coverage_ratio,
terminal_partitions > 0 and covered_terminal_partitions = terminal_partitions
  and pending_terminal_partitions + running_partitions + unresolved_partitions + failed_partitions = 0 as is_fully_covered from summary""",
)
def summary(spark, d):
    return cov.coverage_summary(partitions(spark, d))


@query(
    "C12_stage_status",
    f"""with {PARTITIONS}, {SUMMARY} select crawl_run_id, case
when terminal_partitions > 0 and covered_terminal_partitions = terminal_partitions
  and pending_terminal_partitions + running_partitions + unresolved_partitions + failed_partitions = 0 then 'completed'
when failed_partitions > 0 then 'failed' when unresolved_partitions > 0 then 'completed_with_unresolved'
when pending_terminal_partitions = 0 and running_partitions = 0 then 'failed' end as stage_status from summary""",
)
def stage(spark, d):
    return cov.stage_status(cov.coverage_summary(partitions(spark, d))).select("crawl_run_id", "stage_status")


@query(
    "F11_resumable_runs",
    f"""with {RUNS}, {SUMMARY}, j as (select runs.crawl_run_id, case
  when run_status not in ('created', 'completed_with_unresolved', 'failed') then 'status=' || run_status
  when run_status = 'failed' and failed_partitions + unresolved_partitions + pending_terminal_partitions + running_partitions = 0
       and covered_terminal_partitions <> terminal_partitions then 'failed run has nothing to resume' end as refused_reason
  from runs join summary using (crawl_run_id))
select *, refused_reason is null as can_resume from j""",
)
def resumable(spark, d):
    out = cov.resumable(run_rows(spark, d), cov.coverage_summary(partitions(spark, d)))
    return out.select("crawl_run_id", "refused_reason", "can_resume")


@query(
    "F12_runnable_partitions",
    f"""with {PARTITIONS} select id, case when id % 13 = 0 then 'policy version v1' when not is_terminal then 'partition is not terminal'
when coverage_status = 'covered' then 'partition is already covered'
when status not in ('pending', 'running', 'done') then 'status=' || status end as refused_reason from parts""",
)
def runnable(spark, d):
    p = partitions(spark, d).withColumn(
        "planner_policy_version", F.when(F.pmod("id", F.lit(13)) == 0, "v1").otherwise("v2")
    )
    return cov.runnable(p).select("id", "refused_reason")


@query(
    "J11_orphan_tolerant_roots",
    f"""with {PARTITIONS} select p.id, q.id is null as is_root from parts p
left join parts q on q.id = p.parent_partition_id and q.crawl_run_id = p.crawl_run_id""",
)
def orphan_roots(spark, d):
    out = hy.with_root_flag(partitions(spark, d), "id", "parent_partition_id", ["crawl_run_id"])
    return out.select("id", "is_root")


@query(
    "C2_coverage_tree",
    f"""with recursive {PARTITIONS}, keyed as (
  select *, {{'d': id % 3, 's': coalesce(case when id % 5 <> 0 then 'area:' || (id % 13) end, partition_key), 'k': partition_key, 'i': cast(id as varchar)}} as step from parts),
t as (
  select crawl_run_id, id, 0 as tree_level, id as root_id, [step] as path from keyed k
  where parent_partition_id is null or not exists (select 1 from parts p where p.crawl_run_id = k.crawl_run_id and p.id = k.parent_partition_id)
  union all
  select p.crawl_run_id, p.id, t.tree_level + 1, t.root_id, list_append(t.path, p.step)
  from keyed p join t on p.crawl_run_id = t.crawl_run_id and p.parent_partition_id = t.id)
select crawl_run_id, id, tree_level, root_id, row_number() over (partition by crawl_run_id order by path) as tree_position from t""",
)
def tree(spark, d):
    """The tree of each run; siblings by depth, scope, key and id as text, partitions without a parent in the run as roots."""
    k = F.col("id")
    scope_key = F.when(F.pmod(k, F.lit(5)) != 0, F.concat(F.lit("area:"), F.pmod(k, F.lit(13)).cast("string")))
    rows = partitions(spark, d).withColumns({"depth": F.pmod(k, F.lit(3)), "scope": F.coalesce(scope_key, "partition_key"), "text_id": k.cast("string")})
    return hy.walk(rows, "id", "parent_partition_id", ["depth", "scope", "partition_key", "text_id"], ["crawl_run_id"])


@query(
    "C3_root_plan",
    f"""with {AREAS} select 'area:' || hh_area_id as partition_key, 0 as depth, hh_area_id as split_value,
'{{"planner_policy":"area_exhaustive_v2","planner_policy_version":"v2","scope":{{"dimension":"area","scope_key":"area:' || hh_area_id
|| '","hh_area_id":"' || hh_area_id || '","area_name":"' || name || '","path_text":"' || path_text
|| '","depth":0}},"params":{{"area":"' || hh_area_id || '","page":0,"per_page":20}},"run_type":"weekly_sweep"}}' as params_json
from areas where is_active and parent_area_id is null""",
)
def root_plan(spark, d):
    planned = cov.area_partitions(hy.active_roots(areas(spark, d)), "weekly_sweep")
    return planned.select("partition_key", "depth", "split_value", "params_json")


@query(
    "C4_split_to_child_areas",
    f"""with {AREAS} select p.id as parent_partition_id, 'area:' || a.hh_area_id as partition_key, p.level + 1 as depth
from areas p join areas a on a.parent_area_id = p.id where a.is_active""",
)
def split_areas(spark, d):
    a = areas(spark, d)
    saturated = a.select("id", F.col("level").alias("depth"), F.col("hh_area_id").alias("area"))
    return cov.split_to_areas(saturated, a, "weekly_sweep").select("parent_partition_id", "partition_key", "depth")


def windows(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("window_from"),
        (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.pmod("o_custkey", F.lit(1000))).alias("window_to"),
    )


WINDOWS = """
w as (select o_orderkey as id, cast(epoch(o_orderdate) as bigint) as a,
             cast(epoch(o_orderdate) as bigint) + o_custkey % 1000 as b from orders)
"""


@query(
    "C5_bisect_windows",
    f"""with {WINDOWS} select id, false as unresolved, a as window_from, a + (b - a) // 2 as window_to from w where b - a >= 2
union all select id, false, a + (b - a) // 2, b from w where b - a >= 2
union all select id, true, a, b from w where b - a < 2""",
)
def bisect(spark, d):
    return cov.bisected(windows(spark, d)).select("id", "unresolved", "window_from", "window_to")


SPLIT_RUN = "2024-01-30 12:00:00"

_STAMP = "strftime(make_timestamp({} * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_SHORT = "strftime(make_timestamp({} * 1000000), '%Y%m%dT%H%M%SZ')"

SATURATED = f"""
{AREAS}, numbered as (select *, cast(substr(id, 2) as bigint) as n from areas),
saturated as (
  select id, level as depth, name as area_name, path_text,
         case when level = 2 and n % 11 = 0 then 'role' when level = 2 and n % 3 = 0 then 'time_window' else 'area' end as split_dimension,
         case when level = 2 and n % 13 = 0 then null else hh_area_id end as area,
         case when level = 2 and n % 3 = 0 then 1700000000 + n * 1000 end as a,
         case when level = 2 and n % 3 = 0 then 1700000000 + n * 1000 + n % 7 end as b
  from numbered),
able as (select * from saturated where split_dimension in ('area', 'time_window') and area is not null),
kids as (select p.hh_area_id as parent, k.* from areas k join areas p on k.parent_area_id = p.id where k.is_active),
windows as (
  select * exclude (a, b), coalesce(a, {cov.FALLBACK_WINDOW_START}) as a, coalesce(b, cast(epoch(timestamp '{SPLIT_RUN}') as bigint)) as b from able
  where split_dimension = 'time_window' or not exists (select 1 from kids where kids.parent = able.area)),
halves as (
  select *, a as f, a + (b - a) // 2 as t from windows where b - a >= 2
  union all select *, a + (b - a) // 2, b from windows where b - a >= 2),
named as (select *, 'time_window:' || area || ':' || {_SHORT.format("f")} || ':' || {_SHORT.format("t")} as key,
                 {_STAMP.format("f")} as df, {_STAMP.format("t")} as dt from halves)
"""


def saturated(spark, d):
    a = areas(spark, d).withColumn("n", F.substring("id", 2, 20).cast("long"))
    third = (F.col("level") == 2) & (F.col("n") % 3 == 0)
    start = F.lit(1700000000) + F.col("n") * 1000
    return a.select(
        "id", F.col("level").alias("depth"), F.col("name").alias("area_name"), "path_text",
        F.when((F.col("level") == 2) & (F.col("n") % 11 == 0), "role").when(third, "time_window").otherwise("area").alias("split_dimension"),
        F.when((F.col("level") != 2) | (F.col("n") % 13 != 0), F.col("hh_area_id")).alias("area"),
        F.when(third, start).alias("window_from"), F.when(third, start + F.col("n") % 7).alias("window_to"),
    )


def split_plan(spark, d):
    return cov.split_saturated(saturated(spark, d), areas(spark, d), "weekly_sweep", as_of(SPLIT_RUN))


@query(
    "C5_split_saturated",
    f"""with {SATURATED}
select p.id as parent_partition_id, 'area:' || k.hh_area_id as partition_key, cast(p.depth + 1 as int) as depth,
       'area' as split_dimension, k.hh_area_id as split_value,
       cast(to_json({{'planner_policy': '{cov.POLICY}', 'planner_policy_version': '{cov.POLICY_VERSION}',
         'scope': {{'dimension': 'area', 'scope_key': 'area:' || k.hh_area_id, 'hh_area_id': k.hh_area_id, 'area_name': k.name, 'path_text': k.path_text, 'depth': p.depth + 1}},
         'params': {{'area': k.hh_area_id, 'page': 0, 'per_page': {cov.LIST_PAGE_SIZE}}}, 'run_type': 'weekly_sweep'}}) as varchar) as params_json
from able p join kids k on k.parent = p.area where p.split_dimension = 'area'
union all
select id, key, cast(depth + 1 as int), 'time_window', df || '|' || dt,
       cast(to_json({{'planner_policy': '{cov.POLICY}', 'planner_policy_version': '{cov.POLICY_VERSION}',
         'scope': {{'dimension': 'time_window', 'scope_key': key, 'hh_area_id': area, 'area_name': area_name, 'path_text': path_text, 'depth': depth + 1, 'date_from': df, 'date_to': dt}},
         'params': {{'area': area, 'date_from': df, 'date_to': dt, 'page': 0, 'per_page': {cov.LIST_PAGE_SIZE}}}, 'run_type': 'weekly_sweep'}}) as varchar)
from named""",
)
def split_children(spark, d):
    return split_plan(spark, d)[0].drop("scope_key")


@query(
    "C5_split_unresolved",
    f"""with {SATURATED}
select id as parent_partition_id, 'window cannot be halved; area=' || area || ' interval=' || {_STAMP.format("a")} || '..' || {_STAMP.format("b")} as message
from windows where b - a < 2
union all select id, 'partition cannot be split' from saturated where split_dimension = 'role' or area is null""",
)
def split_unresolved(spark, d):
    return split_plan(spark, d)[1]


@query(
    "C6_scope_keys",
    """select o_orderkey as id, 'area:' || o_custkey as area_key, 'time_window:' || o_custkey || ':' ||
strftime(o_orderdate, '%Y%m%dT%H%M%SZ') || ':' || strftime(o_orderdate + to_seconds(o_custkey % 1000), '%Y%m%dT%H%M%SZ') as window_key
from orders""",
)
def scope_keys(spark, d):
    w = windows(spark, d).join(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey"), "id")
    area = F.format_string(" %d ", "o_custkey")
    return w.select(
        "id",
        cov.area_scope_key(area).alias("area_key"),
        cov.window_scope_key(area, F.col("window_from"), F.col("window_to")).alias("window_key"),
    )


def child_plan(spark, d):
    existing = partitions(spark, d).filter("id % 3 = 0").select(
        "crawl_run_id", F.format_string("k%d", "id").alias("partition_key"), "parent_partition_id"
    )
    planned = partitions(spark, d).select(
        "crawl_run_id", F.format_string("k%d", "id").alias("partition_key"),
        F.when(F.col("id") % 5 == 0, F.lit(-1).cast("long")).otherwise(F.col("parent_partition_id")).alias("parent_partition_id"),
    )
    return cov.new_children(existing, planned)


@query(
    "C7_new_children",
    f"with {PARTITIONS} select crawl_run_id, 'k' || id as partition_key from parts where id % 3 <> 0",
)
def new_children(spark, d):
    return child_plan(spark, d)[0].select("crawl_run_id", "partition_key")


@query(
    "C7_scope_conflicts",
    f"""with {PARTITIONS} select 'k' || id as partition_key, parent_partition_id as owner_partition_id from parts
where id % 3 = 0 and id % 5 = 0""",
)
def conflicts(spark, d):
    return child_plan(spark, d)[1].select("partition_key", "owner_partition_id")


@query(
    "C8_scope_extraction",
    """select o_orderkey as id, case o_orderkey % 4 when 0 then 'v' || o_custkey else cast(o_custkey as varchar) end as area,
case when o_orderkey % 4 <> 3 then cast(epoch(o_orderdate) as bigint) end as window_from,
case when o_orderkey % 4 <> 3 then cast(epoch(o_orderdate) as bigint) + 3600 end as window_to from orders""",
)
def extraction(spark, d):
    by = F.pmod("o_orderkey", F.lit(4))
    start = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    window = F.concat(
        F.lit('"date_from":"'), cov.window_text(start), F.lit('","date_to":"'), cov.window_text(start + 3600), F.lit('"')
    )
    area = F.col("o_custkey").cast("string")
    in_params = F.concat(F.lit('{"params":{"area":" '), area, F.lit(' ",'), window, F.lit("}}"))
    in_scope = F.concat(F.lit('{"params":{"page":0},"scope":{"hh_area_id":"'), area, F.lit('",'), window, F.lit("}}"))
    none = F.concat(F.lit('{"params":{"area":"'), area, F.lit('","date_from":"2024-01-01","date_to":"x"}}'))
    params = F.when(by < 2, in_params).when(by == 2, in_scope).otherwise(none)
    t = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), j.parse(params).alias("p"),
        F.when(by == 0, "area").otherwise("time_window").alias("dim"), F.concat(F.lit("v"), area).alias("value"),
    )
    out = t.withColumn("w", cov.partition_window(F.col("p")))
    return out.select(
        "id", cov.partition_area(F.col("p"), F.col("dim"), F.col("value")).alias("area"),
        F.col("w.window_from").alias("window_from"), F.col("w.window_to").alias("window_to"),
    )


def page_log(spark, d):
    """Events as list pages: partition = user and type, run = week."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("event_id").alias("id"),
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("crawl_run_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type")).alias("partition_id"),
        F.col("ts").alias("page_at"),
        (F.pmod(k, F.lit(10)) == 0).alias("failed"),
        F.when(F.pmod(k, F.lit(10)) == 0, F.when(F.pmod(k, F.lit(20)) == 0, "captcha_required").otherwise("transport")).alias("error_type"),
        k.cast("long").alias("vacancy_id"),
        (F.pmod(k, F.lit(3)) == 0).alias("created"),
        F.pmod("event_id", F.lit(110)).cast("int").alias("pages_total_expected"),
    )


PAGES = """
pages_ as (
  select event_id as id, strftime(date_trunc('week', ts), '%Y-%m-%d') as crawl_run_id,
         user_id || '-' || event_type as partition_id, ts as page_at, k % 10 = 0 as failed,
         case when k % 20 = 0 then 'captcha_required' when k % 10 = 0 then 'transport' end as error_type,
         k as vacancy_id, k % 3 = 0 as created, cast(event_id % 110 as int) as pages_total_expected
  from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events)),
totals as (
  select crawl_run_id, partition_id, count(*) as pages_attempted, count(*) filter (where not failed) as pages_processed,
         count(distinct vacancy_id) filter (where not failed) as vacancies_found,
         count(*) filter (where not failed and created) as vacancies_created,
         arg_min(error_type, (page_at, id)) filter (where failed) as first_error_type,
         min(page_at) filter (where failed) as first_failure_at
  from pages_ group by 1, 2)
"""


@query("G15_partition_totals", f"with {PAGES} select * from totals")
def partition_totals(spark, d):
    return cov.partition_totals(page_log(spark, d), ["crawl_run_id", "partition_id"])


@query(
    "G15_stage_totals",
    f"""with {PAGES} select crawl_run_id, count(*) as partitions_attempted,
count(*) filter (where first_failure_at is null) as partitions_completed,
count(*) filter (where first_failure_at is not null) as partitions_failed,
cast(sum(pages_attempted) as bigint) as pages_attempted, cast(sum(pages_processed) as bigint) as pages_processed,
cast(sum(vacancies_found) as bigint) as vacancies_found, cast(sum(vacancies_created) as bigint) as vacancies_created
from totals group by 1""",
)
def stage_totals(spark, d):
    return cov.stage_totals(partition_totals(spark, d), ["crawl_run_id"])


@query(
    "C9_status_roll_up",
    f"""with {PAGES}, g as (select crawl_run_id, partition_id, count(*) filter (where not failed) as pages_processed,
  bool_or(failed) as any_failed, arg_min(pages_total_expected, (page_at, id)) filter (where not failed) as pages_total_expected
  from pages_ group by 1, 2), s as (
select crawl_run_id, partition_id, pages_processed, pages_total_expected,
  case when pages_total_expected >= 100 then 'split_required' when any_failed then 'failed'
       when pages_processed >= greatest(coalesce(pages_total_expected, 0), 1) then 'done' else 'pending' end as status from g)
select *, case status when 'split_required' then 'saturated' when 'done' then 'covered' else 'unassessed' end as coverage_status from s""",
)
def roll_up(spark, d):
    return cov.roll_up_status(page_log(spark, d), ["crawl_run_id", "partition_id"])


@query(
    "G14_completion_counts",
    f"""with {PARTITIONS} select crawl_run_id, count(*) as partitions_total,
count(*) filter (where status in ('done', 'split_done')) as partitions_done,
count(*) filter (where status in ('failed', 'unresolved')) as partitions_failed from parts group by 1""",
)
def completion(spark, d):
    return cov.completion_counts(partitions(spark, d))


@query(
    "M16_requeue",
    f"""with {PARTITIONS} select id, case when is_terminal and status = 'unresolved' then 'pending' else status end as status,
case when is_terminal and status = 'unresolved' then 'unassessed' else coverage_status end as coverage_status,
cast(retry_count + case when is_terminal and status = 'unresolved' then 1 else 0 end as int) as retry_count,
is_terminal and status = 'unresolved' as requeued from parts""",
)
def requeue(spark, d):
    return cov.requeue(partitions(spark, d), "unresolved").select("id", "status", "coverage_status", "retry_count", "requeued")


def partition_events(spark, d):
    names = ["running", "pending", "covered", "split_required", "split_done", "unresolved", "failed"]
    k = F.pmod("event_id", F.lit(len(names))).cast("int")
    e = table(spark, d, "events")
    return e.select(
        F.col("event_id").alias("id"), F.col("ts").alias("at"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type")).alias("partition_id"),
        F.element_at(F.array(*[F.lit(x) for x in names]), k + 1).alias("event"),
        F.concat(F.lit("error "), F.col("event_id").cast("string")).alias("error"),
    )


@query(
    "C13_partition_state_machine",
    """with e as (select event_id as id, ts as t, user_id || '-' || event_type as partition_id,
  ['running', 'pending', 'covered', 'split_required', 'split_done', 'unresolved', 'failed'][event_id % 7 + 1] as event from events),
last as (select partition_id, arg_max(event, (t, id)) as event, arg_max(t, (t, id)) as t, arg_max(id, (t, id)) as id,
  min(t) filter (where event in ('running', 'failed')) as started_at,
  arg_max(event, (t, id)) filter (where event in ('covered', 'split_required', 'split_done', 'unresolved')) as setter
  from e group by 1)
select partition_id, case event when 'covered' then 'done' else event end as status,
  case setter when 'covered' then true when 'unresolved' then true when 'split_required' then false when 'split_done' then false else true end as is_terminal,
  coalesce(setter <> 'covered', false) as is_saturated,
  case setter when 'split_required' then 'saturated' when 'split_done' then 'split' when 'covered' then 'covered'
       when 'unresolved' then 'unresolved' else 'unassessed' end as coverage_status,
  started_at, case when event in ('covered', 'split_done', 'unresolved', 'failed') then t end as finished_at,
  case when event in ('failed', 'unresolved') then 'error ' || id end as last_error_message from last""",
)
def state_machine(spark, d):
    return cov.partition_states(partition_events(spark, d))


@query(
    "C14_children_in_order",
    f"with {PARTITIONS} select parent_partition_id, id, partition_key from parts where parent_partition_id is not null and crawl_run_id = '1998'",
)
def ordered_children(spark, d):
    p = partitions(spark, d).filter("crawl_run_id = '1998' and parent_partition_id is not null")
    return p.orderBy("parent_partition_id", "partition_key", "id").select("parent_partition_id", "id", "partition_key")


DENSE = 500


@query(
    "C10_split_to_fixpoint",
    f"""with recursive cells as (select event_type as area, cast(floor(epoch(ts)) as bigint) as s from events),
roots as (select area, min(s) as a, max(s) + 1 as b from cells group by 1),
w as (
  select area, a, b, 0 as depth, (select count(*) from cells c where c.area = roots.area and c.s >= roots.a and c.s < roots.b) as n from roots
  union all
  select h.area, h.a, h.b, h.depth, count(c.s) as n from (
    select area, case when side = 0 then a else a + (b - a) // 2 end as a, case when side = 0 then a + (b - a) // 2 else b end as b,
           depth + 1 as depth from w, (values (0), (1)) t(side) where n > {DENSE} and b - a >= 2) h
  left join cells c on c.area = h.area and c.s >= h.a and c.s < h.b group by 1, 2, 3, 4)
select area, a as window_from, b as window_to, depth, cast(n as bigint) as row_count,
       case when n <= {DENSE} then 'covered' when b - a < 2 then 'unresolved' else 'split' end as status from w""",
)
def fixpoint(spark, d):
    cells = table(spark, d, "events").select(
        F.col("event_type").alias("area"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("s")
    )
    roots_ = cells.groupBy("area").agg(F.min("s").alias("window_from"), (F.max("s") + 1).alias("window_to"))
    out = cov.split_to_fixpoint(cells, roots_, "area", "s", DENSE)
    return out.select("area", "window_from", "window_to", "depth", "row_count", "status")


@query(
    "C11_trailing_windows",
    """select event_type, label, count(*) filter (where ts >= timestamp '2024-01-30' - to_hours(h) and ts < timestamp '2024-01-30') as row_count
from events, (values ('trailing_1h', 1), ('trailing_6h', 6), ('trailing_24h', 24), ('trailing_7d', 168)) t(label, h) group by 1, 2""",
)
def trailing(spark, d):
    return cov.trailing_counts(table(spark, d, "events"), "ts", as_of("2024-01-30"), ["event_type"])
