"""Upsert queries: customers as dimension rows, even keys stored, keys not divisible by three arriving."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.functions.scalars import response_error
from sightline.operators import normalize as n
from sightline.operators import upsert as u
from sightline.plans.bindings import ATTEMPTS, SEEN, STATE, as_of, attempts, current_state, table
from sightline.plans.payloads import AREAS_SQL, area_trees
from sightline.plans.registry import query


def _key():
    return F.col("c_custkey")


def stored(spark, d):
    return table(spark, d, "customer").filter(F.pmod("c_custkey", F.lit(2)) == 0)


def arriving(spark, d):
    return table(spark, d, "customer").filter(F.pmod("c_custkey", F.lit(3)) != 0)


BOTH = """
o as (select * from customer where c_custkey % 2 = 0),
n as (select * from customer where c_custkey % 3 <> 0)
"""


def area_sync(spark, d):
    old = stored(spark, d).select(
        _key().cast("string").alias("hh_area_id"),
        F.col("c_name").alias("name"),
        F.lit(0).alias("level"),
        (F.pmod(_key(), F.lit(10)) != 0).alias("is_active"),
        F.lit(None).cast("string").alias("parent_hh_area_id"),
    )
    parent = F.when(_key() >= 10, F.floor(_key() / 10).cast("string"))
    new = arriving(spark, d).select(
        _key().cast("string").alias("hh_area_id"),
        F.concat(F.col("c_name"), F.lit("*")).alias("name"),
        F.lit(1).alias("level"),
        parent.alias("parent_hh_area_id"),
    )
    return u.sync_dictionary(old, new, "hh_area_id", ["name", "level", "parent_hh_area_id"])


AREA_SYNC = f"""
{BOTH}, merged as (
  select coalesce(o.c_custkey, n.c_custkey) as k,
         case when n.c_custkey is not null then n.c_name || '*' else o.c_name end as name,
         case when n.c_custkey is not null then 1 else 0 end as level, n.c_custkey is not null as is_active,
         case when n.c_custkey >= 10 then cast(n.c_custkey // 10 as varchar) end as parent_hh_area_id,
         case when o.c_custkey is null then 'created' when n.c_custkey is not null then 'updated'
              when o.c_custkey % 10 <> 0 then 'deactivated' else 'kept' end as change
  from o full join n on n.c_custkey = o.c_custkey)
"""


@query(
    "M1_area_upsert",
    f"""with {AREA_SYNC}
select cast(m.k as varchar) as hh_area_id, m.name, m.level, m.is_active,
       case when p.k is not null then sha256(cast(p.k as varchar)) end as parent_area_id
from merged m left join merged p on cast(p.k as varchar) = m.parent_hh_area_id""",
)
def area_upsert(spark, d):
    rows = area_sync(spark, d).withColumn("id", u.surrogate_id(F.col("hh_area_id")))
    out = u.resolve_parents(rows, "hh_area_id", "parent_hh_area_id", "id", "parent_area_id")
    return out.select("hh_area_id", "name", "level", "is_active", "parent_area_id")


@query(
    "G19_sync_summary",
    f"""with {AREA_SYNC} select count(*) filter (where change = 'created') as created_count,
count(*) filter (where change = 'updated') as updated_count,
count(*) filter (where change = 'deactivated') as deactivated_count from merged""",
)
def sync_summary(spark, d):
    return u.change_summary(area_sync(spark, d))


@query(
    "M2_role_upsert",
    f"""with {BOTH} select cast(coalesce(o.c_custkey, n.c_custkey) as varchar) as hh_professional_role_id,
case when n.c_custkey is not null then n.c_name || '*' else o.c_name end as name,
case when n.c_custkey is not null then 'new' else o.c_mktsegment end as category_name, n.c_custkey is not null as is_active
from o full join n on n.c_custkey = o.c_custkey""",
)
def role_upsert(spark, d):
    old = stored(spark, d).select(
        _key().cast("string").alias("hh_professional_role_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category_name"), F.lit(True).alias("is_active"),
    )
    new = arriving(spark, d).select(
        _key().cast("string").alias("hh_professional_role_id"),
        F.concat(F.col("c_name"), F.lit("*")).alias("name"), F.lit("new").alias("category_name"),
    )
    return u.sync_dictionary(old, new, "hh_professional_role_id", ["name", "category_name"]).drop(u.CHANGE)


@query(
    "M3_employer_upsert",
    f"""with {BOTH}, m as (select *, c_custkey % 5 <> 0 as named from n)
select cast(coalesce(o.c_custkey, m.c_custkey) as varchar) as hh_employer_id,
  coalesce(case when named then m.c_name || '*' end, o.c_name) as name,
  coalesce(case when named and m.c_custkey % 7 <> 0 then m.c_mktsegment end, o.c_mktsegment) as site_url,
  case when named then timestamp '2024-02-01' when o.c_custkey is not null then timestamp '2024-01-01' end as raw_last_seen_at
from o full join m on m.c_custkey = o.c_custkey where o.c_custkey is not null or named""",
)
def employer_upsert(spark, d):
    def nothing(kind):
        return F.lit(None).cast(kind)

    old = stored(spark, d).select(
        _key().cast("string").alias("hh_employer_id"), F.col("c_name").alias("name"),
        nothing("string").alias("alternate_url"), F.col("c_mktsegment").alias("site_url"),
        nothing("string").alias("area_id"), nothing("boolean").alias("is_trusted"),
        as_of("2024-01-01").alias("raw_last_seen_at"),
    )
    new = arriving(spark, d).select(
        _key().cast("string").alias("hh_employer_id"),
        F.when(F.pmod(_key(), F.lit(5)) != 0, F.concat(F.col("c_name"), F.lit("*"))).alias("name"),
        nothing("string").alias("alternate_url"),
        F.when(F.pmod(_key(), F.lit(7)) != 0, F.col("c_mktsegment")).alias("site_url"),
        nothing("string").alias("area_id"), nothing("boolean").alias("is_trusted"),
    )
    out = u.upsert_employers(old, new, as_of("2024-02-01"))
    return out.select("hh_employer_id", "name", "site_url", "raw_last_seen_at")


def vacancy_upsert(spark, d):
    old = stored(spark, d).select(
        _key().cast("string").alias("hh_vacancy_id"),
        F.concat(F.lit("e"), F.col("c_nationkey").cast("string")).alias("employer_id"),
        F.col("c_mktsegment").alias("area_id"), F.col("c_name").alias("name_current"),
    )
    new = arriving(spark, d).select(
        _key().cast("string").alias("hh_vacancy_id"),
        F.when(F.pmod(_key(), F.lit(5)) != 0, F.concat(F.lit("x"), F.col("c_nationkey").cast("string"))).alias("employer_id"),
        F.when(F.pmod(_key(), F.lit(7)) != 0, F.lit("A")).alias("area_id"),
        F.concat(F.col("c_name"), F.lit("*")).alias("name_current"),
    )
    twice = new.withColumn("arrival", F.lit(2)).unionByName(
        new.withColumn("name_current", F.lit("stale")).withColumn("arrival", F.lit(1))
    )
    return u.upsert_vacancies(old, twice, ["arrival"])


@query(
    "M4_vacancy_upsert",
    f"""with {BOTH} select cast(coalesce(o.c_custkey, n.c_custkey) as varchar) as hh_vacancy_id,
coalesce(case when n.c_custkey % 5 <> 0 then 'x' || n.c_nationkey end, 'e' || o.c_nationkey) as employer_id,
case when n.c_custkey is null then o.c_mktsegment when n.c_custkey % 7 <> 0 then 'A' end as area_id,
case when n.c_custkey is not null then n.c_name || '*' else o.c_name end as name_current,
case when o.c_custkey is null then 'created' when n.c_custkey is null then 'kept' else 'updated' end as change
from o full join n on n.c_custkey = o.c_custkey""",
)
def vacancies(spark, d):
    return vacancy_upsert(spark, d).withColumnRenamed(u.CHANGE, "change")


@query(
    "M5_detail_update",
    f"""with {BOTH} select cast(o.c_custkey as varchar) as hh_vacancy_id,
coalesce(case when n.c_custkey % 5 <> 0 then 'x' || n.c_nationkey end, 'e' || o.c_nationkey) as employer_id,
case when n.c_custkey is null then o.c_mktsegment when n.c_custkey % 7 <> 0 then 'A' end as area_id
from o left join n on n.c_custkey = o.c_custkey""",
)
def detail_update(spark, d):
    old = stored(spark, d).select(
        _key().cast("string").alias("hh_vacancy_id"),
        F.concat(F.lit("e"), F.col("c_nationkey").cast("string")).alias("employer_id"),
        F.col("c_mktsegment").alias("area_id"),
    )
    new = arriving(spark, d).select(
        _key().cast("string").alias("hh_vacancy_id"),
        F.when(F.pmod(_key(), F.lit(5)) != 0, F.concat(F.lit("x"), F.col("c_nationkey").cast("string"))).alias("employer_id"),
        F.when(F.pmod(_key(), F.lit(7)) != 0, F.lit("A")).alias("area_id"),
    )
    return u.apply_details(old, new)


@query(
    "M7_record_detail_outcomes",
    f"""with {SEEN}, {ATTEMPTS}, {STATE}, late as (
  select *, case when status = 'succeeded' then sha256(cast(id as varchar)) end as detail_hash from attempts
  where requested_at >= timestamp '2024-01-16'),
f as (select vacancy_id, arg_max(detail_hash, (requested_at, id)) filter (where detail_hash is not null) as h,
             max(requested_at) filter (where detail_hash is not null or status = 'terminal_404') as t,
             arg_max(status, (requested_at, id)) as s, min(requested_at) as first from late group by 1)
select coalesce(state.vacancy_id, f.vacancy_id) as vacancy_id, coalesce(first_seen_at, f.first) as first_seen_at,
       coalesce(h, last_short_hash) as last_detail_hash, coalesce(t, last_detail_fetched_at) as last_detail_fetched_at,
       coalesce(s, detail_fetch_status) as detail_fetch_status,
       case when s is null then first_detail_lease_expires_at end as first_detail_lease_expires_at
from (select * from state where vacancy_id % 9 <> 0) state full join f on f.vacancy_id = state.vacancy_id""",
)
def record_outcomes(spark, d):
    states = current_state(spark, d).filter(F.pmod("vacancy_id", F.lit(9)) != 0).select(
        "vacancy_id", "first_seen_at", F.col("last_short_hash").alias("last_detail_hash"),
        "last_detail_fetched_at", "detail_fetch_status", "first_detail_lease_expires_at",
    )
    late = attempts(spark, d).filter(F.col("requested_at") >= as_of("2024-01-16"))
    outcomes = late.select(
        "id", "vacancy_id", F.col("requested_at").alias("recorded_at"),
        F.when(F.col("status") == "succeeded", F.sha2(F.col("id").cast("string"), 256)).alias("detail_hash"),
        F.col("status").alias("detail_fetch_status"),
    )
    return u.record_outcomes(states, outcomes)


@query(
    "J1_natural_key_lookup",
    """select o_orderkey, case when c.c_custkey is not null then sha256(cast(c.c_custkey as varchar)) end as customer_id
from orders left join (select c_custkey from customer where c_custkey % 4 <> 0) c on c_custkey = o_custkey""",
)
def natural_lookup(spark, d):
    dim = table(spark, d, "customer").filter(F.pmod("c_custkey", F.lit(4)) != 0)
    dim = dim.withColumn("id", u.surrogate_id(_key()))
    out = u.lookup(table(spark, d, "orders"), dim, "o_custkey", "c_custkey", "id", "customer_id")
    return out.select("o_orderkey", "customer_id")


@query(
    "J2_role_links",
    """with wanted as (select distinct l_orderkey as vacancy_id, l_suppkey as r from lineitem where l_suppkey % 10 <> 0),
existing as (select distinct l_orderkey as vacancy_id, l_suppkey as r from lineitem where l_quantity < 10)
select vacancy_id, 'role' || r as professional_role_id from wanted
where not exists (select 1 from existing e where e.vacancy_id = wanted.vacancy_id and e.r = wanted.r)""",
)
def role_links(spark, d):
    lines = table(spark, d, "lineitem")
    roles = table(spark, d, "supplier").filter(F.pmod("s_suppkey", F.lit(10)) != 0).select(
        F.col("s_suppkey").cast("string").alias("hh_professional_role_id"),
        F.concat(F.lit("role"), F.col("s_suppkey").cast("string")).alias("id"),
    )
    wanted = lines.select(
        F.col("l_orderkey").alias("vacancy_id"),
        F.array(F.col("l_suppkey").cast("string")).alias("professional_role_hh_ids"),
    )
    existing = lines.filter("l_quantity < 10").select(
        F.col("l_orderkey").alias("vacancy_id"),
        F.concat(F.lit("role"), F.col("l_suppkey").cast("string")).alias("professional_role_id"),
    )
    return u.role_links(wanted, roles, existing)


@query(
    "M19_dictionary_sync",
    f"""with {AREAS_SQL}, good as (select * from areas where doc_id % 4 <> 0),
old as (select hh_area_id from areas where level = 0 and doc_id % 2 = 0)
select 'areas' as dictionary_name, 'succeeded' as status,
  'created=' || (select count(*) from good where hh_area_id not in (select hh_area_id from old)) ||
  '; updated=' || (select count(*) from good where hh_area_id in (select hh_area_id from old)) ||
  '; deactivated=' || (select count(*) from old where hh_area_id not in (select hh_area_id from good)) as notes
union all select 'areas', 'failed', 'dictionary transport request failed' from areas where level = 0 and doc_id % 4 = 0""",
)
def dictionary_sync(spark, d):
    responses = area_trees(spark, d).withColumn("status_code", F.when(F.pmod("doc_id", F.lit(4)) == 0, 503).otherwise(200))
    nothing = F.lit(None).cast("string")
    checked = responses.withColumn(
        "error", response_error(F.col("status_code"), nothing, nothing, F.col("payload_json"), "dictionary")
    )
    new = n.tree_nodes(checked.filter("error is null"), ["doc_id"], "payload_json")
    new = new.select("hh_area_id", "name", "level", "path_text")
    old = stored(spark, d).select(
        _key().cast("string").alias("hh_area_id"), F.col("c_name").alias("name"), F.lit(0).alias("level"),
        F.col("c_name").alias("path_text"), F.lit(True).alias("is_active"),
    )
    summary = u.change_summary(u.sync_dictionary(old, new, "hh_area_id", ["name", "level", "path_text"]))
    good = summary.select(F.lit("areas").alias("dictionary_name"), F.lit("succeeded").alias("status"), u.change_notes(summary).alias("notes"))
    bad = checked.filter("error is not null").select(
        F.lit("areas").alias("dictionary_name"), F.lit("failed").alias("status"), F.col("error").alias("notes")
    )
    return good.unionByName(bad)
