"""Payload study queries: a search item and up to three fetched details per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import normalize as n
from sightline.operators import study as st
from sightline.plans.bindings import table
from sightline.plans.payloads import C, K, P, S
from sightline.plans.registry import query


def search_leaves(spark, d):
    """Two thirds of the orders have a search item; its description is always null."""
    doc = F.format_string('{"id":"%d","name":"%s","description":null}', K(), P())
    docs = table(spark, d, "orders").filter(F.pmod("o_orderkey", F.lit(3)) != 0)
    return n.leaf_values(docs.select(K().alias("id"), doc.alias("body")), ["id"], "body")


def rounds(spark, d):
    """Details of three rounds; a sixth of the fetches failed. The salary moves for every fourth order."""
    r = F.col("round")
    o = table(spark, d, "orders").select("*", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("round"))
    salary = C() + F.when(F.pmod(K(), F.lit(4)) == 0, r).otherwise(0)
    extra = F.when((F.pmod(K(), F.lit(10)) == 0) & (r == 1), ',"extra":1').otherwise("")
    core = F.format_string('"name":"%s","description":%s,"salary":{"from":%d}', P(), F.when(S() == "F", '"text"').otherwise("null"), salary)
    ok = F.pmod(K() + r, F.lit(6)) != 0
    return o.select(
        K().alias("id"), "round", ok.alias("fetched"),
        F.when(ok, F.format_string('{"id":"%d","visit":%d,%s%s}', K(), r, core, extra)).alias("raw"),
        F.when(ok, F.concat(F.lit("{"), core, F.lit("}"))).alias("normalized"),
    )


def leaves(spark, d, body):
    return n.leaf_values(rounds(spark, d).filter("fetched"), ["id", "round"], body, together=True)


def first_detail_leaves(spark, d):
    first = rounds(spark, d).filter("fetched").groupBy("id").agg(F.min_by("raw", "round").alias("raw"))
    return n.leaf_values(first, ["id"], "raw")


FETCHES = """
fetches as (select o.*, r, (o_orderkey + r) % 6 <> 0 as fetched from orders o, unnest(range(3)) t(r)),
firsts as (select o_orderkey as id, any_value(o_orderstatus) as st, min(r) as r from fetches where fetched group by 1),
paths as (
  select f.id, f.st, p.path from firsts f, (values ('id'), ('visit'), ('name'), ('description'), ('salary.from'), ('extra')) p(path)
  where p.path <> 'extra' or (f.id % 10 = 0 and f.r = 1)),
compared as (
  select id, path, path not in ('id', 'name', 'description') as detail_only,
         case path when 'id' then false when 'name' then false when 'description' then st = 'F' else true end as detail_non_null,
         case path when 'description' then st = 'F' when 'salary.from' then true else false end as important
  from paths where id % 3 <> 0)
"""


def compared(spark, d):
    return st.compare_paths(search_leaves(spark, d), first_detail_leaves(spark, d), "id")


@query("D1_search_vs_detail", f"with {FETCHES} select * from compared")
def search_vs_detail(spark, d):
    return compared(spark, d)


@query(
    "G21_top_paths",
    f"with {FETCHES} select path, count(*) as vacancy_count from compared where detail_non_null group by 1 order by 2 desc, 1 limit 20",
)
def top_paths(spark, d):
    return st.top_paths(compared(spark, d), "detail_non_null")


@query("U3_detail_only_paths", f"with {FETCHES} select id, path from compared where detail_only")
def detail_only(spark, d):
    s = search_leaves(spark, d)
    detail = first_detail_leaves(spark, d).join(s.select("id").distinct(), "id", "left_semi")
    return st.paths_only_left(detail, s, ["id", "path"])


PAIRS = f"""
{FETCHES}, pairs as (
  select o_orderkey as id, lag(r) over w as from_round, r as to_round, fetched and lag(fetched) over w as comparable
  from fetches window w as (partition by o_orderkey order by r)),
raw_changes as (
  select id, from_round, to_round, unnest(list_filter(['visit', case when id % 4 = 0 then 'salary.from' end,
         case when id % 10 = 0 then 'extra' end], lambda x: x is not null)) as path
  from pairs where comparable and from_round is not null),
norm_changes as (select id, from_round, to_round, path from raw_changes where path = 'salary.from')
"""


def pairs(spark, d):
    return st.consecutive_pairs(rounds(spark, d).select("id", "round", "fetched"), "id", "round", "fetched")


@query("U4_changed_paths", f"with {PAIRS} select * from raw_changes")
def changed(spark, d):
    return st.changed_paths(pairs(spark, d), leaves(spark, d, "raw"), "id", "round")


DRIFT = f"""
{PAIRS}, n as (select count(*) filter (where comparable) as c from pairs where from_round is not null),
drift as (
  select 'raw' as view, (select c from n) as comparable_pairs, (select count(*) from (select distinct id, from_round from raw_changes)) as changed_pairs
  union all select 'normalized', (select c from n), (select count(*) from (select distinct id, from_round from norm_changes)))
"""


@query("D2_pairwise_drift", f"with {DRIFT} select *, changed_pairs / comparable_pairs as changed_pair_rate from drift")
def drift(spark, d):
    p = pairs(spark, d)
    frames = []
    for view, body in (("raw", "raw"), ("normalized", "normalized")):
        changes = st.changed_paths(p, leaves(spark, d, body), "id", "round")
        frames.append(st.drift_rate(p, changes, "id", view))
    return frames[0].unionByName(frames[1])


@query(
    "D3_conclusion",
    f"""with {DRIFT}, f as (select count(distinct path) as k from compared where important),
r as (select changed_pairs / comparable_pairs as rate from drift where view = 'normalized')
select k as important_fields, rate as normalized_changed_pair_rate, case when k = 0 then 'detail_optional' when rate <= 0.2 then 'selective_detail'
when rate <= 0.5 then 'selective_detail_short_ttl' else 'aggressive_detail_refresh' end as recommended_policy from f, r""",
)
def conclusion(spark, d):
    p = pairs(spark, d)
    rate = st.drift_rate(p, st.changed_paths(p, leaves(spark, d, "normalized"), "id", "round"), "id", "normalized")
    fields = compared(spark, d).filter("important").agg(F.count_distinct("path").alias("important_fields"))
    out = fields.select("important_fields", rate.select("changed_pair_rate").scalar().alias("normalized_changed_pair_rate"))
    return out.withColumn(
        "recommended_policy", st.recommendation(F.col("important_fields"), F.col("normalized_changed_pair_rate"))
    )
