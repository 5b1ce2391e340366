"""JSON payloads, made from orders and customers row by row, and their normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.functions import json_ops as j
from sightline.functions import scalars as sc
from sightline.operators import history as h
from sightline.operators import normalize as n
from sightline.plans.bindings import REQUESTS, SEEN, request_log, seen_events, table
from sightline.plans.registry import query


def K():
    return F.col("o_orderkey")


def C():
    return F.col("o_custkey")


def S():
    return F.col("o_orderstatus")


def P():
    return F.col("o_orderpriority")


ISO = "yyyy-MM-dd'T'HH:mm:ss"
SQL_ISO = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')"


def _roles():
    ids = [F.pmod(C(), F.lit(10)).cast("string"), F.pmod(K(), F.lit(4)).cast("string")]
    return F.array(*[F.struct(x.alias("id")) for x in (ids[0], ids[1], ids[0], F.lit(" "))])


def _item(i):
    employer = F.when(F.pmod(K(), F.lit(7)) == 0, None).otherwise(
        F.struct(
            F.when(F.pmod(K(), F.lit(5)) == 0, "  ").otherwise(C().cast("string")).alias("id"),
            F.concat(F.lit("Customer "), C().cast("string")).alias("name"),
            F.lit(True).alias("trusted"),
        )
    )
    return F.struct(
        (K() * 3 + i).cast("string").alias("id"),
        F.when((F.pmod(K(), F.lit(11)) == 0) & (i == 0), "  ").otherwise(P()).alias("name"),
        F.when(S() != "P", F.struct(F.concat(F.lit(" "), F.pmod(C(), F.lit(25)).cast("string"), F.lit(" ")).alias("id"))).alias("area"),
        F.concat(F.date_format("o_orderdate", ISO), F.lit("+0300")).alias("published_at"),
        F.when(S() == "F", F.concat(F.date_format("o_orderdate", ISO), F.lit(".250000+0000"))).alias("created_at"),
        F.struct(F.when(F.pmod(K(), F.lit(2)) == 0, "").otherwise("between1And3").alias("id")).alias("experience"),
        employer.alias("employer"),
        _roles().alias("professional_roles"),
    )


def search_pages(spark, d):
    page = F.struct(
        F.transform(F.sequence(F.lit(0), F.pmod(K(), F.lit(3)).cast("int")), _item).alias("items"),
        C().alias("found"),
        F.when(F.pmod(K(), F.lit(9)) != 0, F.pmod(K(), F.lit(5))).alias("page"),
        F.pmod(C(), F.lit(150)).alias("pages"),
        F.when(F.pmod(K(), F.lit(4)) == 1, 0).when(F.pmod(K(), F.lit(4)) > 1, 20).alias("per_page"),
    )
    return table(spark, d, "orders").select(K().alias("page_id"), F.to_json(page).alias("payload_json"))


ITEMS = """
items as (
  select o.*, i, o_orderkey as page_id, cast(o_orderkey * 3 + i as varchar) as item_id,
         cast(case when o_orderkey % 9 <> 0 then o_orderkey % 5 else 0 end
              * case when o_orderkey % 4 > 1 then 20 else o_orderkey % 3 + 1 end + i as bigint) as list_position,
         case when o_orderkey % 11 = 0 and i = 0 then '  ' else o_orderpriority end as raw_name
  from orders o, unnest(range(o_orderkey % 3 + 1)) as t(i))
"""


def detail_payloads(spark, d):
    doc = F.struct(
        K().cast("string").alias("id"),
        P().alias("name"),
        F.lit("  What we do \n").alias("description"),
        (S() == "F").alias("archived"),
        F.when(F.pmod(K(), F.lit(3)) == 0, F.concat(F.date_format("o_orderdate", ISO), F.lit("+0300"))).alias("initial_created_at"),
        F.concat(F.date_format("o_orderdate", ISO), F.lit("Z")).alias("created_at"),
        F.array(*[F.struct(F.lit(x).alias("name")) for x in (" SQL ", "", "SQL")]).alias("key_skills"),
        F.when(S() == "O", F.struct(C().alias("from"))).alias("salary"),
        _roles().alias("professional_roles"),
    )
    return table(spark, d, "orders").select(K().alias("doc_id"), F.to_json(doc).alias("payload_json"))


def _utc(column):
    return F.col(column).cast("timestamp_ntz")


@query("N1_page_items", f"with {ITEMS} select page_id, item_id, list_position from items")
def page_items(spark, d):
    items = n.page_items(search_pages(spark, d))
    return items.select("page_id", F.try_variant_get("item", "$.id", "string").alias("item_id"), "list_position")


@query(
    "N2_short_records",
    f"""with {ITEMS}
select page_id, item_id as hh_vacancy_id, case when trim(raw_name) <> '' then raw_name end as name_current,
  case when o_orderstatus <> 'P' then cast(o_custkey % 25 as varchar) end as area_hh_id,
  o_orderdate - interval 3 hour as published_at,
  case when o_orderstatus = 'F' then o_orderdate + interval 250 millisecond end as created_at_hh,
  case when o_orderkey % 2 <> 0 then 'between1And3' end as experience_code,
  case when o_custkey % 10 = o_orderkey % 4 then cast(o_custkey % 10 as varchar)
       else (o_custkey % 10) || ',' || (o_orderkey % 4) end as role_ids, list_position,
  case when trim(raw_name) = '' then 'name must be a non-empty string' end as error
from items""",
)
def short_records(spark, d):
    r = n.short_records(n.page_items(search_pages(spark, d)))
    return r.select(
        "page_id",
        "hh_vacancy_id",
        "name_current",
        "area_hh_id",
        _utc("published_at").alias("published_at"),
        _utc("created_at_hh").alias("created_at_hh"),
        "experience_code",
        F.array_join("professional_role_hh_ids", ",").alias("role_ids"),
        "list_position",
        F.col("_error").alias("error"),
    )


@query(
    "N3_detail_records",
    """
select o_orderkey as doc_id, cast(o_orderkey as varchar) as hh_vacancy_id, 'What we do' as description,
  o_orderstatus = 'F' as archived, 'SQL,SQL' as skills,
  case when o_orderkey % 3 = 0 then o_orderdate - interval 3 hour else o_orderdate end as created_at_hh,
  case when o_orderstatus = 'O' then '{"from":' || o_custkey || '}' end as salary
from orders
""",
)
def detail_records(spark, d):
    r = n.detail_records(detail_payloads(spark, d))
    return r.select(
        "doc_id",
        "hh_vacancy_id",
        "description",
        "archived",
        F.array_join("key_skill_names", ",").alias("skills"),
        _utc("created_at_hh").alias("created_at_hh"),
        "salary",
    )


@query(
    "N4_employer_reference",
    f"""with {ITEMS} select page_id, item_id,
case when o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 then cast(o_custkey as varchar) end as hh_employer_id,
case when o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 then 'Customer ' || o_custkey end as employer_name,
case when o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 then true end as is_trusted from items""",
)
def employers(spark, d):
    items = n.page_items(search_pages(spark, d))
    e = n.employer_reference(F.col("item"))
    return items.select(
        "page_id", F.try_variant_get("item", "$.id", "string").alias("item_id"), e.alias("e")
    ).select(
        "page_id",
        "item_id",
        F.col("e.hh_employer_id").alias("hh_employer_id"),
        F.col("e.name").alias("employer_name"),
        F.col("e.is_trusted").alias("is_trusted"),
    )


def typed_documents(spark, d):
    """Values of every JSON type under one key, and padded text under another."""
    by = F.pmod(K(), F.lit(6))
    value = (
        F.when(by == 0, C().cast("string"))
        .when(by == 1, "true")
        .when(by == 2, "null")
        .when(by == 3, F.concat(F.lit('" '), P(), F.lit('\\t "')))
        .when(by == 4, '"   "')
        .otherwise("[]")
    )
    return table(spark, d, "orders").select(K().alias("id"), F.concat(F.lit('{"x":'), value, F.lit("}")).alias("doc"))


@query(
    "N5_strings",
    """select o_orderkey as id, case when o_orderkey % 6 = 3 then o_orderpriority end as optional_x,
case when o_orderkey % 6 = 3 then ' ' || o_orderpriority || chr(9) || ' ' end as required_x,
case when o_orderkey % 6 in (0, 1, 5) then 'x must be string' end as error from orders""",
)
def strings(spark, d):
    t = typed_documents(spark, d).withColumn("v", j.parse("doc"))
    v = F.col("v")
    return t.select(
        "id",
        j.optional_string(v, "$.x").alias("optional_x"),
        j.required_string(v, "$.x").alias("required_x"),
        j.type_error(v, "$.x", "STRING").alias("error"),
    )


@query(
    "N6_numbers_and_flags",
    """select o_orderkey as id, case when o_orderkey % 6 = 0 then o_custkey end as int_x,
case when o_orderkey % 6 = 1 then true end as bool_x from orders""",
)
def numbers(spark, d):
    t = typed_documents(spark, d).withColumn("v", j.parse("doc"))
    return t.select("id", j.optional_int(F.col("v"), "$.x").alias("int_x"), j.optional_bool(F.col("v"), "$.x").alias("bool_x"))


@query(
    "N7_distinct_ids",
    """select o_orderkey as doc_id, case when o_custkey % 10 = o_orderkey % 4 then cast(o_custkey % 10 as varchar)
else (o_custkey % 10) || ',' || (o_orderkey % 4) end as ids from orders""",
)
def role_ids(spark, d):
    t = detail_payloads(spark, d).withColumn("v", j.parse("payload_json"))
    return t.select("doc_id", F.array_join(j.distinct_ids(F.col("v"), "$.professional_roles"), ",").alias("ids"))


@query("N8_key_skills", "select o_orderkey as doc_id, 'SQL,SQL' as skills, 2 as skill_count from orders")
def skills(spark, d):
    t = detail_payloads(spark, d).withColumn("v", j.parse("payload_json"))
    names = j.names_in_list(F.col("v"), "$.key_skills")
    return t.select("doc_id", F.array_join(names, ",").alias("skills"), F.size(names).alias("skill_count"))


@query(
    "N9_time_parse",
    """select o_orderkey as id, case o_orderkey % 4 when 0 then o_orderdate - interval 3 hour
when 1 then o_orderdate + interval 250 millisecond when 2 then o_orderdate + interval 90 minute end as parsed from orders""",
)
def times(spark, d):
    text = F.date_format("o_orderdate", ISO)
    by = F.pmod(K(), F.lit(4))
    raw = (
        F.when(by == 0, F.concat(text, F.lit("+0300")))
        .when(by == 1, F.concat(text, F.lit(".25Z")))
        .when(by == 2, F.concat(text, F.lit("-01:30")))
        .otherwise(text)
    )
    return table(spark, d, "orders").select(K().alias("id"), j.parse_time(raw).cast("timestamp_ntz").alias("parsed"))


def unsorted_documents(spark, d):
    """Keys out of order and blanks in between."""
    doc = F.concat(
        F.lit('{"b": '), K().cast("string"), F.lit(', "a": {"y": "'), P(), F.lit('", "x": ['), C().cast("string"),
        F.lit(", "), F.pmod(K(), F.lit(3)).cast("string"), F.lit("]}}"),
    )
    return table(spark, d, "orders").select(K().alias("id"), doc.alias("payload_json"))


SORTED_DOC = """'{"a":{"x":[' || o_custkey || ',' || (o_orderkey % 3) || '],"y":"' || o_orderpriority || '"},"b":' || o_orderkey || '}'"""


@query("N10_canonical_hash", f"select o_orderkey as id, sha256({SORTED_DOC}) as payload_hash from orders")
def canonical_hash(spark, d):
    return unsorted_documents(spark, d).select("id", j.canonical_hash(F.col("payload_json")).alias("payload_hash"))


@query("N10_byte_exact_hash", f"select o_orderkey as id, sha256({SORTED_DOC}) as payload_hash from orders")
def byte_hash(spark, d):
    return unsorted_documents(spark, d).select("id", j.byte_exact_hash(F.col("payload_json")).alias("payload_hash"))


@query(
    "N11_normalized_hash_ignores_noise",
    "select o_orderkey as doc_id, true as raw_changed, o_orderstatus = 'O' as normalized_changed from orders",
)
def noise(spark, d):
    a = detail_payloads(spark, d)
    salary = F.regexp_replace("payload_json", '"from":', '"from":1')
    b = a.withColumn("payload_json", F.concat(F.lit('{"noise":1,'), F.substr(salary, F.lit(2))))
    left = n.detail_records(a).select("doc_id", "detail_hash", "normalized_hash")
    right = n.detail_records(b).select("doc_id", F.col("detail_hash").alias("d2"), F.col("normalized_hash").alias("n2"))
    return left.join(right, "doc_id").select(
        "doc_id",
        (F.col("detail_hash") != F.col("d2")).alias("raw_changed"),
        (F.col("normalized_hash") != F.col("n2")).alias("normalized_changed"),
    )


@query("N12_canonical_json", f"select o_orderkey as id, {SORTED_DOC} as canonical from orders")
def canonical(spark, d):
    return unsorted_documents(spark, d).select("id", j.canonical_json(F.col("payload_json")).alias("canonical"))


@query(
    "N13_detail_document",
    f"""select o_orderkey as id, '{{"payload":' || {SORTED_DOC} || ',"schema_version":2,"source":"detail"}}' as document from orders""",
)
def detail_document(spark, d):
    return unsorted_documents(spark, d).select("id", j.detail_document(F.col("payload_json")).alias("document"))


@query(
    "N14_short_document",
    f"""with {ITEMS} select page_id, item_id,
'{{"context":{{"crawl_partition_id":"p' || page_id || '","found":' || o_custkey || ',"list_position":' || list_position
|| case when o_orderkey % 9 <> 0 then ',"page":' || (o_orderkey % 5) else '' end || '}},"payload":{{"id":"' || item_id
|| '"}},"schema_version":2,"source":"short"}}' as document from items""",
)
def short_document(spark, d):
    pages = search_pages(spark, d)
    items = n.page_items(pages).withColumn("v", j.parse("payload_json"))
    context = F.struct(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("crawl_partition_id"),
        j.optional_int(F.col("v"), "$.found").alias("found"),
        "list_position",
        j.optional_int(F.col("v"), "$.page").alias("page"),
    )
    item_id = F.try_variant_get("item", "$.id", "string")
    only_id = F.parse_json(F.to_json(F.struct(item_id.alias("id"))))
    return items.select("page_id", item_id.alias("item_id"), j.short_document(only_id, context).alias("document"))


@query(
    "N15_full_document",
    "select o_orderkey as id, o_orderkey % 3 = 0 as is_full from orders",
)
def full_document(spark, d):
    u = unsorted_documents(spark, d)
    by = F.pmod("id", F.lit(3))
    doc = F.when(by == 0, j.detail_document(F.col("payload_json"))).when(by == 1, F.col("payload_json")).otherwise(
        '{"schema_version":2,"payload":[]}'
    )
    return u.select("id", j.is_full_document(doc).alias("is_full"))


@query(
    "N16_item_by_id",
    """select o_orderkey as page_id, case when o_orderkey % 3 >= 1 and o_orderstatus <> 'P'
then ' ' || (o_custkey % 25) || ' ' end as area_id, o_orderkey % 3 >= 1 as found_item from orders""",
)
def item_lookup(spark, d):
    pages = search_pages(spark, d).withColumn("v", j.parse("payload_json"))
    item = j.item_by_id(F.col("v"), (F.col("page_id") * 3 + 1).cast("string"))
    return pages.withColumn("item", item).select(
        "page_id",
        F.try_variant_get("item", "$.area.id", "string").alias("area_id"),
        F.col("item").isNotNull().alias("found_item"),
    )


LEAVES = f"""
leaves as (
  select o_orderkey as doc_id, 'id' as path, '"' || o_orderkey || '"' as leaf from orders
  union all select o_orderkey, 'name', '"' || o_orderpriority || '"' from orders
  union all select o_orderkey, 'description', '"  What we do \\n"' from orders
  union all select o_orderkey, 'archived', case when o_orderstatus = 'F' then 'true' else 'false' end from orders
  union all select o_orderkey, 'initial_created_at', '"' || {SQL_ISO} || '+0300"' from orders where o_orderkey % 3 = 0
  union all select o_orderkey, 'created_at', '"' || {SQL_ISO} || 'Z"' from orders
  union all select o_orderkey, 'key_skills[].name', unnest(['" SQL "', '""', '"SQL"']) from orders
  union all select o_orderkey, 'salary.from', cast(o_custkey as varchar) from orders where o_orderstatus = 'O'
  union all select o_orderkey, 'professional_roles[].id',
    unnest(['"' || (o_custkey % 10) || '"', '"' || (o_orderkey % 4) || '"', '" "']) from orders)
"""


@query(
    "N17_leaf_values",
    f"with {LEAVES} select doc_id, path, string_agg(distinct leaf, '|' order by leaf) as leaf_values from leaves group by 1, 2",
)
def leaf_values(spark, d):
    out = n.leaf_values(detail_payloads(spark, d), ["doc_id"], "payload_json")
    return out.select("doc_id", "path", F.array_join("leaf_values", "|").alias("leaf_values"))


@query(
    "N18_role_dictionary",
    """select o_orderkey as doc_id, '1' as role_id, 'last' as name, 'other' as category_name from orders
union all select o_orderkey, cast(o_orderkey % 3 as varchar), 'x', 'cat' || (o_custkey % 5) from orders where o_orderkey % 3 <> 1""",
)
def role_dictionary(spark, d):
    def role(role_id, name):
        return F.struct(role_id.alias("id"), name.alias("name"))

    doc = F.struct(
        F.array(
            F.struct(
                F.concat(F.lit("cat"), F.pmod(C(), F.lit(5)).cast("string")).alias("name"),
                F.array(role(F.lit("1"), P()), role(F.pmod(K(), F.lit(3)).cast("string"), F.lit("x"))).alias("roles"),
            ),
            F.struct(F.lit("other").alias("name"), F.array(role(F.lit("1"), F.lit("last"))).alias("roles")),
        ).alias("categories")
    )
    docs = table(spark, d, "orders").select(K().alias("doc_id"), F.to_json(doc).alias("payload_json"))
    return n.role_records(docs, ["doc_id"], "payload_json").withColumnRenamed("hh_professional_role_id", "role_id")


def area_trees(spark, d):
    """One area payload per customer: a root, up to three children and their children."""
    c = F.col("c_custkey")

    def grandchild(i):
        def make(x):
            return F.struct(
                F.format_string("%d-%d-%d", c, i, x).alias("id"),
                F.format_string("L2-%d", x).alias("name"),
                F.format_string("%d-%d", c, i).alias("parent_id"),
                F.array().cast("array<string>").alias("areas"),
            )

        return make

    def child(i):
        return F.struct(
            F.format_string("%d-%d", c, i).alias("id"),
            F.format_string("L1-%d", i).alias("name"),
            c.cast("string").alias("parent_id"),
            F.transform(F.sequence(F.lit(0), i), grandchild(i)).alias("areas"),
        )

    root = F.struct(
        c.cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.transform(F.sequence(F.lit(0), F.pmod(c, F.lit(3)).cast("int")), child).alias("areas"),
    )
    return table(spark, d, "customer").select(c.alias("doc_id"), F.to_json(F.array(root)).alias("payload_json"))


AREAS_SQL = """
areas as (
  select c_custkey as doc_id, cast(c_custkey as varchar) as hh_area_id, c_name as name,
         null as parent_hh_area_id, 0 as level, c_name as path_text from customer
  union all select c_custkey, c_custkey || '-' || i, 'L1-' || i, cast(c_custkey as varchar), 1, c_name || ' / L1-' || i
  from customer, unnest(range(c_custkey % 3 + 1)) t(i)
  union all select c_custkey, c_custkey || '-' || i || '-' || x, 'L2-' || x, c_custkey || '-' || i, 2,
         c_name || ' / L1-' || i || ' / L2-' || x
  from customer, unnest(range(c_custkey % 3 + 1)) t(i), unnest(range(i + 1)) u(x))
"""


@query("N19_area_tree", f"with {AREAS_SQL} select * from areas")
def area_tree(spark, d):
    return n.tree_nodes(area_trees(spark, d), ["doc_id"], "payload_json")


@query(
    "N20_response_class",
    f"""with {REQUESTS} select id, status_code = 403 and coalesce(error_type = 'captcha_required', false) as is_captcha,
status_code = 0 or status_code between 500 and 599 as is_transport from reqs""",
)
def response_class(spark, d):
    q = request_log(spark, d)
    return q.select(
        "id",
        sc.is_captcha(F.col("status_code"), F.col("error_type")).alias("is_captcha"),
        sc.is_transport(F.col("status_code")).alias("is_transport"),
    )


@query(
    "N21_api_error",
    """select o_orderkey as id, case o_orderkey % 4 when 0 then 'captcha_required' when 1 then 'bad_argument' end as error_type,
case o_orderkey % 4 when 0 then 'https://c.example.com/' || o_custkey when 1 then o_orderpriority end as error_message from orders""",
)
def api_errors(spark, d):
    by = F.pmod(K(), F.lit(4))
    captcha = F.format_string('{"errors":[{"type":" captcha_required ","value":" ","captcha_url":"https://c.example.com/%d"}]}', C())
    plain = F.format_string('{"errors":[{"type":"bad_argument","value":"%s","description":"d"},{"type":"other"}]}', P())
    doc = F.when(by == 0, captcha).when(by == 1, plain).when(by == 2, '{"errors":[]}').otherwise('{"errors":[{"type":7,"value":"v"}]}')
    t = table(spark, d, "orders").select(K().alias("id"), j.api_error(j.parse(doc)).alias("e"))
    return t.select("id", "e.error_type", "e.error_message")


@query(
    "N22_response_outcome",
    f"""with {REQUESTS} select id, case when status_code = 403 and error_type = 'captcha_required'
  then 'captcha_required: vacancy search request blocked by captcha'
when status_code = 500 then 'vacancy search transport request failed'
when status_code <> 200 then 'Unexpected status code: ' || status_code end as error from reqs""",
)
def response_outcome(spark, d):
    q = request_log(spark, d)
    error = sc.response_error(
        F.col("status_code"), F.col("error_type"), F.lit(None).cast("string"), F.col("payload_json"), "vacancy search"
    )
    return q.select("id", error.alias("error"))


@query(
    "N23_status_class",
    f"""with {REQUESTS} select id, case when id % 10 = 0 and error_type is not null then 'network_error'
when id % 10 = 0 then 'unknown' else (status_code // 100) || 'xx' end as status_class from reqs""",
)
def status_classes(spark, d):
    q = request_log(spark, d)
    code = F.when(F.pmod("id", F.lit(10)) != 0, F.col("status_code"))
    return q.select("id", sc.status_class(code, F.col("error_type")).alias("status_class"))


@query(
    "N24_endpoints",
    f"""with {REQUESTS} select id, case when starts_with(endpoint, '/vacancies/') then '/vacancies/{{vacancy_id}}' else endpoint end as template,
case when endpoint = '/vacancies' then 'search' when starts_with(endpoint, '/vacancies/') then 'detail' else 'dictionary' end as kind
from reqs""",
)
def endpoints(spark, d):
    e = F.col("endpoint")
    return request_log(spark, d).select("id", sc.endpoint_template(e).alias("template"), sc.endpoint_kind(e).alias("kind"))


@query(
    "N25_safe_path_component",
    r"select page_id, regexp_replace(url, '[^\p{L}\p{N}\-_.]', '_', 'g') as safe from pages",
)
def safe_paths(spark, d):
    return table(spark, d, "pages").select("page_id", sc.safe_path_component(F.col("url")).alias("safe"))


@query(
    "N27_headers",
    """select o_orderkey as id, '<redacted>' as auth_value, 'agent/' || o_custkey as agent_value,
case when o_orderkey % 2 = 0 then 'dual' else 'app_like' end as header_mode from orders""",
)
def headers(spark, d):
    h_ = F.map_filter(
        F.create_map(
            F.lit("Authorization"), F.concat(F.lit("Bearer "), K().cast("string")),
            F.lit("User-Agent"), F.concat(F.lit("agent/"), C().cast("string")),
            F.lit("HH-User-Agent"), F.when(F.pmod(K(), F.lit(2)) == 0, "own"),
        ),
        lambda _k, v: v.isNotNull(),
    )
    t = table(spark, d, "orders").select(K().alias("id"), h_.alias("h"))
    clean = t.select("id", sc.redact_headers(F.col("h")).alias("h"))
    return clean.select(
        "id",
        F.col("h")["Authorization"].alias("auth_value"),
        F.col("h")["User-Agent"].alias("agent_value"),
        sc.header_mode(F.col("h")).alias("header_mode"),
    )


@query(
    "N28_search_params",
    """select o_orderkey as id, case when o_orderkey % 4 = 3 then '0' else cast(o_orderkey % 4 as varchar) end as page,
case when o_custkey % 2 = 0 then '50' else '20' end as per_page, '"' || o_orderpriority || '"' as text,
cast(null as varchar) as other, 4 as param_count from orders""",
)
def search_parameters(spark, d):
    page = F.when(F.pmod(K(), F.lit(4)) == 3, -1).otherwise(F.pmod(K(), F.lit(4)))
    inner = F.format_string(
        '{"area":"%d","page":%d,"per_page":%s,"text":"%s","period":null,"other":1}',
        C(), page.cast("long"), F.when(F.pmod(C(), F.lit(2)) == 0, "50").otherwise("true"), P(),
    )
    nested = F.when(F.pmod(K(), F.lit(2)) == 0, F.concat(F.lit('{"params":'), inner, F.lit("}"))).otherwise(inner)
    t = table(spark, d, "orders").select(K().alias("id"), j.search_params(j.parse(nested)).alias("m"))
    m = F.col("m")
    return t.select("id", m["page"].alias("page"), m["per_page"].alias("per_page"), m["text"].alias("text"),
                    m["other"].alias("other"), F.size("m").alias("param_count"))


@query(
    "N29_important_paths",
    f"""with {LEAVES}, v as (select doc_id, path, bool_and(leaf = 'null') as effectively_null from leaves group by 1, 2)
select doc_id, path, effectively_null, path in ('description', 'key_skills[].name', 'salary.from') as important from v""",
)
def important(spark, d):
    out = n.leaf_values(detail_payloads(spark, d), ["doc_id"], "payload_json")
    return out.select(
        "doc_id",
        "path",
        j.effectively_null(F.col("leaf_values")).alias("effectively_null"),
        j.is_important_path(F.col("path")).alias("important"),
    )


def stored_details(spark, d):
    """Detail snapshots, two thirds of them in the old form, with the id of their payload."""
    version = F.when(F.pmod(K(), F.lit(3)) == 0, '{"schema_version":2,"payload":{}}').when(F.pmod(K(), F.lit(3)) == 1, "{}")
    ref = F.when(F.pmod(K(), F.lit(7)) != 0, K())
    return table(spark, d, "orders").select(
        K().alias("id"), C().alias("vacancy_id"), version.alias("normalized_json"), ref.alias("detail_payload_ref_id")
    )


def backfilled_details(spark, d):
    from sightline.operators.backfill import backfill_details

    payloads = detail_payloads(spark, d).filter(F.pmod("doc_id", F.lit(5)) != 0)
    return backfill_details(stored_details(spark, d), payloads.withColumnRenamed("doc_id", "payload_id"))


@query(
    "M14_detail_backfill",
    """select o_orderkey as id, o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 as rebuilt,
case when o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 then cast(o_orderkey as varchar) end as payload_id_in_document
from orders where o_orderkey % 3 <> 0""",
)
def detail_backfill(spark, d):
    out = backfilled_details(spark, d)
    return out.select(
        "id",
        F.col("document").isNotNull().alias("rebuilt"),
        F.get_json_object("document", "$.payload.id").alias("payload_id_in_document"),
    )


@query(
    "M14_detail_backfill_counts",
    """select count(*) as candidates, count(*) filter (where o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0) as rebuilt,
count(*) filter (where o_orderkey % 7 = 0 or o_orderkey % 5 = 0) as skipped_missing_payload
from orders where o_orderkey % 3 <> 0""",
)
def detail_backfill_counts(spark, d):
    return backfilled_details(spark, d).agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count("document").alias("rebuilt"),
        F.count_if(F.col("document").isNull()).alias("skipped_missing_payload"),
    )


@query(
    "J14_payload_lookup",
    """select o_orderkey as id, case when o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 then o_orderkey end as payload_doc
from orders""",
)
def payload_lookup(spark, d):
    from sightline.operators.backfill import with_payload

    payloads = detail_payloads(spark, d).filter(F.pmod("doc_id", F.lit(5)) != 0).withColumnRenamed("doc_id", "payload_id")
    out = with_payload(stored_details(spark, d), payloads, "detail_payload_ref_id")
    return out.select("id", F.get_json_object("payload_json", "$.id").cast("long").alias("payload_doc"))


def short_backfill_inputs(spark, d):
    """Sightings refer to the page of their own id; every fourth has none. Some snapshots exist."""
    s = seen_events(spark, d).withColumn(
        "short_payload_ref_id", F.when(F.pmod("id", F.lit(4)) != 0, F.col("id"))
    ).withColumn("hh_vacancy_id", (F.col("id") * 3 + F.pmod("id", F.lit(2))).cast("string"))
    pages = search_pages(spark, d).withColumnRenamed("page_id", "payload_id")
    existing = s.filter(F.pmod("id", F.lit(9)) == 0).select(
        "vacancy_id", F.col("seen_at").alias("captured_at"), F.lit("short").alias("snapshot_type"),
        "short_hash",
    )
    return s, pages, existing


SHORT_BACKFILL = f"""
{SEEN}, lagged as (select *, lag(short_hash) over (partition by vacancy_id order by seen_at, id) as p from seen),
due as (select *, case when p is null then 'first_seen' else 'short_hash_changed' end as change_reason from lagged
        where (p is null or p <> short_hash) and id % 4 <> 0 and id % 9 <> 0),
checked as (select due.id, due.change_reason, case when o.o_orderkey is null then 'missing_payload'
        when o_orderkey % 3 < due.id % 2 then 'missing_item' end as skipped
        from due left join orders o on o.o_orderkey = due.id)
"""


@query("M15_short_backfill", f"with {SHORT_BACKFILL} select * from checked")
def short_backfill(spark, d):
    from sightline.operators.backfill import backfill_short

    return backfill_short(*short_backfill_inputs(spark, d)).select("id", "change_reason", "skipped")


@query(
    "M15_short_backfill_counts",
    f"""with {SHORT_BACKFILL} select count(*) as candidates, count(*) filter (where skipped is null) as created,
count(*) filter (where skipped = 'missing_payload') as skipped_missing_payload,
count(*) filter (where skipped = 'missing_item') as skipped_missing_item from checked""",
)
def short_backfill_counts(spark, d):
    out = short_backfill(spark, d)
    return out.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.col("skipped").isNull()).alias("created"),
        F.count_if(F.col("skipped") == "missing_payload").alias("skipped_missing_payload"),
        F.count_if(F.col("skipped") == "missing_item").alias("skipped_missing_item"),
    )


@query(
    "J8_snapshot_not_stored_yet",
    f"""with {SEEN}, snap as (select vacancy_id, seen_at as captured_at, short_hash from seen where id % 9 = 0)
select id from seen where not exists (select 1 from snap where snap.vacancy_id = seen.vacancy_id
  and snap.captured_at = seen.seen_at and snap.short_hash = seen.short_hash)""",
)
def not_stored(spark, d):
    from sightline.operators.backfill import without_stored_snapshot

    s, _pages, existing = short_backfill_inputs(spark, d)
    return without_stored_snapshot(s, existing, "short").select("id")


@query(
    "M11_detail_snapshots",
    """select o_orderkey as doc_id, o_custkey as vacancy_id, 'detail' as snapshot_type, o_orderdate as captured_at,
o_orderkey % 3 = 0 as had_initial from orders where o_orderstatus = 'F'""",
)
def detail_snapshots(spark, d):
    from sightline.operators.backfill import detail_snapshot_rows

    tries = table(spark, d, "orders").select(
        K().alias("payload_id"), C().alias("vacancy_id"), F.col("o_orderdate").alias("finished_at"),
        F.when(S() == "F", "succeeded").otherwise("failed").alias("status"),
    )
    payloads = detail_payloads(spark, d).withColumnRenamed("doc_id", "payload_id")
    out = detail_snapshot_rows(tries, payloads)
    return out.select(
        F.col("payload_id").alias("doc_id"), "vacancy_id", "snapshot_type", "captured_at",
        F.get_json_object("document", "$.payload.initial_created_at").isNotNull().alias("had_initial"),
    )


@query(
    "M21_rows_to_append",
    f"""select o_orderkey as api_request_log_id, 'vacancies.detail' as endpoint_type, cast(o_custkey as varchar) as entity_hh_id,
sha256({SORTED_DOC}) as payload_hash from orders where o_orderstatus <> 'P'""",
)
def rows_to_append(spark, d):
    from sightline.operators.backfill import payload_rows

    responses = unsorted_documents(spark, d).join(
        table(spark, d, "orders").select(K().alias("id"), C().cast("string").alias("entity_hh_id"), S().alias("s")), "id"
    )
    good = responses.filter("s <> 'P'").withColumnRenamed("id", "api_request_log_id")
    return payload_rows(good, "vacancies.detail").select(
        "api_request_log_id", "endpoint_type", "entity_hh_id", "payload_hash"
    )
