"""Raw payloads to rows: page items, details, leaf paths, trees and dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions import json_ops as j
from sightline.session import spread, spread_by


def page_error(page: Column) -> Column:
    """Why a parsed search page cannot be used, null if it can: no object, no list of items, counters that are no whole numbers."""
    wrong = [F.when(~F.coalesce(j.kind(page, f"$.{name}"), F.lit("VOID")).isin("BIGINT", "VOID"), f"page.{name} must be an integer") for name in ("page", "per_page", "pages", "found")]
    return F.when(page.isNull() | ~F.coalesce(j.is_object(page), F.lit(False)), "page must be an object").otherwise(
        F.coalesce(F.when(~F.coalesce(j.is_array(page, "$.items"), F.lit(False)), "page.items must be a list"), *wrong)
    )


def bad_pages(pages: DataFrame, body: str = "payload_json") -> DataFrame:
    """The pages that give no items at all because they are damaged, with ``_error``."""
    parsed = pages.withColumn("_page", j.parse(body))
    return _only(parsed.withColumn("_why", page_error(F.col("_page"))), "_why", "_error").drop("_page", "_why")


def _only(df: DataFrame, column: str, output: str) -> DataFrame:
    """Rows whose ``column`` is not null, as ``output``.

    A plain filter is pushed below the projections, so that the optimizer writes the parse of a document into it once for
    each use and runs it before the rows are spread. It does not pass a generator.
    """
    return df.withColumn(output, F.explode_outer(F.array(column))).filter(F.col(output).isNotNull())


def page_items(pages: DataFrame, body: str = "payload_json") -> DataFrame:
    """One row per item of a search page, with its position over all pages; damaged pages are left to ``bad_pages``."""
    v = F.col("_page")
    items = F.try_variant_get(v, "$.items", "array<variant>")
    page = F.coalesce(j.optional_int(v, "$.page"), F.lit(0))
    # No filter on the error: it would be pushed down with a parse of the page for each of its uses.
    parsed = spread(pages).withColumn("_page", j.parse(body)).withColumn("_items", F.when(page_error(v).isNull(), items))
    per_page = F.coalesce(F.nullif(j.optional_int(v, "$.per_page"), F.lit(0)), F.size("_items"))
    return (
        parsed.withColumn("_base", page * F.greatest(per_page, F.lit(1)))
        .select(*pages.columns, "_base", F.posexplode_outer("_items").alias("_i", "item"))
        .filter("_i is not null")
        .withColumn("list_position", (F.col("_base") + F.col("_i")).cast("long"))
        .drop("_base", "_i")
    )


def employer_reference(value: Column, path: str = "$.employer") -> Column:
    """Employer struct, or null when there is no usable id."""
    return F.when(
        j.optional_string(value, f"{path}.id").isNotNull(),
        F.struct(
            j.optional_string(value, f"{path}.id").alias("hh_employer_id"),
            j.optional_string(value, f"{path}.name").alias("name"),
            j.optional_string(value, f"{path}.alternate_url").alias("alternate_url"),
            j.optional_string(value, f"{path}.site_url").alias("site_url"),
            j.lookup_id(value, f"{path}.area").alias("area_hh_id"),
            j.optional_bool(value, f"{path}.trusted").alias("is_trusted"),
        ),
    )


LOOKUPS = ("area", "employment", "schedule", "experience", "employer")
SHORT_TIMES = ("published_at", "created_at")
DETAIL_TIMES = ("published_at", "initial_created_at", "created_at")
EMPLOYER_TEXTS = ("id", "name", "alternate_url", "site_url")


def _opened(df: DataFrame, v: Column, texts: list[str], others: list[str]) -> DataFrame:
    """Open a record step by step, so that every member is read once.

    Adds ``k_<x>`` (type) and ``t_<x>`` (text) per text member, ``v_<x>`` per other member, and
    the same for the members of the small objects, as ``k_<object>_<x>`` and so on.
    """
    inner = {o: (list(EMPLOYER_TEXTS) if o == "employer" else ["id", "name"]) for o in LOOKUPS}
    f = df.withColumn("_f", j.open_object(v, [*texts, *LOOKUPS, *others]))
    keep = df.columns
    g = f.select(
        *keep,
        F.col("_f").isNotNull().alias("is_record"),
        *[F.schema_of_variant(F.col("_f")[t]).alias(f"k_{t}") for t in texts],
        *[F.try_variant_get(F.col("_f")[t], "$", "string").alias(f"t_{t}") for t in texts],
        *[F.col("_f")[o].alias(f"v_{o}") for o in [*LOOKUPS, *others]],
        *[
            j.open_object(F.col("_f")[o], [*m, *(["area", "trusted"] if o == "employer" else [])]).alias(f"o_{o}")
            for o, m in inner.items()
        ],
    )
    pairs = [(o, m) for o, members in inner.items() for m in members]
    return g.select(
        "*",
        *[F.schema_of_variant(F.col(f"o_{o}")[m]).alias(f"k_{o}_{m}") for o, m in pairs],
        *[F.try_variant_get(F.col(f"o_{o}")[m], "$", "string").alias(f"t_{o}_{m}") for o, m in pairs],
    )


def _text(name: str) -> Column:
    return j.text_of(F.col(f"k_{name}"), F.col(f"t_{name}"))


def _required(name: str) -> Column:
    return F.when((F.col(f"k_{name}") == "STRING") & (j.strip(F.col(f"t_{name}")) != ""), F.col(f"t_{name}"))


def _employer() -> Column:
    o = F.col("o_employer")
    return F.when(
        _text("employer_id").isNotNull(),
        F.struct(
            _text("employer_id").alias("hh_employer_id"),
            _text("employer_name").alias("name"),
            _text("employer_alternate_url").alias("alternate_url"),
            _text("employer_site_url").alias("site_url"),
            j.optional_string(o["area"], "$.id").alias("area_hh_id"),
            j.optional_bool(o["trusted"], "$").alias("is_trusted"),
        ),
    )


def _record_error(texts: list[str], times: tuple[str, ...]) -> Column:
    """First reason why an opened record cannot be normalised; null for a good one."""
    checks = [F.when(~F.col("is_record"), F.lit("record must be an object"))]
    for name in ("id", "name"):
        checks.append(F.when(_required(name).isNull(), F.lit(f"{name} must be a non-empty string")))
    for o in LOOKUPS:
        wrong = F.col(f"v_{o}").isNotNull() & F.col(f"o_{o}").isNull() & (F.schema_of_variant(f"v_{o}") != "VOID")
        checks.append(F.when(wrong, F.lit(f"{o} must be object")))
    typed = [t for t in texts if t not in ("id", "name")] + [f"{o}_id" for o in LOOKUPS]
    for t in typed:
        checks.append(F.when(~F.col(f"k_{t}").isin("STRING", "VOID"), F.lit(f"{t.replace('_id', '.id')} must be string")))
    roles = F.col("v_professional_roles")
    checks.append(
        F.when(
            roles.isNotNull() & ~j.is_array(roles) & (F.schema_of_variant(roles) != "VOID"),
            F.lit("professional_roles must be array"),
        )
    )
    for t in times:
        bad = _text(t).isNotNull() & F.col(f"at_{t}").isNull()
        checks.append(F.when(bad, F.lit(f"{t} is not a supported time")))
    return F.coalesce(*checks)


def _with_times(df: DataFrame, times: tuple[str, ...]) -> DataFrame:
    return df.select("*", *[j.parse_time(_text(t)).alias(f"at_{t}") for t in times])


def short_records(items: DataFrame, item: str = "item", text: str | None = None) -> DataFrame:
    """Search items as columns; ``_error`` tells why a row belongs into quarantine.

    ``text``: a column with the item's JSON as ``to_json`` writes it, so that it is not written again for the hash.
    """
    v = F.col(item)
    keep = [c for c in items.columns if c not in (item, text)]
    texts = ["id", "name", "alternate_url", *SHORT_TIMES]
    rows = _with_times(_opened(items, v, texts, ["professional_roles"]), SHORT_TIMES)
    return rows.select(
        *keep,
        _required("id").alias("hh_vacancy_id"),
        _required("name").alias("name_current"),
        _text("area_id").alias("area_hh_id"),
        F.col("at_published_at").alias("published_at"),
        F.col("at_created_at").alias("created_at_hh"),
        _text("alternate_url").alias("alternate_url"),
        _text("employment_id").alias("employment_type_code"),
        _text("schedule_id").alias("schedule_type_code"),
        _text("experience_id").alias("experience_code"),
        _employer().alias("employer"),
        j.distinct_ids(F.col("v_professional_roles"), "$").alias("professional_role_hh_ids"),
        (j.variant_hash(v) if text is None else F.sha2(text, 256)).alias("short_hash"),
        _record_error(texts, SHORT_TIMES).alias("_error"),
    )


def detail_records(payloads: DataFrame, body: str = "payload_json") -> DataFrame:
    """Detail payloads as columns, the normalised document and both hashes."""
    v = F.col("_detail")
    keep = payloads.columns
    texts = ["id", "name", "description", "branded_description", "alternate_url", *DETAIL_TIMES]
    others = ["archived", "professional_roles", "key_skills", "salary", "salary_range"]
    parsed = spread(payloads).withColumn("_detail", j.parse(body))
    rows = _with_times(_opened(parsed, v, texts, others), DETAIL_TIMES)
    area = F.when(
        F.col("o_area").isNotNull(), F.struct(_text("area_id").alias("id"), _text("area_name").alias("name"))
    )

    def free_object(name: str) -> Column:
        return F.when(j.is_object(F.col(f"v_{name}")), F.to_json(f"v_{name}"))

    out = rows.select(
        *keep,
        _required("id").alias("hh_vacancy_id"),
        _required("name").alias("name_current"),
        _text("description").alias("description"),
        _text("branded_description").alias("branded_description"),
        _text("alternate_url").alias("alternate_url"),
        j.optional_bool(F.col("v_archived"), "$").alias("archived"),
        area.alias("area"),
        _employer().alias("employer"),
        _text("employment_id").alias("employment_type_code"),
        _text("schedule_id").alias("schedule_type_code"),
        _text("experience_id").alias("experience_code"),
        j.distinct_ids(F.col("v_professional_roles"), "$").alias("professional_role_hh_ids"),
        j.names_in_list(F.col("v_key_skills"), "$").alias("key_skill_names"),
        free_object("salary").alias("salary"),
        free_object("salary_range").alias("salary_range"),
        F.col("at_published_at").alias("published_at"),
        F.coalesce("at_initial_created_at", "at_created_at").alias("created_at_hh"),
        j.variant_hash(v).alias("detail_hash"),
        _record_error(texts, DETAIL_TIMES).alias("_error"),
    )
    return out.withColumn("normalized_json", _normalized_json()).withColumn("normalized_hash", F.sha2("normalized_json", 256))


def _normalized_json() -> Column:
    """Canonical JSON of the normalised document of ``detail_records``.

    Members are written in the order of their names, so the text need not be parsed and written again to sort them: writing a
    VARIANT sets up a JSON factory for each of its keys and texts. Free objects come from a VARIANT and are canonical.
    """
    iso = "yyyy-MM-dd'T'HH:mm:ssXXX"

    def in_order(name: str, *members: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.struct(*[F.col(name)[m].alias(m) for m in sorted(members)]))

    members = {
        **{
            name: F.col(name)
            for name in (
                "hh_vacancy_id", "name_current", "description", "branded_description", "alternate_url", "archived", "employment_type_code",
                "schedule_type_code", "experience_code", "professional_role_hh_ids", "key_skill_names",
            )
        },
        "area": in_order("area", "id", "name"),
        "employer": in_order("employer", "hh_employer_id", "name", "alternate_url", "site_url", "area_hh_id", "is_trusted"),
        **{name: F.parse_json(name) for name in ("salary", "salary_range")},
        **{name: F.date_format(name, iso) for name in ("published_at", "created_at_hh")},
    }
    return F.to_json(F.struct(*[members[name].alias(name) for name in sorted(members)]), {"ignoreNullFields": "false"})


def split_quarantine(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows): one bad record must not fail the job."""
    return records.filter("_error is null").drop("_error"), records.filter("_error is not null")


def _brackets(body: str) -> Column:
    """How many containers a text opens: no document nests deeper than that."""
    return F.length(F.regexp_replace(body, r"[^\[{]", ""))


def _grown(start: Column, steps: Column, node: str, kids, result) -> Column:
    """All nodes below ``start``, level by level inside one row, as an array of ``node`` structs.

    Each step replaces the open nodes by their children and keeps those that are a ``result``. A document is done when
    none is open; steps beyond that change nothing. No job looks at the input to find out how deep it is.
    """
    array = f"array<{node}>"
    state = f"struct<open:{array},done:{array}>"
    empty = F.array().cast(array)

    def step(acc: Column, _n: Column) -> Column:
        below = F.flatten(F.transform(acc["open"], lambda x: F.coalesce(kids(x).cast(array), F.array().cast(array))))
        kept = F.concat(acc["done"], F.filter(acc["open"], result)).cast(array)
        return F.when(F.size(acc["open"]) == 0, acc).otherwise(F.struct(below.cast(array).alias("open"), kept.alias("done")).cast(state))

    begin = F.struct(F.coalesce(start.cast(array), empty).alias("open"), empty.alias("done")).cast(state)
    return F.aggregate(F.sequence(F.lit(0), steps), begin, step, lambda acc: acc["done"])


def leaf_values(docs: DataFrame, doc_id: list[str], body: str, together: bool = False) -> DataFrame:
    """(doc, path, values): every leaf path with its sorted distinct JSON values.

    A document is flattened inside its row, whatever its depth; leaves are kept, empty containers
    vanish. Only the final grouping by (doc, path) shuffles. ``together``: rows are brought together by document before they
    are flattened, so documents are shuffled, which are a fraction of their leaves, and the result is dealt by document.
    """
    node = "struct<path:string,v:variant>"
    members_of = lambda x: F.try_variant_get(x["v"], "$", "map<string,variant>")
    elements_of = lambda x: F.try_variant_get(x["v"], "$", "array<variant>")

    def kids(x: Column) -> Column:
        prefix = F.when(x["path"] == "", F.lit("")).otherwise(F.concat(x["path"], F.lit(".")))
        members = F.transform(F.map_entries(members_of(x)), lambda e: F.struct(F.concat(prefix, e["key"]).alias("path"), e["value"].alias("v")))
        elements = F.transform(elements_of(x), lambda e: F.struct(F.concat(x["path"], F.lit("[]")).alias("path"), e.alias("v")))
        return F.coalesce(members.cast(f"array<{node}>"), elements.cast(f"array<{node}>"))

    def leaf(x: Column) -> Column:
        return (x["path"] != "") & members_of(x).isNull() & elements_of(x).isNull()

    rows = docs.select(*doc_id, body)
    parsed = (spread_by(rows, doc_id) if together else spread(rows)).withColumn("_v", j.parse(body))
    root = F.when(F.col("_v").isNotNull(), F.array(F.struct(F.lit("").alias("path"), F.col("_v").alias("v"))))
    flat = parsed.select(*doc_id, F.inline(_grown(root, _brackets(body), node, kids, leaf)))
    leaves = flat.select(*doc_id, "path", F.to_json("v").alias("value"))
    return leaves.groupBy(*doc_id, "path").agg(F.array_sort(F.collect_set("value")).alias("leaf_values"))


def tree_nodes(docs: DataFrame, doc_id: list[str], body: str) -> DataFrame:
    """Nodes of nested area trees: id, parent, level and path text; the last duplicate id wins."""
    node = "struct<node:variant,level:int,names:array<string>,pos:array<int>>"

    def kids(n: Column) -> Column:
        return F.transform(
            F.try_variant_get(n["node"], "$.areas", "array<variant>"),
            lambda x, i: F.struct(
                x.alias("node"),
                (n["level"] + 1).alias("level"),
                F.concat(n["names"], F.array(F.try_variant_get(x, "$.name", "string"))).alias("names"),
                F.concat(n["pos"], F.array(i)).alias("pos"),
            ),
        )

    roots = F.transform(
        F.try_variant_get(j.parse(body), "$", "array<variant>"),
        lambda x, i: F.struct(
            x.alias("node"),
            F.lit(0).alias("level"),
            F.array(F.try_variant_get(x, "$.name", "string")).alias("names"),
            F.array(i).alias("pos"),
        ),
    )
    flat = spread(docs).select(*doc_id, F.inline(_grown(roots, _brackets(body), node, kids, lambda n: F.lit(True))))
    v = F.col("node")
    rows = flat.select(
        *doc_id,
        j.required_string(v, "$.id").alias("hh_area_id"),
        j.required_string(v, "$.name").alias("name"),
        j.optional_string(v, "$.parent_id").alias("parent_hh_area_id"),
        "level",
        F.array_join("names", " / ").alias("path_text"),
        "pos",
    )
    keep = ["name", "parent_hh_area_id", "level", "path_text"]
    last = F.max_by(F.struct(*keep), "pos").alias("_n")
    return rows.groupBy(*doc_id, "hh_area_id").agg(last).select(*doc_id, "hh_area_id", "_n.*")


def role_records(docs: DataFrame, doc_id: list[str], body: str) -> DataFrame:
    """Categories to roles; of a repeated role id the last one wins."""
    cats = F.try_variant_get(j.parse(body), "$.categories", "array<variant>")
    c = spread(docs).select(*doc_id, F.posexplode(cats).alias("_ci", "_c"))
    roles = F.try_variant_get("_c", "$.roles", "array<variant>")
    r = c.select(*doc_id, "_ci", j.required_string(F.col("_c"), "$.name").alias("category_name"), F.posexplode(roles).alias("_ri", "_r"))
    rows = r.select(
        *doc_id,
        j.required_string(F.col("_r"), "$.id").alias("hh_professional_role_id"),
        j.required_string(F.col("_r"), "$.name").alias("name"),
        "category_name",
        F.struct("_ci", "_ri").alias("_o"),
    )
    last = F.max_by(F.struct("name", "category_name"), "_o").alias("_n")
    return rows.groupBy(*doc_id, "hh_professional_role_id").agg(last).select(*doc_id, "hh_professional_role_id", "_n.*")
