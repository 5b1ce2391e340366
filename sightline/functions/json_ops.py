"""JSON scalars on VARIANT: typed reads with validity, canonical form, documents."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SNAPSHOT_VERSION = 2

# Message fields of an API error, by preference.
ERROR_MESSAGE_FIELDS = ("value", "description", "message", "captcha_url", "captcha_url_with_backurl")

# Search parameters that a list request may carry.
SEARCH_PARAMS = (
    "area",
    "date_from",
    "date_to",
    "only_with_salary",
    "order_by",
    "period",
    "professional_role",
    "search_field",
    "text",
)
DEFAULT_PAGE = 0
DEFAULT_PER_PAGE = 20

# Detail paths that matter for research.
IMPORTANT_PATH_PREFIXES = (
    "description",
    "branded_description",
    "key_skills[]",
    "salary.",
    "salary_range.",
    "address.",
    "contacts.",
    "languages[]",
    "working_days[]",
    "working_time_intervals[]",
    "work_format[]",
    "work_schedule_by_days[]",
)


def parse(text: Column | str) -> Column:
    """VARIANT of a JSON text; null if it is not JSON."""
    return F.try_parse_json(text)


def at(value: Column, path: str) -> Column:
    return value if path == "$" else F.try_variant_get(value, path, "variant")


def kind(value: Column, path: str = "$") -> Column:
    """Type name found at a path: STRING, BOOLEAN, BIGINT, VOID, ...; null if absent."""
    return F.schema_of_variant(at(value, path))


def is_object(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "map<string,variant>").isNotNull()


def open_object(value: Column, fields: list[str]) -> Column:
    """Members of an object as a struct of VARIANT, in one pass; null when it is not an object."""
    return F.try_variant_get(value, "$", "struct<" + ",".join(f"{f}:variant" for f in fields) + ">")


def text_of(kind_: Column, raw: Column) -> Column:
    """Trimmed text of a scalar that was already opened; null if blank or not text."""
    return F.when(kind_ == "STRING", text_or_null(raw))


def is_array(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "array<variant>").isNotNull()


# Every character that counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def text_or_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def optional_string(value: Column, path: str) -> Column:
    """Trimmed text; blank or absent is null. A value of another type is null here, see type_error."""
    return F.when(kind(value, path) == "STRING", text_or_null(F.try_variant_get(value, path, "string")))


def required_string(value: Column, path: str) -> Column:
    """Text as it is; null (an error) when absent, blank or of another type."""
    raw = F.try_variant_get(value, path, "string")
    return F.when((kind(value, path) == "STRING") & (strip(raw) != ""), raw)


def optional_int(value: Column, path: str) -> Column:
    """Whole number; a boolean is not a number."""
    return F.when(kind(value, path) == "BIGINT", F.try_variant_get(value, path, "long"))


def optional_bool(value: Column, path: str) -> Column:
    return F.when(kind(value, path) == "BOOLEAN", F.try_variant_get(value, path, "boolean"))


def type_error(value: Column, path: str, expected: str) -> Column:
    """Message when something of another type stands at a path; null when fine or absent."""
    found = kind(value, path)
    good = {
        "OBJECT": lambda: is_object(value, path),
        "ARRAY": lambda: is_array(value, path),
    }.get(expected, lambda: found == expected)()
    name = path.removeprefix("$.")
    return F.when(found.isNotNull() & (found != "VOID") & ~good, F.lit(f"{name} must be {expected.lower()}"))


def lookup_id(value: Column, path: str) -> Column:
    """Id inside a small object, e.g. area.id."""
    return optional_string(value, f"{path}.id")


def distinct_ids(value: Column, path: str) -> Column:
    """Ids of a list of objects: blanks dropped, first occurrence kept, in order; absent list is empty."""
    items = F.try_variant_get(value, path, "array<variant>")
    ids = F.transform(items, lambda x: optional_string(x, "$.id"))
    return F.coalesce(F.array_distinct(F.filter(ids, lambda x: x.isNotNull())), F.array().cast("array<string>"))


def names_in_list(value: Column, path: str) -> Column:
    """Trimmed names of a list of objects: blanks dropped, repeats kept."""
    items = F.try_variant_get(value, path, "array<variant>")
    names = F.transform(items, lambda x: optional_string(x, "$.name"))
    return F.coalesce(F.filter(names, lambda x: x.isNotNull()), F.array().cast("array<string>"))


def parse_time(text: Column) -> Column:
    """Date-time with a zone offset and an optional fraction; anything else is null."""
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX][XX]"))
    return F.when(zoned, parsed)


def canonical_json(text: Column) -> Column:
    """Same object, same text: keys sorted, no blanks."""
    return F.to_json(parse(text))


def canonical_hash(text: Column) -> Column:
    return F.sha2(canonical_json(text), 256)


def variant_hash(value: Column) -> Column:
    return F.sha2(F.to_json(value), 256)


def byte_exact_hash(text: Column) -> Column:
    """Hash over Python's own JSON text (keeps 1.0 and repeated keys as Python does).

    Only for comparing with hashes stored elsewhere; the VARIANT form stays in the JVM.
    """
    return _python_json_hash()(text)


def _python_json_hash():
    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            try:
                value = json.loads(text)
            except ValueError:
                return None
            compact = json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
            return hashlib.sha256(compact.encode("utf-8")).hexdigest()

        return texts.map(one)

    return digest


def detail_document(payload: Column) -> Column:
    """Versioned snapshot document around a detail payload (JSON text)."""
    body = F.to_json(parse(payload))
    return F.concat(
        F.lit('{"payload":'), body, F.lit(f',"schema_version":{SNAPSHOT_VERSION},"source":"detail"}}')
    )


def short_document(item: Column, context: Column, text: Column | None = None) -> Column:
    """Versioned snapshot document around a search item; absent context facts are left out.

    ``text`` is the item's JSON if it has been written already.
    """
    return F.concat(
        F.lit('{"context":'),
        F.to_json(context),
        F.lit(',"payload":'),
        F.to_json(item) if text is None else text,
        F.lit(f',"schema_version":{SNAPSHOT_VERSION},"source":"short"}}'),
    )


def is_full_document(document: Column) -> Column:
    v = parse(document)
    return F.coalesce(
        (optional_int(v, "$.schema_version") == SNAPSHOT_VERSION) & is_object(v, "$.payload"), F.lit(False)
    )


def item_by_id(page: Column, item_id: Column) -> Column:
    """First item of a page with this id, as VARIANT."""
    items = F.try_variant_get(page, "$.items", "array<variant>")
    same = F.filter(
        items, lambda x: (kind(x, "$.id") == "STRING") & (F.try_variant_get(x, "$.id", "string") == item_id)
    )
    return F.get(same, 0)


def api_error(payload: Column) -> Column:
    """struct(error_type, error_message) of the first API error; both null when there is none."""
    first = F.get(F.try_variant_get(payload, "$.errors", "array<variant>"), 0)
    error_type = optional_string(first, "$.type")
    message = F.coalesce(*[optional_string(first, f"$.{f}") for f in ERROR_MESSAGE_FIELDS])
    return F.struct(
        error_type.alias("error_type"), F.when(error_type.isNotNull(), message).alias("error_message")
    )


def search_params(params: Column) -> Column:
    """Allowed search parameters of a stored partition with page and per_page defaults."""
    source = F.when(is_object(params, "$.params"), at(params, "$.params")).otherwise(params)
    page, per_page = optional_int(source, "$.page"), optional_int(source, "$.per_page")
    fields = F.try_variant_get(source, "$", "map<string,variant>")
    allowed = F.map_filter(
        F.transform_values(fields, lambda _k, v: F.nullif(F.to_json(v), F.lit("null"))),
        lambda k, v: k.isin(*SEARCH_PARAMS) & v.isNotNull(),
    )
    defaults = F.create_map(
        F.lit("page"),
        F.when(page >= 0, page).otherwise(DEFAULT_PAGE).cast("string"),
        F.lit("per_page"),
        F.when(per_page > 0, per_page).otherwise(DEFAULT_PER_PAGE).cast("string"),
    )
    return F.map_concat(defaults, allowed)


def effectively_null(values: Column) -> Column:
    """All JSON leaf values are null."""
    return F.forall(values, lambda v: v == "null")


def is_important_path(path: Column) -> Column:
    hit = F.lit(False)
    for prefix in IMPORTANT_PATH_PREFIXES:
        hit = hit | path.startswith(prefix)
    return hit
