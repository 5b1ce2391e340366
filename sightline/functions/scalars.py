"""Small column expressions: ratios, status classes, endpoints, safe names, headers, days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time fields in the order in which a row's day is looked up.
OBSERVED_AT_FIELDS = ("received_at", "requested_at", "captured_at", "seen_at", "updated_at", "finished_at")

# Header names whose content must not be stored.
SENSITIVE_HEADERS = ("authorization", "proxy-authorization")

CAPTCHA = "captcha_required"


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0 when the denominator is 0."""
    return F.when(denominator == 0, 0.0).otherwise(numerator / denominator)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent; null when there is no whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def status_class(status_code: Column, error_type: Column) -> Column:
    """2xx ... 5xx; without a usable code network_error or unknown."""
    code = F.coalesce(status_code, F.lit(0))
    return (
        F.when(error_type.isNotNull() & (code == 0), "network_error")
        .when(code <= 0, "unknown")
        .otherwise(F.concat(F.floor(code / 100).cast("string"), F.lit("xx")))
    )


def endpoint_template(endpoint: Column, collection: str = "/vacancies") -> Column:
    """One label for all single-item endpoints, so that ids do not become labels."""
    return F.when(
        endpoint.startswith(f"{collection}/"), F.lit(f"{collection}/{{vacancy_id}}")
    ).otherwise(endpoint)


def endpoint_kind(endpoint: Column, collection: str = "/vacancies") -> Column:
    """search, detail or dictionary."""
    path = F.trim(endpoint)
    return (
        F.when(path == collection, "search")
        .when(path.startswith(f"{collection}/"), "detail")
        .otherwise("dictionary")
    )


def is_captcha(status_code: Column, error_type: Column) -> Column:
    return F.coalesce((status_code == 403) & (error_type == CAPTCHA), F.lit(False))


def is_transport(status_code: Column) -> Column:
    return F.coalesce((status_code == 0) | status_code.between(500, 599), F.lit(False))


def response_error(
    status_code: Column, error_type: Column, error_message: Column, payload: Column, subject: str
) -> Column:
    """Why a response cannot be used, in fixed precedence; null for a usable one."""

    def labelled(default: str) -> Column:
        text = F.coalesce(error_message, F.lit(default))
        return F.when(error_type.isNull(), text).otherwise(F.concat_ws(": ", error_type, text))

    return (
        F.when(is_captcha(status_code, error_type), labelled(f"{subject} request blocked by captcha"))
        .when(is_transport(status_code), labelled(f"{subject} transport request failed"))
        .when(status_code != 200, F.concat(F.lit("Unexpected status code: "), status_code.cast("string")))
        .when(error_type.isNotNull(), labelled(f"{subject} request failed"))
        .when(payload.isNull() | payload.isin("", "null", "{}", "[]"), F.lit(f"{subject} payload is empty"))
    )


def safe_path_component(value: Column) -> Column:
    """Letters, digits and - _ . stay; everything else becomes an underscore."""
    return F.regexp_replace(value, r"[^\p{L}\p{N}\-_.]", "_")


def observed_day(columns: list[str]) -> Column:
    """Day text of the first time field that holds at least a date; '-' if none does."""
    texts = [F.col(c).cast("string") for c in OBSERVED_AT_FIELDS if c in columns]
    return F.coalesce(*[F.when(F.length(t) >= 10, F.substring(t, 1, 10)) for t in texts], F.lit("-"))


def redact_headers(headers: Column) -> Column:
    """Map with the values of sensitive headers replaced."""
    return F.transform_values(
        headers, lambda k, v: F.when(F.lower(k).isin(*SENSITIVE_HEADERS), "<redacted>").otherwise(v)
    )


def header_mode(headers: Column, own_agent: str = "hh-user-agent") -> Column:
    """Which agent headers a request carried: dual, app_like, hh_only or null."""
    names = F.transform(F.map_keys(headers), F.lower)
    app = F.coalesce(F.array_contains(names, "user-agent"), F.lit(False))
    own = F.coalesce(F.array_contains(names, own_agent), F.lit(False))
    return F.when(app & own, "dual").when(app, "app_like").when(own, "hh_only")
