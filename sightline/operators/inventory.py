"""Inventories: summaries, key frequencies, fill rates, counts and ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.scalars import percent


def payload_summary(
    payloads: DataFrame, by: str, body: str, digest: str, at: str, approximate: bool = False
) -> DataFrame:
    """Rows, bytes, distinct digests and time range per kind; a missing kind shows as '-'."""
    distinct = F.approx_count_distinct(digest) if approximate else F.count_distinct(digest)
    return payloads.groupBy(F.coalesce(F.col(by), F.lit("-")).alias(by)).agg(
        F.count(F.lit(1)).alias("payload_count"),
        F.sum(F.octet_length(body)).alias("payload_bytes"),
        distinct.alias("distinct_hashes"),
        F.min(at).alias("first_received_at"),
        F.max(at).alias("last_received_at"),
    )


def request_summary(log: DataFrame, by: list[str], latency: str, at: str) -> DataFrame:
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.min(at).alias("first_requested_at"),
        F.max(at).alias("last_requested_at"),
        F.round(F.avg(latency), 2).alias("avg_latency_ms"),
    )


def newest_rows(df: DataFrame, row_id: str, n: int) -> DataFrame:
    """The n rows with the highest ids. Only ids are sorted; wide columns are filtered by the cut."""
    cut = df.select(row_id).orderBy(F.desc(row_id)).limit(n).agg(F.min(row_id))
    return df.filter(F.col(row_id) >= cut.scalar())


def key_frequency(docs: DataFrame, body: str, top: int, item_path: str | None = None) -> DataFrame:
    """How often each top-level key occurs in JSON objects, or in the objects of an array inside."""
    if item_path:
        parsed = F.from_json(F.get_json_object(body, item_path), "array<string>")
        objects = docs.select(F.explode(parsed).alias("_o"))
    else:
        objects = docs.select(F.col(body).alias("_o"))
    objects = objects.filter(F.ltrim("_o").startswith("{"))
    total = objects.agg(F.count(F.lit(1)))
    counts = (
        objects.select(F.explode(F.json_object_keys("_o")).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("key_count"))
    )
    return (
        counts.withColumn("sample_percent", percent(F.col("key_count"), total.scalar()))
        .orderBy(F.desc("key_count"), "key")
        .limit(top)
    )


def key_frequency_of_newest(
    docs: DataFrame, row_id: str, body: str, n: int, top: int, item_path: str | None = None
) -> DataFrame:
    return key_frequency(newest_rows(docs, row_id, n), body, top, item_path)


def classified_payloads(
    payloads: DataFrame, log: DataFrame, request_type: str, endpoint_types: list[str]
) -> DataFrame:
    """Payloads of one kind, told by the request type of the log or by their endpoint type."""
    types = log.select(F.col("id").alias("api_request_log_id"), "request_type")
    joined = payloads.join(types, "api_request_log_id", "left")
    return joined.filter((F.col("request_type") == request_type) | F.col("endpoint_type").isin(*endpoint_types))


def snapshot_summary(snapshots: DataFrame, by: list[str], key: str, at: str) -> DataFrame:
    return snapshots.groupBy(*by).agg(
        F.count(F.lit(1)).alias("snapshot_count"),
        F.count_distinct(key).alias("vacancy_count"),
        F.min(at).alias("first_captured_at"),
        F.max(at).alias("last_captured_at"),
    )


def fill_rates(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """One row per column: filled, total, percent. One scan for all columns."""
    one = df.agg(F.count(F.lit(1)).alias("total_count"), *[F.count(c).alias(c) for c in columns])
    pairs = ", ".join(f"'{label}.{c}', `{c}`" for c in columns)
    return one.select(
        F.expr(f"stack({len(columns)}, {pairs}) as (field_name, filled_count)"), "total_count"
    ).withColumn("filled_percent", percent(F.col("filled_count"), F.col("total_count")))


def metric_rows(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """(metric, value) rows from one aggregate pass."""
    one = df.agg(*[c.cast("long").alias(n) for n, c in metrics.items()])
    return one.unpivot([], list(metrics), "metric", "value")


def union_rows(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def time_ranges(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Count, first and last value of every time column, from one pass."""
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}_n"), F.min(c).alias(f"{c}_a"), F.max(c).alias(f"{c}_b")]
    parts = ", ".join(f"'{label}.{c}', `{c}_n`, `{c}_a`, `{c}_b`" for c in columns)
    return df.agg(*aggs).select(
        F.expr(f"stack({len(columns)}, {parts}) as (field_name, value_count, min_at, max_at)")
    )


def since(df: DataFrame, at: str, boundary: Column) -> DataFrame:
    return df.filter(F.col(at) >= boundary)


def distribution(df: DataFrame, by: list[str], name: str = "row_count") -> DataFrame:
    """Counts per value, the most frequent first."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *by)


def monthly_summary(df: DataFrame, at: str, by: list[str]) -> DataFrame:
    return df.groupBy(F.date_format(at, "yyyy-MM").alias("month"), *by).agg(
        F.count(F.lit(1)).alias("run_count"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
    )


def smallest_entries(entries: DataFrame, datasets: list[str], max_bytes: int, n: int) -> DataFrame:
    """Non-empty entries of some datasets below a size, the smallest first."""
    fit = entries.filter(
        F.col("dataset_key").isin(*datasets) & (F.col("row_count") > 0) & (F.col("data_size_bytes") <= max_bytes)
    )
    return fit.orderBy("data_size_bytes", "manifest_file").limit(n)
