"""Archive scans: the joined row of each dataset, ready for export."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.schemas import ARCHIVE_DATASETS

Tables = Mapping[str, DataFrame]


def dataset_columns(dataset_key: str) -> list[str]:
    return StructType.fromDDL(ARCHIVE_DATASETS[dataset_key]["columns"]).fieldNames()


def _pick(df: DataFrame, dataset_key: str) -> DataFrame:
    return df.select(*dataset_columns(dataset_key))


def _vacancy_key(tables: Tables) -> DataFrame:
    return tables["vacancy"].select(F.col("id").alias("vacancy_id"), "hh_vacancy_id")


def raw_api_payload(tables: Tables) -> DataFrame:
    log = tables["api_request_log"].withColumnRenamed("id", "api_request_log_id")
    payload = tables["raw_api_payload"].withColumnRenamed("id", "raw_api_payload_id")
    return _pick(payload.join(log, "api_request_log_id"), "bronze/raw_api_payload")


def api_request_log(tables: Tables) -> DataFrame:
    """Log rows with their payload hash; a row with several payloads repeats."""
    log = tables["api_request_log"].withColumnRenamed("id", "api_request_log_id")
    payload = tables["raw_api_payload"].select(F.col("id").alias("raw_api_payload_id"), "api_request_log_id", "payload_hash")
    return _pick(log.join(payload, "api_request_log_id", "left"), "silver/api_request_log")


def vacancy(tables: Tables) -> DataFrame:
    return _pick(tables["vacancy"].withColumnRenamed("id", "vacancy_id"), "silver/vacancy")


def vacancy_snapshot(tables: Tables) -> DataFrame:
    """Snapshots with both payload hashes; only ids and hashes of the payloads are shuffled."""
    hashes = tables["raw_api_payload"].select("id", "payload_hash")
    short = hashes.toDF("short_payload_ref_id", "short_payload_hash")
    detail = hashes.toDF("detail_payload_ref_id", "detail_payload_hash")
    rows = tables["vacancy_snapshot"].withColumnRenamed("id", "snapshot_id").join(_vacancy_key(tables), "vacancy_id")
    rows = rows.join(short, "short_payload_ref_id", "left").join(detail, "detail_payload_ref_id", "left")
    return _pick(rows, "silver/vacancy_snapshot")


def vacancy_seen_event(tables: Tables) -> DataFrame:
    short = tables["raw_api_payload"].select("id", "payload_hash").toDF("short_payload_ref_id", "short_payload_hash")
    rows = tables["vacancy_seen_event"].withColumnRenamed("id", "seen_event_id").join(_vacancy_key(tables), "vacancy_id")
    return _pick(rows.join(short, "short_payload_ref_id", "left"), "silver/vacancy_seen_event")


def vacancy_current_state(tables: Tables) -> DataFrame:
    return _pick(tables["vacancy_current_state"].join(_vacancy_key(tables), "vacancy_id"), "silver/vacancy_current_state")


def detail_fetch_attempt(tables: Tables) -> DataFrame:
    rows = tables["detail_fetch_attempt"].withColumnRenamed("id", "detail_fetch_attempt_id")
    return _pick(rows.join(_vacancy_key(tables), "vacancy_id"), "silver/detail_fetch_attempt")


SCANS: dict[str, Callable[[Tables], DataFrame]] = {
    "bronze/raw_api_payload": raw_api_payload,
    "silver/api_request_log": api_request_log,
    "silver/vacancy": vacancy,
    "silver/vacancy_snapshot": vacancy_snapshot,
    "silver/vacancy_seen_event": vacancy_seen_event,
    "silver/vacancy_current_state": vacancy_current_state,
    "silver/detail_fetch_attempt": detail_fetch_attempt,
}


def dataset_rows(tables: Tables, dataset_key: str, limit: int | None = None) -> DataFrame:
    """Scan of a dataset by key; an unknown key or a limit below one is an error."""
    if dataset_key not in SCANS:
        raise ValueError(f"unknown archive dataset: {dataset_key}")
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    rows = SCANS[dataset_key](tables)
    if limit is None:
        return rows
    return rows.orderBy(ARCHIVE_DATASETS[dataset_key]["id_field"]).limit(limit)
