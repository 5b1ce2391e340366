"""Explicit schemas; jobs never infer them."""

from __future__ import annotations

# Tables of the data model, as Spark DDL.
TABLES = {
    "crawl_run": (
        "id STRING, run_type STRING, status STRING, triggered_by STRING, config_snapshot_json STRING, "
        "partitions_total INT, partitions_done INT, partitions_failed INT, notes STRING, started_at "
        "TIMESTAMP, finished_at TIMESTAMP"
    ),
    "crawl_partition": (
        "id STRING, crawl_run_id STRING, parent_partition_id STRING, partition_key STRING, scope_key STRING, "
        "params_json STRING, status STRING, depth INT, split_dimension STRING, split_value STRING, "
        "planner_policy_version STRING, is_terminal BOOLEAN, is_saturated BOOLEAN, coverage_status STRING, "
        "pages_total_expected INT, pages_processed INT, items_seen INT, retry_count INT, started_at "
        "TIMESTAMP, finished_at TIMESTAMP, last_error_message STRING, created_at TIMESTAMP"
    ),
    "api_request_log": (
        "id BIGINT, crawl_run_id STRING, crawl_partition_id STRING, request_type STRING, endpoint STRING, "
        "method STRING, params_json STRING, request_headers_json STRING, status_code INT, latency_ms INT, "
        "attempt INT, requested_at TIMESTAMP, response_received_at TIMESTAMP, error_type STRING, "
        "error_message STRING"
    ),
    "raw_api_payload": (
        "id BIGINT, api_request_log_id BIGINT, endpoint_type STRING, entity_hh_id STRING, payload_json "
        "STRING, payload_hash STRING, received_at TIMESTAMP"
    ),
    "area": (
        "id STRING, hh_area_id STRING, name STRING, parent_area_id STRING, level INT, path_text STRING, "
        "is_active BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "professional_role": (
        "id STRING, hh_professional_role_id STRING, name STRING, category_name STRING, is_active BOOLEAN, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "dictionary_sync_run": (
        "id STRING, dictionary_name STRING, status STRING, etag STRING, source_status_code INT, notes STRING, "
        "started_at TIMESTAMP, finished_at TIMESTAMP"
    ),
    "employer": (
        "id STRING, hh_employer_id STRING, name STRING, alternate_url STRING, site_url STRING, area_id "
        "STRING, is_trusted BOOLEAN, raw_first_seen_at TIMESTAMP, raw_last_seen_at TIMESTAMP, created_at "
        "TIMESTAMP, updated_at TIMESTAMP"
    ),
    "vacancy": (
        "id STRING, hh_vacancy_id STRING, employer_id STRING, area_id STRING, name_current STRING, "
        "published_at TIMESTAMP, created_at_hh TIMESTAMP, archived_at_hh TIMESTAMP, alternate_url STRING, "
        "employment_type_code STRING, schedule_type_code STRING, experience_code STRING, source_type STRING, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "vacancy_professional_role": (
        "vacancy_id STRING, professional_role_id STRING"
    ),
    "vacancy_seen_event": (
        "id BIGINT, vacancy_id STRING, crawl_run_id STRING, crawl_partition_id STRING, seen_at TIMESTAMP, "
        "list_position INT, short_hash STRING, short_payload_ref_id BIGINT"
    ),
    "vacancy_current_state": (
        "vacancy_id STRING, first_seen_at TIMESTAMP, last_seen_at TIMESTAMP, seen_count INT, "
        "consecutive_missing_runs INT, is_probably_inactive BOOLEAN, last_seen_run_id STRING, last_short_hash "
        "STRING, last_detail_hash STRING, last_detail_fetched_at TIMESTAMP, detail_fetch_status STRING, "
        "first_detail_lease_owner STRING, first_detail_lease_expires_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "vacancy_snapshot": (
        "id BIGINT, vacancy_id STRING, snapshot_type STRING, captured_at TIMESTAMP, crawl_run_id STRING, "
        "short_hash STRING, detail_hash STRING, short_payload_ref_id BIGINT, detail_payload_ref_id BIGINT, "
        "normalized_json STRING, change_reason STRING"
    ),
    "detail_fetch_attempt": (
        "id BIGINT, vacancy_id STRING, crawl_run_id STRING, reason STRING, attempt INT, status STRING, "
        "requested_at TIMESTAMP, finished_at TIMESTAMP, error_message STRING"
    ),
}

ARCHIVE_SCHEMA_VERSION = "1"

# Archive datasets by key: id field, time field, partition columns besides the
# date, whether a dataset is a full copy of one day, and the columns with their types.
ARCHIVE_DATASETS = {
    "bronze/raw_api_payload": {
        "id_field": "raw_api_payload_id",
        "observed_field": "received_at",
        "type_field": "request_type",
        "point_in_time": False,
        "columns": (
            "raw_api_payload_id BIGINT, api_request_log_id BIGINT, crawl_run_id STRING, crawl_partition_id STRING, "
            "request_type STRING, endpoint_type STRING, endpoint STRING, method STRING, params_json STRING, "
            "status_code INT, latency_ms INT, requested_at TIMESTAMP, response_received_at TIMESTAMP, "
            "entity_hh_id STRING, payload_hash STRING, received_at TIMESTAMP, payload_json STRING"
        ),
    },
    "silver/api_request_log": {
        "id_field": "api_request_log_id",
        "observed_field": "requested_at",
        "type_field": None,
        "point_in_time": False,
        "columns": (
            "api_request_log_id BIGINT, crawl_run_id STRING, crawl_partition_id STRING, request_type STRING, "
            "endpoint STRING, method STRING, params_json STRING, status_code INT, latency_ms INT, attempt INT, "
            "requested_at TIMESTAMP, response_received_at TIMESTAMP, error_type STRING, error_message STRING, "
            "raw_api_payload_id BIGINT, payload_hash STRING"
        ),
    },
    "silver/vacancy": {
        "id_field": "vacancy_id",
        "observed_field": "updated_at",
        "type_field": None,
        "point_in_time": True,
        "columns": (
            "vacancy_id STRING, hh_vacancy_id STRING, name_current STRING, employer_id STRING, area_id STRING, "
            "published_at TIMESTAMP, created_at_hh TIMESTAMP, archived_at_hh TIMESTAMP, alternate_url STRING, "
            "employment_type_code STRING, schedule_type_code STRING, experience_code STRING, source_type STRING, "
            "created_at TIMESTAMP, updated_at TIMESTAMP"
        ),
    },
    "silver/vacancy_snapshot": {
        "id_field": "snapshot_id",
        "observed_field": "captured_at",
        "type_field": "snapshot_type",
        "point_in_time": False,
        "columns": (
            "snapshot_id BIGINT, vacancy_id STRING, hh_vacancy_id STRING, snapshot_type STRING, captured_at TIMESTAMP, "
            "crawl_run_id STRING, short_hash STRING, detail_hash STRING, short_payload_ref_id BIGINT, "
            "detail_payload_ref_id BIGINT, short_payload_hash STRING, detail_payload_hash STRING, change_reason STRING"
        ),
    },
    "silver/vacancy_seen_event": {
        "id_field": "seen_event_id",
        "observed_field": "seen_at",
        "type_field": None,
        "point_in_time": False,
        "columns": (
            "seen_event_id BIGINT, vacancy_id STRING, hh_vacancy_id STRING, crawl_run_id STRING, "
            "crawl_partition_id STRING, seen_at TIMESTAMP, list_position INT, short_hash STRING, "
            "short_payload_ref_id BIGINT, short_payload_hash STRING"
        ),
    },
    "silver/vacancy_current_state": {
        "id_field": "vacancy_id",
        "observed_field": "updated_at",
        "type_field": None,
        "point_in_time": True,
        "columns": (
            "vacancy_id STRING, hh_vacancy_id STRING, first_seen_at TIMESTAMP, last_seen_at TIMESTAMP, seen_count INT, "
            "consecutive_missing_runs INT, is_probably_inactive BOOLEAN, last_seen_run_id STRING, "
            "last_short_hash STRING, last_detail_hash STRING, last_detail_fetched_at TIMESTAMP, "
            "detail_fetch_status STRING, updated_at TIMESTAMP"
        ),
    },
    "silver/detail_fetch_attempt": {
        "id_field": "detail_fetch_attempt_id",
        "observed_field": "requested_at",
        "type_field": None,
        "point_in_time": False,
        "columns": (
            "detail_fetch_attempt_id BIGINT, vacancy_id STRING, hh_vacancy_id STRING, crawl_run_id STRING, "
            "reason STRING, attempt INT, status STRING, requested_at TIMESTAMP, finished_at TIMESTAMP, "
            "error_message STRING"
        ),
    },
}

MANIFEST = (
    "export_id STRING, dataset STRING, dataset_key STRING, layer STRING, archive_schema_version STRING, "
    "archive_kind STRING, partition STRING, chunk_index INT, row_count BIGINT, source_min_id BIGINT, "
    "source_max_id BIGINT, source_min_observed_at TIMESTAMP, source_max_observed_at TIMESTAMP, manifest_file STRING, "
    "data_file STRING, data_size_bytes BIGINT, data_sha256 STRING, compression STRING, format STRING, "
    "created_at TIMESTAMP"
)

CHECKPOINT = (
    "checkpoint_id STRING, archive_kind STRING, dataset_key STRING, created_at TIMESTAMP, settled_before TIMESTAMP, "
    "source_id_before BIGINT, source_id_after BIGINT, chunk_count BIGINT, row_count BIGINT"
)

# Probe records: one line per request made by hand.
PROBE = (
    "timestamp_utc STRING, endpoint_kind STRING, status_code INT, error_type STRING, latency_ms DOUBLE, "
    "request_id STRING, params MAP<STRING,STRING>"
)

# The enumerations used in status columns.
ENUMERATIONS = {
    "crawl_run.status": (
        "created", "completed", "succeeded", "completed_with_detail_errors", "completed_with_unresolved", "failed",
    ),
    "crawl_partition.status": (
        "pending", "running", "split_required", "split_done", "done", "failed", "unresolved",
    ),
    "crawl_partition.coverage_status": ("unassessed", "covered", "saturated", "split", "unresolved"),
    "dictionary_sync_run.status": ("running", "succeeded", "failed"),
    "vacancy_current_state.detail_fetch_status": (
        "not_requested", "running", "succeeded", "failed", "terminal_404",
    ),
    "vacancy_snapshot.snapshot_type": ("short", "detail"),
}
