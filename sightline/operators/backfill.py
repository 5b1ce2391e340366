"""Snapshot rows built from stored payloads: fresh ones and those missing from the past."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions import json_ops as j
from sightline.operators.history import change_points
from sightline.operators.retention import is_legacy_snapshot


def with_payload(rows: DataFrame, payloads: DataFrame, ref: str) -> DataFrame:
    """Payload text by reference id; rows without a stored payload keep null."""
    texts = payloads.select(F.col("payload_id").alias(ref), "payload_json")
    return rows.join(texts, ref, "left")


def payload_rows(responses: DataFrame, endpoint_type: str) -> DataFrame:
    """Rows for the payload table, with the canonical hash of the body."""
    return responses.withColumn("endpoint_type", F.lit(endpoint_type)).withColumn(
        "payload_hash", j.canonical_hash(F.col("payload_json"))
    )


def detail_snapshot_rows(attempts: DataFrame, payloads: DataFrame) -> DataFrame:
    """One detail snapshot for every attempt that succeeded."""
    good = attempts.filter(F.col("status") == "succeeded").join(payloads, "payload_id")
    return good.select(
        "payload_id",
        "vacancy_id",
        F.lit("detail").alias("snapshot_type"),
        F.col("finished_at").alias("captured_at"),
        j.canonical_hash(F.col("payload_json")).alias("detail_hash"),
        j.detail_document(F.col("payload_json")).alias("document"),
    )


def backfill_details(snapshots: DataFrame, payloads: DataFrame) -> DataFrame:
    """Old-form detail snapshots with rebuilt document and hash; null where the payload is gone."""
    legacy = snapshots.filter(is_legacy_snapshot())
    joined = with_payload(legacy, payloads, "detail_payload_ref_id")
    usable = j.is_object(j.parse("payload_json"))
    text = F.col("payload_json")
    return joined.withColumn("document", F.when(usable, j.detail_document(text))).withColumn(
        "detail_hash", F.when(usable, j.canonical_hash(text))
    )


def without_stored_snapshot(events: DataFrame, snapshots: DataFrame, snapshot_type: str) -> DataFrame:
    """Sightings that have no snapshot of this type, entity, time and hash yet."""
    stored = snapshots.filter(F.col("snapshot_type") == snapshot_type).select(
        "vacancy_id", F.col("captured_at").alias("seen_at"), "short_hash"
    )
    return events.join(stored, ["vacancy_id", "seen_at", "short_hash"], "left_anti")


def backfill_short(events: DataFrame, payloads: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Missing short snapshots: change points over all sightings, then those with a page reference.

    ``skipped`` tells why no document could be built.
    """
    changes = change_points(events, ["vacancy_id"], ["seen_at", "id"], "short_hash")
    due = without_stored_snapshot(changes.filter("short_payload_ref_id is not null"), snapshots, "short")
    joined = with_payload(due, payloads, "short_payload_ref_id")
    page = j.parse("payload_json")
    item = j.item_by_id(F.col("_page"), F.col("hh_vacancy_id"))
    found = joined.withColumn("_page", page).withColumn("_item", item)
    context = F.struct("seen_at", "crawl_partition_id")
    skipped = F.when(F.col("_page").isNull(), "missing_payload").when(F.col("_item").isNull(), "missing_item")
    return (
        found.withColumn("skipped", skipped)
        .withColumn("document", F.when(F.col("_item").isNotNull(), j.short_document(F.col("_item"), context)))
        .drop("_page", "_item", "payload_json")
    )
