"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "W1_change_points",
    "W2_latest_failed_attempt",
    "W5_annotated_requests",
    "W7_session_summary",
    "M4_vacancy_upsert",
    "M6_observe_fold",
    "M8_reconcile_run",
    "M13_refetch_reason",
    "T1_backlog_top_k",
    "G1_payload_summary",
    "G3_key_frequency",
    "G7_fill_rates",
    "G20_exact_percentiles",
    "R1_payload_candidates",
    "R2_snapshot_candidates",
    "R6_generation_retention",
    "N2_short_records",
    "N10_canonical_hash",
    "N17_leaf_values",
    "C1_coverage_summary",
    "C2_coverage_tree",
    "C10_split_to_fixpoint",
    "O2_duration_histogram",
    "O11_throughput",
    "D1_search_vs_detail",
    "A8_incremental_export",
    "A10_chain_audit",
    "X3_streaming_fold",
)


def main() -> None:
    from sightline.plans.registry import load_all
    from sightline.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    queries = load_all()[0]
    chosen = list(queries) if names == "all" else names.split(",") if names else list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()  # start the JVM up
    times = {}
    for name in chosen:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
