"""Registered queries against their SQL on DuckDB. All of them with SIGHTLINE_ALL=1."""

import os

import pytest

from bench import HEADLINE
from sightline.plans.registry import load_all
from tests.oracle_check import compare, duck

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load_all()
EXTRA = ("J2_role_links", "M1_area_upsert", "M15_short_backfill", "C13_partition_state_machine", "W9_search_only_analysis",
         "O9_held_for", "R5_retention_plan", "R10_apply_exact_removal", "S4_snapshot_scan", "A12_coverage_summary", "X4_streaming_change_points")
CHOSEN = list(QUERIES) if os.environ.get("SIGHTLINE_ALL") else [*HEADLINE, *EXTRA]


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        ok, message = compare(df, con, ORACLES[name])
        assert ok, message
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 200
