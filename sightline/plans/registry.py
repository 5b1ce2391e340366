"""Registry of named queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = (
    "history",
    "inventory",
    "backlog",
    "retention",
    "payloads",
    "upserts",
    "coverage",
    "requests",
    "study",
    "archive",
    "streams",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` together with its SQL equivalent, if it has one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        importlib.import_module(f"sightline.plans.{module}")
    return QUERIES, ORACLES
