"""Named queries over the text operators, each next to its SQL where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = ("simhash", "suffix", "automaton", "bpe", "mil", "sharding", "repetition", "language", "repair", "neighbours", "infill", "countmin", "phrases")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        importlib.import_module(f"sightline.llm.plans.{module}")
    return QUERIES, ORACLES
