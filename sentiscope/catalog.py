"""Registry of the queries exposed through ``__spark_entry__``.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` plus, where the result
is expressible in SQL, the DuckDB oracle text over the driver tables.  Oracles
inline the fixture relations of ``sources.fixtures`` as CTEs.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sentiscope.sources.fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None, fixtures: tuple[str, ...] = ()):
    """Register a query under ``key`` with an optional DuckDB oracle."""

    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_fixtures(oracle, *fixtures)
        return fn

    return deco


PLAN_MODULES = ("monitor_queries", "prepare_queries", "evaluate_queries", "text_queries",
                "sampling_queries", "model_queries", "stream_queries")


def load_all() -> None:
    """Import the modules that register queries; a missing one is an error."""
    for name in PLAN_MODULES:
        importlib.import_module(f"sentiscope.plans.{name}")
