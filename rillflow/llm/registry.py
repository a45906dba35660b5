"""Names of the queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Modules with QUERIES and ORACLES.
MODULES = ("queries_tables", "queries_models", "queries_search")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query functions by name."""
    out: dict = {}
    for name in MODULES:
        out |= importlib.import_module(f"rillflow.llm.{name}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    out: dict = {}
    for name in MODULES:
        out |= importlib.import_module(f"rillflow.llm.{name}").ORACLES
    return out
