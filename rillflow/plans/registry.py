"""Names of the registered queries and their DuckDB SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Modules with QUERIES (name -> function) and ORACLES (name -> SQL).
MODULES: tuple[str, ...] = ("seasons_q", "capacity_q", "model_q", "matching_q", "audit_q", "files_q", "formats_q", "places_q", "streams_q")


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"rillflow.plans.{name}"), attribute)
        if twice := out.keys() & part.keys():
            raise ValueError(f"registered twice: {sorted(twice)}")
        out |= part
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query functions by name."""
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return _merged("ORACLES")
