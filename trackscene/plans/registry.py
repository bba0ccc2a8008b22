"""Query registry: name -> (Spark query over the driver tables, DuckDB oracle SQL).

Every query reads whole driver tables (through the fixture views) and calls
the library operators; the oracle is the same result written as plain SQL.
Column names and types are aligned on both sides (aliases and casts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import queries_archives, queries_eval, queries_keys, queries_match, queries_raster, queries_scenes  # noqa: F401
