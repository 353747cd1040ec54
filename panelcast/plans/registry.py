"""Catalog of named queries over the landed tables.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` plus, when the semantics are
SQL-expressible, an equivalent DuckDB SQL text used as an independent oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, sql: str | None = None, covers: str = ""):
    """Register ``fn`` under ``name``; ``sql`` is the oracle (omit for rows-only checks)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        COVERS[name] = covers
        return fn

    return deco
