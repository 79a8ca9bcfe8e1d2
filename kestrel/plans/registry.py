"""Named queries over a data directory, each with an optional DuckDB oracle.

A query is a function ``(spark, data_dir) -> DataFrame``. Its oracle is an
ANSI SQL string over the same tables (views named like the parquet files)
returning the same columns; queries without an oracle are checked by
row properties in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn`` under ``key`` (and its oracle SQL, if any)."""
    def wrap(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn
    return wrap
