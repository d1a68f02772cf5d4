"""Registry of named queries and their SQL oracles.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Its oracle (when the
operator is SQL-expressible) is a DuckDB query over the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def load_all() -> None:
    """Import the modules that register queries."""
    from clinsignal.plans import q_ingest, q_model, q_monitor, q_stream  # noqa: F401
