"""Registry of named queries and their DuckDB oracle SQL.

A query is ``(spark, data_dir) -> DataFrame``; its oracle, when SQL can
express it, is a DuckDB statement over the same tables registered as views.
Both sides alias every computed column to the same name.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            ship_package(spark)  # the Arrow UDFs import this package in the workers
            return fn(spark, data_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def load_all() -> None:
    """Import the modules that register queries."""
    from scriptorium.plans import (  # noqa: F401
        chat_queries,
        clean_queries,
        source_queries,
        token_queries,
    )
