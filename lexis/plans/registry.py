"""Query registry: key -> Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the query is SQL-expressible, the DuckDB oracle statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their ``register`` calls run."""
    from lexis.plans import (cleaning, evaluation, io, models, profiling, search,  # noqa: F401
                             splits, vectors)
