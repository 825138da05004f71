"""Queries of the subpackage: key -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
