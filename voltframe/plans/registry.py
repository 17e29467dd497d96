"""The catalogue's dictionaries: queries by name, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltframe.sources.fixtures import duckdb_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def q(body: str, uses=("fx_bronze",), ctes=()) -> str:
    return duckdb_sql(body, uses, list(ctes))
