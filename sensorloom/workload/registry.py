"""Registry of the named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: SQL of ``unit_bucket(key, seed, "md5")``.
MD5_NUMBER = "CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT)"

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the equivalent for another engine, if there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
