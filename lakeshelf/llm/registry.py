"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
TWINS: dict[str, str] = {}


def query(name: str, twin: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query, with the SQL that gives the same rows where SQL can."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if twin is not None:
            TWINS[name] = twin.strip()
        return fn

    return register
