"""Where queries and their SQL twins are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
TWINS: dict[str, str] = {}


def query(name: str, twin: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if twin is not None:
            TWINS[name] = twin.strip()
        return fn

    return register


def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    from lakeshelf.workload import basics, checks, exactness, ingest, layers, writes  # noqa: F401

    return QUERIES, TWINS
