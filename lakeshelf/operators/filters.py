"""Row filters that recur in the layers."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def present(*names: str) -> Column:
    """All of the columns are non-null."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def recent(c: Column, now: Column | datetime, *, minutes: int = 0, hours: int = 0) -> Column:
    """Not older than the given age at ``now`` (a fixed run time, so re-runs agree)."""
    at = now if isinstance(now, Column) else F.lit(now)
    return c >= at - F.make_dt_interval(hours=F.lit(hours), mins=F.lit(minutes))


def newer_than_target(source: DataFrame, target: DataFrame, column: str, target_column: str) -> DataFrame:
    """Source rows strictly newer than the newest row of the target.

    An uncorrelated scalar subquery: Spark runs it first and pushes its value into
    the source scan. An empty target has no newest row and so lets nothing through;
    ``incremental.load`` starts such a target with a full load.
    """
    newest = target.agg(F.max(target_column)).scalar()
    return source.where(F.col(column) > newest)
