"""Aggregates that need more than one built-in call to stay cheap on large groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def count_distinct_tuple(*cols: str) -> Column:
    """Distinct values of one column (nulls ignored), or distinct tuples of several
    (a tuple holding nulls is a value)."""
    if len(cols) == 1:
        return F.count_distinct(F.col(cols[0]))
    return F.count_distinct(F.struct(*[F.col(c) for c in cols]))


def most_frequent(value: str, weight: str) -> Column:
    """Most frequent value over rows already counted per value; ties go to the smallest.

    ``mode()`` keeps every value of a group in one map and sorts its input beyond a
    few groups. Over pre-counted rows this is one small ``min_by`` instead. A null
    value never wins unless the group has nothing else.
    """
    rank = F.struct(F.col(value).isNull(), -F.col(weight), F.col(value))
    return F.min_by(F.col(value), rank)


def group_with_mode(
    df: DataFrame,
    keys: Sequence[str],
    mode_of: str,
    mode_name: str,
    partial: Mapping[str, Column],
    final: Mapping[str, Column],
) -> DataFrame:
    """Group by ``keys`` and also give the most frequent value of ``mode_of``.

    Two levels: the first groups by keys and value with plain (map-side combined)
    aggregates, so a group of any size reaches the second level as one row per
    distinct value. ``partial`` names the first-level aggregates and ``final``
    combines them; the column ``n_rows`` is always there.
    """
    counted = df.groupBy(*keys, mode_of).agg(
        F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in partial.items()]
    )
    return counted.groupBy(*keys).agg(
        *[c.alias(n) for n, c in final.items()],
        most_frequent(mode_of, "n_rows").alias(mode_name),
    )
