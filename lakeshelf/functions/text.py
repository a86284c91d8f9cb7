"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def tidy_upper(c: Column) -> Column:
    """Upper case without surrounding spaces (tabs are kept)."""
    return F.upper(F.trim(c))


def tidy_lower(c: Column) -> Column:
    """Lower case without surrounding spaces (tabs are kept)."""
    return F.lower(F.trim(c))
