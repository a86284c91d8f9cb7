"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The separator and the null marker decide the key's bytes.
KEY_SEPARATOR = "|"
KEY_NULL_MARKER = "__null__"


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 over the text forms of the columns.

    Use it on integer, text, date and boolean columns: the text form of a
    floating-point number differs between engines.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(KEY_NULL_MARKER))
        for c in cols
    ]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
