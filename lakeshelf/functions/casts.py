"""Tolerant casts by configured type name: a value that cannot be cast becomes null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# The type names a source spec may use, by the kind of cast they ask for.
CAST_TYPES = {
    "text": ("varchar", "string", "str", "text", "date", "json"),
    "integer": ("integer", "int", "bigint", "long"),
    "floating": ("double", "float", "real"),
    "boolean": ("boolean", "bool"),
    "timestamp": ("timestamp",),
}
_KIND_OF = {name: kind for kind, names in CAST_TYPES.items() for name in names}

# Texts a cast can read. A cast that fails raises and catches an exception inside Spark,
# which costs ten times the cast itself, so other texts are kept away from it.
_INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER_TEXT = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)\s*$"
_BOOLEAN_TEXTS = ("true", "t", "yes", "y", "1", "false", "f", "no", "n", "0")

# A double without a fraction is an exact BIGINT from the first of these to below the second.
_BIGINT_FROM, _BIGINT_BELOW = -(2.0**63), 2.0**63


def cast_kind(type_name: str) -> str:
    """The kind of cast behind a type name; unknown names leave the column alone."""
    return _KIND_OF.get(type_name.lower(), "text")


def number_of(c: Column, source: T.DataType = T.StringType()) -> Column:
    """The value as DOUBLE, null where it is no number."""
    if isinstance(source, T.StringType):
        return F.when(c.rlike(_NUMBER_TEXT), c.try_cast("double"))
    return c.try_cast("double")


def _whole_number(c: Column, source: T.DataType) -> Column:
    """Exact integers directly; '12.0' and '1e3' by way of DOUBLE; '12.7' is rejected."""
    if isinstance(source, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(source, T.DecimalType):
        return F.when(F.floor(c) == c, c).try_cast("bigint")
    as_double = number_of(c, source)
    by_double = F.when(
        (F.rint(as_double) == as_double) & (as_double >= F.lit(_BIGINT_FROM)) & (as_double < F.lit(_BIGINT_BELOW)),
        as_double,
    ).cast("bigint")
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return by_double
    return F.when(c.rlike(_INTEGER_TEXT), c.try_cast("bigint")).otherwise(by_double)


def _truth(c: Column, source: T.DataType) -> Column:
    if isinstance(source, T.StringType):
        return F.when(F.lower(F.trim(c)).isin(*_BOOLEAN_TEXTS), c.try_cast("boolean"))
    return c.try_cast("boolean")


def _moment(c: Column, source: T.DataType, formats: Sequence[str]) -> Column:
    """Text in ISO form or one of ``formats``, naive text being UTC; integers are epoch nanoseconds."""
    if isinstance(source, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.timestamp_micros(F.call_function("div", c, F.lit(1000)))
    if isinstance(source, T.StringType):
        tries = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats]
        return F.coalesce(c.try_cast("timestamp"), *tries) if tries else c.try_cast("timestamp")
    return c.try_cast("timestamp")


def tolerant_cast(
    c: Column, type_name: str, source: T.DataType, formats: Sequence[str] = ()
) -> Column:
    """Cast ``c`` (of type ``source``) to the configured type.

    The text kinds, ``date`` and ``json`` among them, keep the column as it is.
    """
    kind = cast_kind(type_name)
    if kind == "integer":
        return _whole_number(c, source)
    if kind == "floating":
        return number_of(c, source)
    if kind == "boolean":
        return _truth(c, source)
    if kind == "timestamp":
        return _moment(c, source, formats)
    return c
