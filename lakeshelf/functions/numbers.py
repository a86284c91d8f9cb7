"""Number helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even_int(c: Column) -> Column:
    """DOUBLE to INT by rounding half to even (a plain Spark cast truncates)."""
    return F.rint(c).cast("int")


def round_to(c: Column, digits: int) -> Column:
    """Round a DOUBLE half away from zero by scaling: ``round(c * 10^n) / 10^n``.

    ``F.round(c, n)`` rounds the decimal text of the number instead: the two differ on
    values such as 1.005 that look like a tie and are none, and going through text is
    slow. ``rint`` rounds ties to even; the ties it took towards zero are put right.
    """
    scale = F.lit(float(10**digits))
    scaled = c * scale if digits else c
    whole = F.rint(scaled)
    gap = scaled - whole
    away = (
        F.when((gap == 0.5) & (scaled > 0), whole + 1)
        .when((gap == -0.5) & (scaled < 0), whole - 1)
        .otherwise(whole)
    )
    return away / scale if digits else away


def between_or_null(c: Column, low: float | None, high: float | None) -> Column:
    """The value inside the inclusive bounds, else null; a missing bound is open."""
    inside = F.lit(True)
    if low is not None:
        inside = inside & (c >= F.lit(low))
    if high is not None:
        inside = inside & (c <= F.lit(high))
    return c if low is None and high is None else F.when(inside, c)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null where ``whole`` is zero."""
    return F.try_divide(part * F.lit(100.0), whole)
