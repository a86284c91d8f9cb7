"""Date and time helpers. The session time zone is UTC (see ``session``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakeshelf.functions.labels import _ordered

# Seasons by month number; the rest of the year is the last season.
SEASON_MONTHS = [("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8))]
LAST_SEASON = "Autumn"


def minute_start(c: Column) -> Column:
    return F.date_trunc("minute", c)


def hour_start(c: Column) -> Column:
    return F.date_trunc("hour", c)


def day_start(c: Column) -> Column:
    """The calendar day, as a DATE, so that daily keys of all sources join directly."""
    return F.to_date(c)


def day_of_week(c: Column) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(c) - F.lit(1)


def is_weekend(c: Column) -> Column:
    """True on Saturday and Sunday, false otherwise (also for a null date)."""
    return F.coalesce(F.dayofweek(c).isin(1, 7), F.lit(False))


def season_name(c: Column) -> Column:
    month = F.month(c)
    return _ordered([(month.isin(*months), name) for name, months in SEASON_MONTHS], LAST_SEASON)


def season_number(c: Column) -> Column:
    """1 = Winter .. 4 = Autumn."""
    names = [name for name, _ in SEASON_MONTHS] + [LAST_SEASON]
    return F.array_position(F.array(*[F.lit(n) for n in names]), season_name(c)).cast("int")


def epoch_to_timestamp(c: Column) -> Column:
    """Epoch seconds to a timestamp."""
    return F.timestamp_seconds(c)
