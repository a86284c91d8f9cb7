"""The date dimension, and joining it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeshelf.functions import day_of_week, is_weekend, season_name, season_number

# The span of the dimension, both ends included.
FIRST_DAY = date(2020, 1, 1)
LAST_DAY = date(2026, 12, 31)


def day_spine(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day."""
    days = F.sequence(F.lit(first), F.lit(last), F.make_dt_interval(days=F.lit(1)))
    return spark.range(1).select(F.explode(days).alias("date_key"))


def dim_date(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """The full 21-column dimension."""
    d = F.col("date_key")
    weekend = is_weekend(d)
    return day_spine(spark, first, last).select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month_num"),
        F.dayofmonth(d).alias("day_num"),
        day_of_week(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_int"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        season_name(d).alias("season"),
        season_number(d).alias("season_num"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        F.trunc(d, "quarter").alias("first_day_of_quarter"),
        F.trunc(d, "year").alias("first_day_of_year"),
    )


def dim_date_short(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """The 12-column form: a projection of the full one."""
    return dim_date(spark, first, last).select(
        "date_key", "year", F.col("month_num").alias("month"), F.col("day_num").alias("day"),
        "day_of_week", "day_of_year", "week_of_year", "quarter", "day_name", "month_name",
        "is_weekend", "season",
    )


def join_dates(df: DataFrame, dates: DataFrame, how: str = "left") -> DataFrame:
    """Join the dimension on ``date_key``. The planner knows the size of ``dates`` and broadcasts it if it is small."""
    return df.join(dates, "date_key", how)
