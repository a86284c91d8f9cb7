"""Gold: hourly and daily facts and the cross-source daily summaries.

Shuffle design: every aggregate combines on the map side first, so what is shuffled
grows with the number of groups and not with the number of rows, and a key that holds
a third of all rows costs no more than any other. The daily summaries join frames that
are already one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeshelf import functions as L
from lakeshelf.operators.aggregates import group_with_mode
from lakeshelf.plans import labels as V
from lakeshelf.plans.dims import join_dates
from lakeshelf.plans.silver import traffic_level


def _volume_totals() -> list[Column]:
    volume = F.col("traffic_volume")
    return [
        F.max(volume).alias("max_traffic_volume"),
        F.min(volume).alias("min_traffic_volume"),
        F.sum(volume).alias("total_traffic_volume"),
        F.count(F.lit(1)).alias("measurement_count"),
    ]


def fact_traffic_hourly(silver: DataFrame) -> DataFrame:
    """Traffic per hour and conditions, from silver; averages keep the engine's precision."""
    volume = F.col("traffic_volume")
    return silver.groupBy(
        F.col("event_hour").alias("hour_key"),
        F.col("event_date").alias("date_key"),
        "hour_of_day",
        "day_of_week",
        "is_weekend",
        (F.col("holiday_name") != F.lit(V.NO_HOLIDAY)).alias("is_holiday"),
        "weather_condition",
        "temperature_celsius",
        "rainfall_mm",
        "snowfall_mm",
    ).agg(
        L.round_half_even_int(F.avg(volume)).alias("avg_traffic_volume"),
        *_volume_totals(),
        F.stddev_samp(volume).alias("traffic_stddev"),
    )


def fact_traffic_hourly_model(staging: DataFrame) -> DataFrame:
    """Traffic per hour and weather, from staging; rounded, with a level for the hour."""
    volume = F.col("traffic_volume")
    return staging.groupBy(
        F.col("event_hour").alias("hour_key"),
        F.col("event_date").alias("date_key"),
        "hour_of_day",
        "day_of_week",
        "is_weekend",
        "weather_condition",
    ).agg(
        L.round_to(F.avg("temperature_celsius"), 2).alias("avg_temperature_celsius"),
        L.round_to(F.avg("rainfall_mm"), 3).alias("avg_rainfall_mm"),
        L.round_to(F.avg("snowfall_mm"), 3).alias("avg_snowfall_mm"),
        L.round_to(F.avg(volume), 0).cast("int").alias("avg_traffic_volume"),
        *_volume_totals(),
        L.round_to(F.stddev_samp(volume), 2).alias("traffic_stddev"),
        traffic_level(F.avg(volume)).alias("traffic_level"),
    )


_POLLUTANTS = ("aqi", "pm25", "pm10", "ozone", "carbon_monoxide", "sulfur_dioxide", "nitrogen_dioxide")


def _air_daily(air: DataFrame) -> DataFrame:
    """Daily sums per city, with the most frequent category.

    A mean is carried through both levels as a sum and a count of non-null values.
    """
    n = F.sum("n_rows")
    partial = {f"s_{c}": F.sum(c) for c in _POLLUTANTS}
    partial |= {f"k_{c}": F.count(c) for c in _POLLUTANTS}
    partial |= {
        "aqi_high": F.max("aqi"),
        "aqi_low": F.min("aqi"),
        "pm25_high": F.max("pm25"),
        "hazardous": F.count_if(F.col("is_hazardous")),
    }
    final = {f"mean_{c}": F.try_divide(F.sum(f"s_{c}"), F.sum(f"k_{c}")) for c in _POLLUTANTS}
    final |= {
        "aqi_high": F.max("aqi_high"),
        "aqi_low": F.min("aqi_low"),
        "pm25_high": F.max("pm25_high"),
        "hazardous": F.sum("hazardous"),
        "hazardous_pct": L.percent_of(F.sum("hazardous"), n),
        "n": n,
    }
    by_day = air.withColumnRenamed("measurement_date", "date_key")
    return group_with_mode(
        by_day, ["city", "date_key"], "aqi_category", "dominant_aqi_category", partial, final
    )


def fact_air_quality_daily(silver: DataFrame) -> DataFrame:
    """Air quality per city and day, from silver; unrounded."""
    return _air_daily(silver).select(
        "city",
        "date_key",
        F.col("mean_aqi").alias("avg_aqi"),
        F.col("aqi_high").alias("max_aqi"),
        F.col("aqi_low").alias("min_aqi"),
        F.col("mean_pm25").alias("avg_pm25"),
        F.col("mean_pm10").alias("avg_pm10"),
        F.col("mean_ozone").alias("avg_ozone"),
        F.col("mean_carbon_monoxide").alias("avg_co"),
        F.col("hazardous").alias("hazardous_hours"),
        F.col("n").alias("measurement_count"),
        "dominant_aqi_category",
    )


def fact_air_quality_daily_model(staging: DataFrame) -> DataFrame:
    """Air quality per city and day, from staging; rounded, with the hazardous share."""

    def rounded(name: str, digits: int = 2) -> Column:
        return L.round_to(F.col(name), digits)

    return _air_daily(staging).select(
        "city",
        "date_key",
        rounded("mean_aqi").alias("avg_aqi"),
        rounded("aqi_high").alias("max_aqi"),
        rounded("aqi_low").alias("min_aqi"),
        rounded("mean_pm25").alias("avg_pm25"),
        rounded("pm25_high").alias("max_pm25"),
        rounded("mean_pm10").alias("avg_pm10"),
        rounded("mean_ozone").alias("avg_ozone"),
        rounded("mean_carbon_monoxide", 3).alias("avg_carbon_monoxide"),
        rounded("mean_sulfur_dioxide").alias("avg_sulfur_dioxide"),
        rounded("mean_nitrogen_dioxide").alias("avg_nitrogen_dioxide"),
        F.col("n").alias("measurement_count"),
        F.col("hazardous").alias("hazardous_hours_count"),
        rounded("hazardous_pct").alias("hazardous_hours_pct"),
        "dominant_aqi_category",
    )


def fact_stream_events_hourly(silver: DataFrame) -> DataFrame:
    """Events per hour, category and topic.

    The two distinct counts share one aggregate: Spark copies a row once per counted
    column and combines the copies per task, so the shuffle carries the sensors plus the
    locations of an hour. Grouping by both columns first would carry their combinations.
    """
    value = F.col("metric_value")
    return silver.groupBy(F.col("event_hour").alias("hour_key"), "event_category", "kafka_topic").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("sensor_id").alias("unique_sensors"),
        F.count_distinct("location_id").alias("unique_locations"),
        F.avg(value).alias("avg_metric_value"),
        F.max(value).alias("max_metric_value"),
        F.min(value).alias("min_metric_value"),
    )


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def _events_daily(fact_events: DataFrame, *extra: Column) -> DataFrame:
    """Daily sums over the hourly facts. ``sensors`` adds up hourly distinct counts, as
    the summaries define it; it counts a sensor once per hour and category."""
    return fact_events.groupBy(F.to_date("hour_key").alias("date_key")).agg(
        F.sum("event_count").alias("total_stream_events"),
        F.sum("unique_sensors").alias("sensors"),
        *extra,
    )


def urban_daily_two_way(fact_traffic: DataFrame, fact_events: DataFrame) -> DataFrame:
    """Traffic and events per day; days of either side, missing numbers as zero."""
    traffic = fact_traffic.groupBy("date_key").agg(
        F.avg("avg_traffic_volume").alias("avg_daily_traffic"),
        F.sum("total_traffic_volume").alias("total_daily_traffic"),
    )
    events = _events_daily(fact_events).withColumnRenamed("sensors", "total_sensors_active")
    return (
        traffic.join(events, "date_key", "full_outer")
        .where(F.col("date_key").isNotNull())
        .select(
            "date_key",
            *[
                _zero(c)
                for c in (
                    "avg_daily_traffic", "total_daily_traffic",
                    "total_stream_events", "total_sensors_active",
                )
            ],
        )
    )


def health_score(avg_aqi: Column, weekend: Column) -> Column:
    low, high = V.HEALTH_SCORE_RANGE
    bonus = F.when(weekend, F.lit(V.HEALTH_SCORE_WEEKEND_BONUS)).otherwise(F.lit(0.0))
    raw = F.lit(high) - avg_aqi / F.lit(V.HEALTH_SCORE_AQI_DIVISOR) + bonus
    return L.round_to(F.greatest(F.lit(low), F.least(F.lit(high), raw)), 1)


def agg_urban_daily(
    fact_traffic: DataFrame, fact_air: DataFrame, fact_events: DataFrame, dates: DataFrame
) -> DataFrame:
    """Traffic, air and events per day with calendar columns and a health score.

    Reads the model forms of the traffic and air facts. Joining on ``date_key`` by name
    coalesces the key of both sides, so the second outer join also matches days that
    only one of the first two sides has. The result is one row per day: order it when
    reading (``orderBy("date_key")``), and write it with ``sortWithinPartitions``.
    """
    traffic = group_with_mode(
        fact_traffic,
        ["date_key"],
        "traffic_level",
        "traffic_level_mode",
        partial={
            "s": F.sum("avg_traffic_volume"),
            "k": F.count("avg_traffic_volume"),
            "total": F.sum("total_traffic_volume"),
            "peak": F.max("max_traffic_volume"),
        },
        final={
            "avg_daily_traffic": F.try_divide(F.sum("s"), F.sum("k")),
            "total_daily_traffic": F.sum("total"),
            "peak_traffic_volume": F.max("peak"),
            "traffic_hours_measured": F.sum("n_rows"),
        },
    )
    air = fact_air.groupBy("date_key").agg(
        F.avg("avg_aqi").alias("avg_daily_aqi"),
        F.max("max_aqi").alias("peak_aqi"),
        F.sum("hazardous_hours_count").alias("total_hazardous_hours"),
        F.count_distinct("city").alias("cities_measured"),
    )
    events = _events_daily(fact_events).withColumnRenamed("sensors", "sensors_active")
    joined = (
        traffic.join(air, "date_key", "full_outer")
        .join(events, "date_key", "full_outer")
        .where(F.col("date_key").isNotNull())
    )
    calendar = dates.select("date_key", "day_name", "is_weekend", "season", "month_name")
    aqi = F.coalesce(F.col("avg_daily_aqi"), F.lit(0.0))
    return join_dates(joined, calendar).select(
        "date_key",
        "day_name",
        "is_weekend",
        "season",
        "month_name",
        *[_zero(c) for c in ("avg_daily_traffic", "total_daily_traffic", "peak_traffic_volume")],
        F.coalesce(F.col("traffic_level_mode"), F.lit(V.UNKNOWN)).alias("traffic_level"),
        *[
            _zero(c)
            for c in (
                "traffic_hours_measured", "avg_daily_aqi", "peak_aqi", "total_hazardous_hours",
                "cities_measured", "total_stream_events", "sensors_active",
            )
        ],
        health_score(aqi, F.col("is_weekend")).alias("urban_health_score"),
    )


def exact_daily_sensors(silver_events: DataFrame) -> DataFrame:
    """Sensors really seen per day; an addition next to the summed hourly counts."""
    return silver_events.groupBy(F.to_date("event_hour").alias("date_key")).agg(
        F.count_distinct("sensor_id").alias("distinct_sensors")
    )
