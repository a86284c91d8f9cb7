"""Bronze to silver: one narrow projection per source, no shuffle.

Each function takes the bronze frame and returns the cleaned one. ``stamp`` adds
``silver_processed_at``; it is left to the caller so that the transforms stay
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeshelf import functions as L
from lakeshelf.operators.filters import present
from lakeshelf.plans import labels as V


def _or(name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def stamp(df: DataFrame, name: str = "silver_processed_at") -> DataFrame:
    """Add the processing time, one value for the whole run."""
    return df.withColumn(name, F.current_timestamp())


def traffic_level(volume: Column) -> Column:
    return L.below(volume, V.TRAFFIC_LEVELS, V.TRAFFIC_LEVEL_TOP)


def event_category(event_type: Column) -> Column:
    return L.first_match(event_type, V.EVENT_CATEGORIES, V.EVENT_CATEGORY_OTHER)


def usable_traffic(bronze: DataFrame) -> DataFrame:
    """Rows with a time and a plausible volume. The bounds reach the Parquet scan."""
    low, high = V.TRAFFIC_VOLUME_RANGE
    return bronze.where(present("event_timestamp") & F.col("traffic_volume").between(low, high))


def traffic_time_columns(ts: Column) -> list[Column]:
    """The time columns shared by the silver and staging forms."""
    return [
        L.hour_start(ts).alias("event_hour"),
        L.day_start(ts).alias("event_date"),
        F.hour(ts).alias("hour_of_day"),
        L.day_of_week(ts).alias("day_of_week"),
        L.is_weekend(ts).alias("is_weekend"),
    ]


def silver_traffic(bronze: DataFrame) -> DataFrame:
    ts = F.col("event_timestamp").cast("timestamp")
    return usable_traffic(bronze).select(
        ts.alias("event_timestamp"),
        *traffic_time_columns(ts),
        _or("holiday_name", V.NO_HOLIDAY),
        L.round_to(F.col("temperature_kelvin") - F.lit(V.KELVIN_OFFSET), 2).alias("temperature_celsius"),
        _or("rainfall_mm", 0.0),
        _or("snowfall_mm", 0.0),
        _or("cloud_coverage_pct", 0),
        L.tidy_upper(F.col("weather_condition")).alias("weather_condition"),
        L.tidy_lower(F.col("weather_description")).alias("weather_description"),
        "traffic_volume",
        traffic_level(F.col("traffic_volume")).alias("traffic_level"),
        "_ingestion_timestamp",
        "_source_id",
        "_batch_id",
    )


def silver_air_quality(bronze: DataFrame) -> DataFrame:
    ts = F.col("measurement_timestamp").cast("timestamp")
    gases = ("ozone", "carbon_monoxide", "sulfur_dioxide", "nitrogen_dioxide")
    return bronze.where(present("city", "measurement_timestamp")).select(
        L.tidy_upper(F.col("city")).alias("city"),
        ts.alias("measurement_timestamp"),
        L.hour_start(ts).alias("measurement_hour"),
        L.day_start(ts).alias("measurement_date"),
        *[_or(c, 0.0) for c in ("pm25", "pm10", "aqi")],
        _or("aqi_category", V.UNKNOWN),
        *[_or(c, 0.0) for c in gases],
        F.coalesce(F.col("aqi") > F.lit(V.HAZARDOUS_AQI), F.lit(False)).alias("is_hazardous"),
        "_ingestion_timestamp",
        "_source_id",
    )


def silver_weather(bronze: DataFrame) -> DataFrame:
    ts = L.epoch_to_timestamp(F.col("observation_timestamp"))
    celsius = F.col("temperature_celsius")
    return bronze.where(present("city_name")).select(
        L.tidy_upper(F.col("city_name")).alias("city_name"),
        ts.alias("observation_timestamp"),
        L.hour_start(ts).alias("observation_hour"),
        L.round_to(celsius, 2).alias("temperature_celsius"),
        L.round_to(F.col("feels_like_celsius"), 2).alias("feels_like_celsius"),
        _or("humidity_pct", 0),
        _or("pressure_hpa", V.PRESSURE_DEFAULT),
        _or("wind_speed_ms", 0.0),
        L.tidy_upper(F.col("weather_condition")).alias("weather_condition"),
        "latitude",
        "longitude",
        L.at_least(celsius, V.TEMPERATURE_CATEGORIES, V.TEMPERATURE_CATEGORY_BOTTOM).alias(
            "temperature_category"
        ),
        "_ingestion_timestamp",
        "_source_id",
    )


def silver_stream_events(bronze: DataFrame, *carried: str) -> DataFrame:
    """``carried`` names bronze columns to keep besides the silver ones."""
    ts = F.col("event_timestamp").cast("timestamp")

    def number(name: str, digits: int) -> Column:
        return L.round_to(F.col(name).cast("double"), digits).alias(name)

    return bronze.where(present("event_id", "event_type")).select(
        "event_id",
        L.tidy_upper(F.col("event_type")).alias("event_type"),
        "sensor_id",
        "location_id",
        number("latitude", 6),
        number("longitude", 6),
        ts.alias("event_timestamp"),
        L.minute_start(ts).alias("event_minute"),
        L.hour_start(ts).alias("event_hour"),
        number("metric_value", 4),
        F.trim("metric_unit").alias("metric_unit"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        event_category(F.col("event_type")).alias("event_category"),
        "_ingestion_timestamp",
        "_source_id",
        *carried,
    )


def silver_demographics(bronze: DataFrame) -> DataFrame:
    return bronze.where(present("city_name")).select(
        L.tidy_upper(F.col("city_name")).alias("city_name"),
        L.tidy_upper(F.col("state_code")).alias("state_code"),
        "state_name",
        _or("median_age", V.MEDIAN_AGE_DEFAULT),
        *[_or(c, 0) for c in ("total_population", "male_population", "female_population")],
        _or("avg_household_size", V.HOUSEHOLD_SIZE_DEFAULT),
        "race",
        _or("race_count", 0),
        # on the raw column: an unknown population counts as the top size
        L.below(F.col("total_population"), V.CITY_SIZES, V.CITY_SIZE_TOP).alias("city_size_category"),
        "_ingestion_timestamp",
        "_source_id",
    )
