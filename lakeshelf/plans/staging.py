"""Staging views: the model form of the cleaned sources. The gold models read these.

Each exists twice: as a transform of a frame, and as the SQL of a view that the catalog keeps, which any session can
read. Tests hold the two against each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeshelf import functions as L
from lakeshelf.plans import labels as V
from lakeshelf.plans.silver import (
    _or,
    silver_air_quality,
    silver_stream_events,
    traffic_time_columns,
    usable_traffic,
)


def stg_traffic(bronze: DataFrame) -> DataFrame:
    """Like silver, but Celsius is unrounded with a default, and there is no level."""
    ts = F.col("event_timestamp").cast("timestamp")
    celsius = F.col("temperature_kelvin") - F.lit(V.KELVIN_OFFSET)
    return usable_traffic(bronze).select(
        ts.alias("event_timestamp"),
        *traffic_time_columns(ts),
        _or("holiday_name", V.NO_HOLIDAY),
        F.coalesce(celsius, F.lit(V.STAGING_TEMPERATURE_DEFAULT)).alias("temperature_celsius"),
        _or("rainfall_mm", 0.0),
        _or("snowfall_mm", 0.0),
        _or("cloud_coverage_pct", 0),
        L.tidy_upper(F.col("weather_condition")).alias("weather_condition"),
        "traffic_volume",
        "_ingestion_timestamp",
        "_source_id",
        "_batch_id",
    )


def stg_air_quality(bronze: DataFrame) -> DataFrame:
    """The silver columns; the staging form has no processing time."""
    return silver_air_quality(bronze)


def stg_stream_events(bronze: DataFrame) -> DataFrame:
    """The silver columns and the batch id, which is kept for tracing."""
    return silver_stream_events(bronze, "_batch_id")


# ---- the views of the catalog ---------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def _hour(ts: str) -> str:
    return f"date_trunc('hour', {ts})"


def _rounded(column: str, digits: int) -> str:
    """``functions.round_to`` in SQL."""
    scaled = f"(CAST({column} AS DOUBLE) * {10**digits}D)"
    whole = f"rint({scaled})"
    return (
        f"CASE WHEN {scaled} - {whole} = 0.5D AND {scaled} > 0 THEN {whole} + 1 "
        f"WHEN {scaled} - {whole} = -0.5D AND {scaled} < 0 THEN {whole} - 1 ELSE {whole} END / {10**digits}D AS {column}"
    )


def _traffic_sql(table: str) -> str:
    ts = "CAST(event_timestamp AS TIMESTAMP)"
    low, high = V.TRAFFIC_VOLUME_RANGE
    return f"""
    SELECT {ts} AS event_timestamp, {_hour(ts)} AS event_hour, to_date({ts}) AS event_date, hour({ts}) AS hour_of_day,
           dayofweek({ts}) - 1 AS day_of_week, coalesce(dayofweek({ts}) IN (1, 7), false) AS is_weekend,
           coalesce(holiday_name, {_text(V.NO_HOLIDAY)}) AS holiday_name,
           coalesce(temperature_kelvin - {V.KELVIN_OFFSET}D, {V.STAGING_TEMPERATURE_DEFAULT}D) AS temperature_celsius,
           coalesce(rainfall_mm, 0.0D) AS rainfall_mm, coalesce(snowfall_mm, 0.0D) AS snowfall_mm,
           coalesce(cloud_coverage_pct, 0) AS cloud_coverage_pct, upper(trim(weather_condition)) AS weather_condition,
           traffic_volume, _ingestion_timestamp, _source_id, _batch_id
    FROM {table} WHERE event_timestamp IS NOT NULL AND traffic_volume BETWEEN {low} AND {high}"""


def _air_quality_sql(table: str) -> str:
    ts = "CAST(measurement_timestamp AS TIMESTAMP)"
    zero = lambda *names: ", ".join(f"coalesce({n}, 0.0D) AS {n}" for n in names)
    return f"""
    SELECT upper(trim(city)) AS city, {ts} AS measurement_timestamp, {_hour(ts)} AS measurement_hour,
           to_date({ts}) AS measurement_date, {zero("pm25", "pm10", "aqi")},
           coalesce(aqi_category, {_text(V.UNKNOWN)}) AS aqi_category,
           {zero("ozone", "carbon_monoxide", "sulfur_dioxide", "nitrogen_dioxide")},
           coalesce(aqi > {V.HAZARDOUS_AQI}, false) AS is_hazardous, _ingestion_timestamp, _source_id
    FROM {table} WHERE city IS NOT NULL AND measurement_timestamp IS NOT NULL"""


def _stream_events_sql(table: str) -> str:
    ts = "CAST(event_timestamp AS TIMESTAMP)"
    cases = " ".join(
        f"WHEN {' OR '.join(f'event_type ILIKE {_text(f"%{w}%")}' for w in words)} THEN {_text(label)}"
        for label, words in V.EVENT_CATEGORIES
    )
    return f"""
    SELECT event_id, upper(trim(event_type)) AS event_type, sensor_id, location_id, {_rounded("latitude", 6)},
           {_rounded("longitude", 6)}, {ts} AS event_timestamp, date_trunc('minute', {ts}) AS event_minute,
           {_hour(ts)} AS event_hour, {_rounded("metric_value", 4)}, trim(metric_unit) AS metric_unit, kafka_topic,
           kafka_partition, kafka_offset, CASE {cases} ELSE {_text(V.EVENT_CATEGORY_OTHER)} END AS event_category,
           _ingestion_timestamp, _source_id, _batch_id
    FROM {table} WHERE event_id IS NOT NULL AND event_type IS NOT NULL"""


#: View -> the SQL over its source table.
VIEW_SQL = {"stg_traffic": _traffic_sql, "stg_air_quality": _air_quality_sql, "stg_stream_events": _stream_events_sql}
