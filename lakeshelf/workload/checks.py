"""Data quality checks over the test tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from lakeshelf.operators import quality
from lakeshelf.plans import gold, silver
from lakeshelf.workload import tables as t
from lakeshelf.workload.registry import query
from lakeshelf.workload.sql import with_ctes

# Quality queries look at the tables as of this moment.
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)

_KEPT = ["source_id", "check_type", "check_column", "passed", "failed_rows", "total_rows", "failure_rate"]


def checked(df: DataFrame, source_id: str, *checks: dict) -> DataFrame:
    return quality.report(df, checks, source_id, "check", AS_OF).select(*_KEPT)


def check_sql(source: str, table: str, kind: str, column: str, failed: str) -> str:
    return f"""SELECT '{source}' AS source_id, '{kind}' AS check_type, '{column}' AS check_column,
       failed = 0 AS passed, CAST(failed AS BIGINT) AS failed_rows, total AS total_rows,
       round(CAST(failed AS DOUBLE) / greatest(total, 1), 6) AS failure_rate
FROM (SELECT {failed} AS failed, count(*) AS total FROM {table})"""


def nulls(*columns: str) -> str:
    return " + ".join(f"(count(*) - count({c}))" for c in columns)


def off(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def unions(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


_NOT_NULL = unions(
    check_sql("traffic", "b_traffic", "not_null", "event_timestamp, traffic_volume",
              nulls("event_timestamp", "traffic_volume")),
    check_sql("traffic", "b_traffic", "not_null", "cloud_coverage_pct", nulls("cloud_coverage_pct")),
)


@query("dq_not_null", with_ctes(_NOT_NULL, "b_traffic"))
def dq_not_null(spark, sf_dir):
    return checked(
        t.bronze_traffic(spark, sf_dir), "traffic",
        {"check_type": "not_null", "columns": ["event_timestamp", "traffic_volume"]},
        {"check_type": "not_null", "column": "cloud_coverage_pct"},
    )


_UNIQUE = unions(
    check_sql("transit", "b_transit", "unique", "route_id", "count(*) - count(DISTINCT route_id)"),
    check_sql("transit", "b_transit", "unique", "route_name", "count(*) - count(DISTINCT route_name)"),
    check_sql("transit", "b_transit", "duplicate", "route_name, route_type_code",
              "count(*) - count(DISTINCT (route_name, route_type_code))"),
)


@query("dq_unique", with_ctes(_UNIQUE, "b_transit"))
def dq_unique(spark, sf_dir):
    return checked(
        t.bronze_transit(spark, sf_dir), "transit",
        {"check_type": "unique", "columns": ["route_id"]},
        {"check_type": "unique", "columns": ["route_name"]},
        {"type": "duplicate", "cols": ["route_name", "route_type_code"]},
    )


_RANGE = unions(
    check_sql("traffic", "b_traffic", "value_range", "traffic_volume",
              off("traffic_volume < 0 OR traffic_volume > 100000")),
    check_sql("traffic", "b_traffic", "value_range", "temperature_kelvin", off("temperature_kelvin < 260")),
    check_sql("traffic", "b_traffic", "value_range", "rainfall_mm", "0"),
)


@query("dq_value_range", with_ctes(_RANGE, "b_traffic"))
def dq_value_range(spark, sf_dir):
    return checked(
        t.bronze_traffic(spark, sf_dir), "traffic",
        {"check_type": "value_range", "column": "traffic_volume", "min": 0, "max": 100000},
        {"check_type": "value_range", "column": "temperature_kelvin", "min": 260},
        {"check_type": "value_range", "column": "rainfall_mm"},
    )


_VALUES = check_sql("air", "b_air", "accepted_values", "aqi_category",
                    off("aqi_category NOT IN ('Good', 'Satisfactory', 'Moderate', 'Poor', 'Very Poor')"))


@query("dq_accepted_values", with_ctes(_VALUES, "b_air"))
def dq_accepted_values(spark, sf_dir):
    return checked(
        t.bronze_air_quality(spark, sf_dir), "air",
        {"check_type": "accepted_values", "column": "aqi_category",
         "values": ["Good", "Satisfactory", "Moderate", "Poor", "Very Poor"]},
    )


def _stale(column: str, hours: int) -> str:
    return f"CASE WHEN max({column}) >= TIMESTAMP '2024-01-31' - INTERVAL {hours} HOUR THEN 0 ELSE 1 END"


_FRESH = unions(
    check_sql("traffic", "b_traffic", "freshness", "event_timestamp", _stale("event_timestamp", 48)),
    check_sql("traffic", "b_traffic", "freshness", "event_timestamp", _stale("event_timestamp", 1)),
    check_sql("weather", "b_weather", "freshness", "observation_timestamp",
              _stale("make_timestamp(observation_timestamp * 1000000)", 24)),
)


@query("dq_freshness", with_ctes(_FRESH, "b_traffic", "b_weather"))
def dq_freshness(spark, sf_dir):
    traffic = checked(
        t.bronze_traffic(spark, sf_dir), "traffic",
        {"check_type": "freshness", "column": "event_timestamp", "max_age_hours": 48},
        {"check_type": "freshness", "column": "event_timestamp", "max_age_hours": 1},
    )
    weather = checked(
        t.bronze_weather(spark, sf_dir), "weather", {"check_type": "freshness", "column": "observation_timestamp"}
    )
    return traffic.unionByName(weather)


_COUNT = unions(
    check_sql("traffic", "b_traffic", "row_count", "", "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END"),
    check_sql("traffic", "b_traffic", "row_count", "",
              "CASE WHEN count(*) BETWEEN 100 AND 5000 THEN 0 ELSE 1 END"),
)


@query("dq_row_count", with_ctes(_COUNT, "b_traffic"))
def dq_row_count(spark, sf_dir):
    return checked(
        t.bronze_traffic(spark, sf_dir), "traffic",
        {"check_type": "row_count", "min_rows": 1},
        {"check_type": "row_count", "min_rows": 100, "max_rows": 5000},
    )


# The standing suite and the declared model tests, over the frames of the test tables.


def _suite(spark, sf_dir):
    bronze_traffic = t.bronze_traffic(spark, sf_dir)
    silver_traffic = silver.silver_traffic(bronze_traffic)
    frames = {
        "urban_traffic": bronze_traffic,
        "air_quality": t.bronze_air_quality(spark, sf_dir),
        "silver_traffic": silver_traffic,
        "fact_traffic_hourly": gold.fact_traffic_hourly(silver_traffic),
    }
    standing = [(name, frames[name], checks) for name, _, checks in quality.STANDING_SUITE]
    events = ("events", t.bronze_events(spark, sf_dir), quality.model_checks("bronze_urban_stream_events"))
    return quality.report_all([*standing, events], "check", AS_OF)


_LEVELS = "'Low', 'Medium', 'High', 'Very High'"
_REPORT = unions(
    *[check_sql("urban_traffic", "b_traffic", "not_null", c, nulls(c)) for c in ("traffic_volume", "event_timestamp")],
    check_sql("urban_traffic", "b_traffic", "value_range", "traffic_volume",
              off("traffic_volume < 0 OR traffic_volume > 100000")),
    check_sql("urban_traffic", "b_traffic", "duplicate", "event_timestamp",
              "count(*) - count(DISTINCT event_timestamp)"),
    *[check_sql("air_quality", "b_air", "not_null", c, nulls(c)) for c in ("city", "measurement_timestamp")],
    check_sql("air_quality", "b_air", "value_range", "aqi", off("aqi < 0 OR aqi > 1000")),
    *[check_sql("silver_traffic", "s_traffic", "not_null", c, nulls(c)) for c in ("traffic_volume", "event_timestamp")],
    check_sql("silver_traffic", "s_traffic", "accepted_values", "traffic_level", off(f"traffic_level NOT IN ({_LEVELS})")),
    check_sql("fact_traffic_hourly", "g_traffic", "not_null", "hour_key", nulls("hour_key")),
    check_sql("fact_traffic_hourly", "g_traffic", "value_range", "avg_traffic_volume",
              off("avg_traffic_volume < 0 OR avg_traffic_volume > 100000")),
    check_sql("fact_traffic_hourly", "g_traffic", "row_count", "", "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END"),
    *[check_sql("events", "b_events", "not_null", c, nulls(c)) for c in ("event_id", "event_type", "event_timestamp")],
    check_sql("events", "b_events", "unique", "event_id", "count(*) - count(DISTINCT event_id)"),
)
_REPORT_CTES = ("b_traffic", "b_air", "s_traffic", "g_traffic", "b_events")


@query("dq_report", with_ctes(_REPORT, *_REPORT_CTES))
def dq_report(spark, sf_dir):
    return _suite(spark, sf_dir).select(*_KEPT)


@query("dq_pass_rate", with_ctes(f"""
SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed,
       count(*) FILTER (WHERE NOT passed) AS failed,
       CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) AS pass_rate, bool_and(passed) AS overall_pass
FROM ({_REPORT})""", *_REPORT_CTES))
def dq_pass_rate(spark, sf_dir):
    return quality.pass_rate(_suite(spark, sf_dir))
