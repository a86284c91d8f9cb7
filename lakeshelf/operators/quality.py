"""Data quality checks, compiled into as few aggregates as possible.

All checks of a table that need only row-wise counts share one aggregate and so one
scan. Each uniqueness check is an aggregate of its own: sharing would make Spark copy
every row once per check, while alone it scans only the key columns and combines equal
keys before the shuffle.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeshelf.functions import number_of, round_to
from lakeshelf.operators.aggregates import count_distinct_tuple
from lakeshelf.operators.filters import recent
from lakeshelf.operators.mapping import _quoted

log = logging.getLogger(__name__)

# The check names a suite may use; two of them mean the same.
CHECK_TYPES = ("not_null", "unique", "duplicate", "value_range", "accepted_values", "freshness", "row_count")
RATE_DIGITS = 6
DEFAULT_MAX_AGE_HOURS = 24


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    values: tuple[Any, ...] = ()
    max_age_hours: int = DEFAULT_MAX_AGE_HOURS
    min_rows: int = 1
    max_rows: int | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Check:
        one = raw.get("column") or raw.get("col")
        many = raw.get("columns") or raw.get("cols") or ([one] if one else [])
        return cls(
            kind=raw.get("check_type") or raw.get("type") or "",
            columns=tuple(many),
            low=raw.get("min"),
            high=raw.get("max"),
            values=tuple(raw.get("values") or ()),
            max_age_hours=raw.get("max_age_hours", DEFAULT_MAX_AGE_HOURS),
            min_rows=raw.get("min_rows", 1),
            max_rows=raw.get("max_rows"),
        )

    @property
    def is_unique(self) -> bool:
        return self.kind in ("unique", "duplicate")

    @property
    def label(self) -> str:
        return ", ".join(self.columns)

    def problem(self, df: DataFrame) -> str | None:
        """Why this check cannot run on ``df``, decided from the schema alone."""
        absent = [c for c in self.columns if c not in df.columns]
        if absent:
            return f"no column {', '.join(absent)}"
        if self.kind != "row_count" and not self.columns:
            return "no column named"
        return None

    def failures(self, df: DataFrame, now: datetime) -> Column:
        """Number of failed rows, as an aggregate."""
        cols = [F.col(_quoted(c)) for c in self.columns]
        if self.kind == "not_null":
            return reduce(lambda a, b: a + b, [F.count_if(c.isNull()) for c in cols])
        if self.is_unique:
            return F.count(F.lit(1)) - count_distinct_tuple(*[_quoted(c) for c in self.columns])
        if self.kind == "value_range":
            number = number_of(cols[0], df.schema[self.columns[0]].dataType)
            outside = F.lit(False)
            if self.low is not None:
                outside = outside | (number < F.lit(float(self.low)))
            if self.high is not None:
                outside = outside | (number > F.lit(float(self.high)))
            return F.count_if(outside)
        if self.kind == "accepted_values":
            kind = df.schema[self.columns[0]].dataType
            if isinstance(kind, T.StringType):
                return F.count_if(~cols[0].isin([str(v) for v in self.values]))
            # in the type of the column: 1 is 1.0, and True is not the text 'True'; what can't be one of its values is left out
            whole = isinstance(kind, T.IntegralType)
            fitting = [v for v in self.values if v is not None and not (whole and isinstance(v, float) and v % 1)]
            listed = [F.lit(v).try_cast(kind) for v in fitting]
            if not listed:
                return F.count(cols[0])
            accepted = F.array_contains(F.array_compact(F.array(*listed)), cols[0])
            return F.count_if(cols[0].isNotNull() & ~accepted)
        if self.kind == "freshness":
            # any recent row passes, so the newest one decides
            newest = F.max(_moment(cols[0], df.schema[self.columns[0]].dataType))
            fresh = recent(newest, F.lit(now).cast("timestamp"), hours=self.max_age_hours)
            return F.when(fresh, F.lit(0)).otherwise(F.lit(1)).cast("bigint")
        rows = F.count(F.lit(1))
        enough = rows >= F.lit(self.min_rows)
        if self.max_rows is not None:
            enough = enough & (rows <= F.lit(self.max_rows))
        return F.when(enough, F.lit(0)).otherwise(F.lit(1)).cast("bigint")


def _moment(c: Column, kind: T.DataType) -> Column:
    """Any time column as a timestamp; whole numbers are epoch seconds."""
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.timestamp_seconds(c)
    return c.try_cast("timestamp") if isinstance(kind, T.StringType) else c.cast("timestamp")


_DETAIL = {
    "not_null": "null values in",
    "unique": "repeated rows on",
    "duplicate": "repeated rows on",
    "value_range": "values outside {low}..{high} in",
    "accepted_values": "values off the list in",
    "freshness": "missed: newest row within {max_age_hours} hours by",
    "row_count": "missed: row count between {min_rows} and {max_rows}",
}


def _result(check: Check, total: Column, failed: Column) -> Column:
    text = _DETAIL[check.kind].format(**vars(check))
    return F.struct(
        F.lit(check.kind).alias("check_type"),
        F.lit(check.label).alias("check_column"),
        (failed == 0).alias("passed"),
        failed.cast("bigint").alias("failed_rows"),
        total.alias("total_rows"),
        round_to(failed / F.greatest(total, F.lit(1)), RATE_DIGITS).alias("failure_rate"),
        F.concat_ws(" ", failed.cast("string"), F.lit(text), F.lit(check.label)).alias("details"),
    )


def _rows(df: DataFrame, checks: Sequence[Check], now: datetime) -> DataFrame:
    """One aggregate over ``df``, unpivoted to one row per check."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[c.failures(df, now).alias(f"f{i}") for i, c in enumerate(checks)],
    )
    results = [_result(c, F.col("total"), F.col(f"f{i}")) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*results)))


def _unrunnable(df: DataFrame, broken: Sequence[tuple[Check, str]]) -> DataFrame:
    rows = [(c.kind, c.label, False, None, None, None, f"error: {why}") for c, why in broken]
    return df.sparkSession.createDataFrame(
        rows,
        "check_type string, check_column string, passed boolean, failed_rows bigint, total_rows bigint, "
        "failure_rate double, details string",
    )


def report(
    df: DataFrame,
    checks: Sequence[Check | Mapping[str, Any]],
    source_id: str = "",
    run_id: str | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """One row per check, in the columns of the quality audit.

    Unknown check names are logged and left out; a check that names an absent column is
    kept as not passed, with the reason in ``details``.
    """
    now = now or datetime.now(timezone.utc)
    run_id = run_id or str(uuid.uuid4())
    parsed = [c if isinstance(c, Check) else Check.from_dict(c) for c in checks]
    known = [c for c in parsed if c.kind in CHECK_TYPES]
    for c in parsed:
        if c.kind not in CHECK_TYPES:
            log.warning("unknown check %r on %s", c.kind, source_id)
    broken = [(c, why) for c in known if (why := c.problem(df))]
    usable = [c for c in known if not c.problem(df)]
    parts = []
    if plain := [c for c in usable if not c.is_unique]:
        parts.append(_rows(df, plain, now))
    parts += [_rows(df, [c], now) for c in usable if c.is_unique]
    if broken or not parts:
        parts.append(_unrunnable(df, broken))
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(run_id).alias("run_id"),
        F.lit(source_id).alias("source_id"),
        "check_type", "check_column", "passed", "failed_rows", "total_rows", "failure_rate", "details",
        F.lit(now).cast("timestamp").alias("checked_at"),
    )


def report_all(
    suite: Sequence[tuple[str, DataFrame | None, Sequence[Check | Mapping[str, Any]]]],
    run_id: str | None = None,
    now: datetime | None = None,
) -> DataFrame | None:
    """Reports of several tables in one frame; tables given as None are skipped."""
    run_id = run_id or str(uuid.uuid4())
    now = now or datetime.now(timezone.utc)
    parts = [report(df, checks, name, run_id, now) for name, df, checks in suite if df is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def pass_rate(results: DataFrame) -> DataFrame:
    """One row over a report: checks, passed, failed, pass rate and the overall verdict.
    The verdict informs; stopping on it is up to the caller."""
    ok = F.col("passed")
    total = F.count(F.lit(1))
    return results.agg(
        total.alias("total_checks"),
        F.count_if(ok).alias("passed"),
        F.count_if(~ok).alias("failed"),
        (F.count_if(ok) / F.greatest(total, F.lit(1))).alias("pass_rate"),
        F.coalesce(F.every(ok), F.lit(True)).alias("overall_pass"),
    )


# ---- the standing suites --------------------------------------------------

# Source name, table and checks of the standing suite.
STANDING_SUITE: list[tuple[str, str, list[dict[str, Any]]]] = [
    ("urban_traffic", "bronze.bronze_urban_traffic", [
        {"type": "not_null", "col": "traffic_volume"},
        {"type": "not_null", "col": "event_timestamp"},
        {"type": "value_range", "col": "traffic_volume", "min": 0, "max": 100000},
        {"type": "duplicate", "cols": ["event_timestamp"]},
    ]),
    ("air_quality", "bronze.bronze_air_quality", [
        {"type": "not_null", "col": "city"},
        {"type": "not_null", "col": "measurement_timestamp"},
        {"type": "value_range", "col": "aqi", "min": 0, "max": 1000},
    ]),
    ("silver_traffic", "silver.silver_traffic", [
        {"type": "not_null", "col": "traffic_volume"},
        {"type": "not_null", "col": "event_timestamp"},
        {"type": "accepted_values", "col": "traffic_level", "values": ["Low", "Medium", "High", "Very High"]},
    ]),
    ("fact_traffic_hourly", "gold.fact_traffic_hourly", [
        {"type": "not_null", "col": "hour_key"},
        {"type": "value_range", "col": "avg_traffic_volume", "min": 0, "max": 100000},
        {"type": "row_count", "min_rows": 1},
    ]),
]

# The column tests declared for the models and the bronze sources.
# Each line: table, column, tests.
MODEL_TESTS: list[tuple[str, str, list[dict[str, Any]]]] = [
    ("fact_traffic_hourly", "hour_key", [{"type": "not_null"}, {"type": "unique"}]),
    ("fact_traffic_hourly", "avg_traffic_volume", [{"type": "not_null"}, {"type": "value_range", "min": 0, "max": 100000}]),
    ("fact_traffic_hourly", "traffic_level",
     [{"type": "accepted_values", "values": ["Low", "Medium", "High", "Very High"]}]),
    ("fact_air_quality_daily", "city", [{"type": "not_null"}]),
    ("fact_air_quality_daily", "date_key", [{"type": "not_null"}]),
    ("fact_air_quality_daily", "avg_aqi", [{"type": "value_range", "min": 0, "max": 1000}]),
    ("dim_date", "date_key", [{"type": "not_null"}, {"type": "unique"}]),
    ("dim_date", "year", [{"type": "not_null"}]),
    ("dim_date", "season", [{"type": "accepted_values", "values": ["Winter", "Spring", "Summer", "Autumn"]}]),
    ("bronze_urban_traffic", "event_timestamp", [{"type": "not_null"}]),
    ("bronze_urban_traffic", "traffic_volume", [{"type": "not_null"}, {"type": "value_range", "min": 0, "max": 100000}]),
    ("bronze_air_quality", "city", [{"type": "not_null"}]),
    ("bronze_air_quality", "measurement_timestamp", [{"type": "not_null"}]),
    ("bronze_air_quality", "aqi", [{"type": "value_range", "min": 0, "max": 1000}]),
    ("bronze_weather_api", "city_name", [{"type": "not_null"}]),
    ("bronze_weather_api", "observation_timestamp", [{"type": "not_null"}]),
    ("bronze_urban_stream_events", "event_id", [{"type": "not_null"}, {"type": "unique"}]),
    ("bronze_urban_stream_events", "event_type", [{"type": "not_null"}]),
    ("bronze_urban_stream_events", "event_timestamp", [{"type": "not_null"}]),
    ("bronze_city_demographics", "city_name", [{"type": "not_null"}]),
]


def model_suite(frame_of: Callable[[str], DataFrame | None]) -> list[tuple[str, DataFrame | None, list[dict[str, Any]]]]:
    """The declared column tests of every table, as a suite for ``report_all``."""
    return [(name, frame_of(name), model_checks(name)) for name in dict.fromkeys(table for table, _, _ in MODEL_TESTS)]


def model_checks(table: str) -> list[dict[str, Any]]:
    """The declared column tests of one table."""
    return [{**test, "col": column} for name, column, tests in MODEL_TESTS if name == table for test in tests]
