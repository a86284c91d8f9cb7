"""Building the layers as tables: bronze to silver, silver to gold, and the models.

Each step says ``skipped`` when its input is missing. Steps of one layer do not depend
on each other; the summaries come after the facts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from lakeshelf.operators import audit, incremental, quality
from lakeshelf.operators.tables import Lake
from lakeshelf.plans import dims, gold, silver, staging

# Table names of the layers.
BRONZE_TRAFFIC = "bronze.bronze_urban_traffic"
BRONZE_AIR = "bronze.bronze_air_quality"
BRONZE_WEATHER = "bronze.bronze_weather_api"
BRONZE_EVENTS = "bronze.bronze_urban_stream_events"
BRONZE_DEMOGRAPHICS = "bronze.bronze_city_demographics"
SILVER_TRAFFIC = "silver.silver_traffic"
SILVER_AIR = "silver.silver_air_quality"
SILVER_WEATHER = "silver.silver_weather"
SILVER_EVENTS = "silver.silver_stream_events"
SILVER_DEMOGRAPHICS = "silver.silver_demographics"
FACT_TRAFFIC = "gold.fact_traffic_hourly"
FACT_AIR = "gold.fact_air_quality_daily"
FACT_EVENTS = "gold.fact_stream_events_hourly"
FACT_TRAFFIC_MODEL = "gold.fact_traffic_hourly_model"
FACT_AIR_MODEL = "gold.fact_air_quality_daily_model"
DIM_DATE = "gold.dim_date"
DAILY_TWO_WAY = "gold.urban_daily_two_way"
DAILY_SUMMARY = "gold.agg_urban_daily"


@dataclass(frozen=True)
class Step:
    """One table made from one other table."""

    source: str
    target: str
    transform: Callable[[DataFrame], DataFrame]
    # the day a row belongs to: column of the target, and the raw time it comes from
    day: str | None = None
    raw_time: str | None = None
    # the target is partitioned by this column; a day itself, or the month it lies in
    partition_by: str | None = None


@dataclass(frozen=True)
class StepResult:
    target: str
    status: str
    rows: int = 0


def _events_with_day(bronze: DataFrame) -> DataFrame:
    """The events table also keeps the day, to be partitioned by it."""
    return silver.silver_stream_events(bronze).withColumn("event_date", F.to_date("event_timestamp"))


SILVER_STEPS = (
    Step(BRONZE_TRAFFIC, SILVER_TRAFFIC, silver.silver_traffic, "event_date", "event_timestamp", "event_date"),
    Step(BRONZE_AIR, SILVER_AIR, silver.silver_air_quality, "measurement_date",
         "measurement_timestamp", "measurement_date"),
    Step(BRONZE_WEATHER, SILVER_WEATHER, silver.silver_weather),
    Step(BRONZE_EVENTS, SILVER_EVENTS, _events_with_day, "event_date", "event_timestamp", "event_date"),
    Step(BRONZE_DEMOGRAPHICS, SILVER_DEMOGRAPHICS, silver.silver_demographics),
)


def _traffic_fact(traffic: DataFrame) -> DataFrame:
    return incremental.with_month(gold.fact_traffic_hourly(traffic))


def _air_fact(air: DataFrame) -> DataFrame:
    return incremental.with_month(gold.fact_air_quality_daily(air))


def _events_fact(events: DataFrame) -> DataFrame:
    by_hour = gold.fact_stream_events_hourly(events)
    return incremental.with_month(by_hour.withColumn("date_key", F.to_date("hour_key")))


def _traffic_model(traffic: DataFrame) -> DataFrame:
    return incremental.with_month(gold.fact_traffic_hourly_model(traffic))


def _air_model(air: DataFrame) -> DataFrame:
    return incremental.with_month(gold.fact_air_quality_daily_model(air))


GOLD_STEPS = (
    Step(SILVER_TRAFFIC, FACT_TRAFFIC, _traffic_fact, "date_key", "event_timestamp", "month_key"),
    Step(SILVER_AIR, FACT_AIR, _air_fact, "date_key", "measurement_timestamp", "month_key"),
    Step(SILVER_EVENTS, FACT_EVENTS, _events_fact, "date_key", "event_timestamp", "month_key"),
)


def run_step(lake: Lake, step: Step, stamp_name: str, since: date | None = None) -> StepResult:
    """Build one table: wholly, or only the days from ``since`` on.

    A partial build reads the source from that day and replaces exactly those days;
    tables without a day are always built wholly.
    """
    if not lake.exists(step.source):
        return StepResult(step.target, audit.SKIPPED)
    source = lake.read(step.source)
    partial = since is not None and step.day is not None and lake.exists(step.target)
    if not partial:
        result = silver.stamp(step.transform(source), stamp_name)
        parts = [step.partition_by] if step.partition_by else []
        return StepResult(step.target, audit.SUCCESS, lake.overwrite(result, step.target, parts))
    recent = source.where(F.col(step.raw_time) >= F.lit(since))
    result = silver.stamp(step.transform(recent), stamp_name)
    by_day = step.partition_by == step.day
    rows = incremental.replace_days(
        lake, step.target, result, since, step.day, step.partition_by,
        (lambda d: d) if by_day else incremental.month_start,
    )
    return StepResult(step.target, audit.SUCCESS, rows)


def build_silver(lake: Lake, since: date | None = None) -> list[StepResult]:
    return [run_step(lake, s, "silver_processed_at", since) for s in SILVER_STEPS]


def _summary(lake: Lake, target: str, needs: Sequence[str], build: Callable[[], DataFrame]) -> StepResult:
    if not all(lake.exists(n) for n in needs):
        return StepResult(target, audit.SKIPPED)
    daily = silver.stamp(build(), "gold_processed_at").orderBy("date_key")  # a row a day, stored in order
    return StepResult(target, audit.SUCCESS, lake.overwrite(daily, target))


def build_dates(lake: Lake) -> StepResult:
    return StepResult(DIM_DATE, audit.SUCCESS, lake.overwrite(dims.dim_date(lake.spark), DIM_DATE))


def build_gold(lake: Lake, since: date | None = None) -> list[StepResult]:
    """Facts from silver, the date dimension and the two-way daily summary."""
    results = [build_dates(lake)]
    results += [run_step(lake, s, "gold_processed_at", since) for s in GOLD_STEPS]
    results.append(_summary(
        lake, DAILY_TWO_WAY, [FACT_TRAFFIC, FACT_EVENTS],
        lambda: gold.urban_daily_two_way(lake.read(FACT_TRAFFIC), lake.read(FACT_EVENTS)),
    ))
    return results


# Source table -> the view over it, in the staging database.
STAGING_VIEWS = (
    (BRONZE_TRAFFIC, "stg_traffic"), (BRONZE_AIR, "stg_air_quality"), (BRONZE_EVENTS, "stg_stream_events"),
)


def create_staging_views(lake: Lake) -> list[str]:
    """The staging models as views of the catalog, in the staging database, which every session
    can read; returns the ones whose source exists."""
    made = []
    for source, name in STAGING_VIEWS:
        if lake.exists(source):
            lake.create_sql_view(f"staging.{name}", staging.VIEW_SQL[name](lake.table(source)))
            made.append(name)
    return made


# How late rows touch the model facts: hours of the traffic, days of the air readings.
MODEL_GROUPS = {
    "stg_traffic": (FACT_TRAFFIC_MODEL, _traffic_model, incremental.Groups(
        "event_hour", "hour_key", "month_key", lambda hour: F.trunc(hour, "month"), time_column="event_timestamp")),
    "stg_air_quality": (FACT_AIR_MODEL, _air_model, incremental.Groups(
        "measurement_date", "date_key", "month_key", lambda day: F.trunc(day, "month"),
        time_column="measurement_timestamp", group_span=timedelta(days=1))),
}


def build_models(lake: Lake, lookback_days: int | None = None, late_rows: bool = False) -> list[StepResult]:
    """Staging views, incremental model facts, the date dimension, the daily summary.

    With ``late_rows`` the groups that rows arrived for since the last such run are recomputed, however old they are;
    otherwise see ``incremental.load``.
    """
    views = create_staging_views(lake)
    results = [build_dates(lake)]
    if late_rows:
        for view, (target, build, groups) in MODEL_GROUPS.items():
            if view in views:
                count = incremental.refresh_groups(lake, target, lake.read(f"staging.{view}"), build, groups)
                results.append(StepResult(target, audit.SUCCESS, count))
        views = []
    if "stg_traffic" in views:
        rows = incremental.load(
            lake, FACT_TRAFFIC_MODEL, lake.read("staging.stg_traffic"), _traffic_model,
            "event_hour", "hour_key", "date_key", "month_key", lookback_days, "event_timestamp",
        )
        results.append(StepResult(FACT_TRAFFIC_MODEL, audit.SUCCESS, rows))
    if "stg_air_quality" in views:
        rows = incremental.load(
            lake, FACT_AIR_MODEL, lake.read("staging.stg_air_quality"), _air_model,
            "measurement_date", "date_key", "date_key", "month_key", lookback_days, "measurement_timestamp",
        )
        results.append(StepResult(FACT_AIR_MODEL, audit.SUCCESS, rows))
    results.append(_summary(
        lake, DAILY_SUMMARY, [FACT_TRAFFIC_MODEL, FACT_AIR_MODEL, FACT_EVENTS, DIM_DATE],
        lambda: gold.agg_urban_daily(
            lake.read(FACT_TRAFFIC_MODEL), lake.read(FACT_AIR_MODEL), lake.read(FACT_EVENTS), lake.read(DIM_DATE)
        ),
    ))
    return results


# The models are stored under names of their own beside the layer facts.
MODEL_TABLES = {
    "fact_traffic_hourly": FACT_TRAFFIC_MODEL, "fact_air_quality_daily": FACT_AIR_MODEL, "dim_date": DIM_DATE,
}


def run_quality(lake: Lake) -> DataFrame | None:
    """Run the standing suite and the declared column tests over the tables that exist, and
    append the results to the audit."""

    def frame(table: str) -> DataFrame | None:
        return lake.read(table) if lake.exists(table) else None

    suite = [(name, frame(table), checks) for name, table, checks in quality.STANDING_SUITE]
    suite += quality.model_suite(lambda name: frame(MODEL_TABLES.get(name, f"bronze.{name}")))
    results = quality.report_all(suite)
    if results is not None:
        audit.record_checks(lake, results)
    return results
