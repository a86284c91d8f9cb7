"""Silver, staging, facts, date dimension and daily summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeshelf.plans import dims, gold, silver, staging
from lakeshelf.workload import tables as t
from lakeshelf.workload.registry import query
from lakeshelf.workload.sql import with_ctes


def _select_all(cte: str) -> str:
    return with_ctes(f"SELECT * FROM {cte}", cte)


def rounded(df: DataFrame, *names: str, digits: int = 8) -> DataFrame:
    """Means that the layer leaves unrounded are compared at eight digits."""
    return df.withColumns({n: F.round(n, digits) for n in names})


def _rounded_sql(cte: str, *names: str) -> str:
    parts = ", ".join(f"round({n}, 8) AS {n}" for n in names)
    return with_ctes(f"SELECT * REPLACE ({parts}) FROM {cte}", cte)


# ---- silver and staging ---------------------------------------------------

SHAPES = {
    "silver_traffic": (t.bronze_traffic, silver.silver_traffic, "s_traffic"),
    "silver_air_quality": (t.bronze_air_quality, silver.silver_air_quality, "s_air"),
    "silver_weather": (t.bronze_weather, silver.silver_weather, "s_weather"),
    "silver_stream_events": (t.bronze_events, silver.silver_stream_events, "s_events"),
    "silver_demographics": (t.bronze_demographics, silver.silver_demographics, "s_demographics"),
    "stg_traffic": (t.bronze_traffic, staging.stg_traffic, "st_traffic"),
    "stg_air_quality": (t.bronze_air_quality, staging.stg_air_quality, "s_air"),
    "stg_stream_events": (t.bronze_events, staging.stg_stream_events, "st_events"),
}


def _register_shape(name: str) -> None:
    bronze, transform, cte = SHAPES[name]

    @query(name, _select_all(cte))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return t.as_ntz(transform(bronze(spark, sf_dir)))


for _name in SHAPES:
    _register_shape(_name)


# ---- facts ----------------------------------------------------------------


def traffic_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_traffic_hourly_model(staging.stg_traffic(t.bronze_traffic(spark, sf_dir)))


def air_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_air_quality_daily_model(staging.stg_air_quality(t.bronze_air_quality(spark, sf_dir)))


def events_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_stream_events_hourly(silver.silver_stream_events(t.bronze_events(spark, sf_dir)))


@query("fact_traffic_hourly", _rounded_sql("g_traffic", "traffic_stddev"))
def fact_traffic_hourly(spark, sf_dir):
    fact = gold.fact_traffic_hourly(silver.silver_traffic(t.bronze_traffic(spark, sf_dir)))
    return t.as_ntz(rounded(fact, "traffic_stddev"))


@query("fact_traffic_hourly_model", _select_all("g_traffic_model"))
def fact_traffic_hourly_model(spark, sf_dir):
    return t.as_ntz(traffic_model(spark, sf_dir))


_AIR_MEANS = ("avg_aqi", "avg_pm25", "avg_pm10", "avg_ozone", "avg_co")


@query("fact_air_quality_daily", _rounded_sql("g_air", *_AIR_MEANS))
def fact_air_quality_daily(spark, sf_dir):
    fact = gold.fact_air_quality_daily(silver.silver_air_quality(t.bronze_air_quality(spark, sf_dir)))
    return rounded(fact, *_AIR_MEANS)


@query("fact_air_quality_daily_model", _select_all("g_air_model"))
def fact_air_quality_daily_model(spark, sf_dir):
    return air_model(spark, sf_dir)


@query("fact_stream_events_hourly", _rounded_sql("g_events", "avg_metric_value"))
def fact_stream_events_hourly(spark, sf_dir):
    return t.as_ntz(rounded(events_fact(spark, sf_dir), "avg_metric_value"))


# ---- date dimension, next to what the tables hold for each day ------------


def _daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date_key")).agg(
        F.count(F.lit(1)).alias("n_events")
    )
    orders = t.table(spark, sf_dir, "orders").groupBy(t.shifted_day("o_orderdate").alias("date_key")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return events.join(orders, "date_key", "full_outer")


_DAILY_ROWS_SQL = """
LEFT JOIN (SELECT CAST(ts AS DATE) AS dk, count(*) AS n FROM events GROUP BY CAST(ts AS DATE)) e ON e.dk = date_key
LEFT JOIN (SELECT CAST(o_orderdate + INTERVAL 10592 DAY AS DATE) AS dk, count(*) AS n
           FROM orders GROUP BY CAST(o_orderdate + INTERVAL 10592 DAY AS DATE)) o ON o.dk = date_key"""


def _with_rows(dates: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = {n: F.coalesce(n, F.lit(0)) for n in ("n_events", "n_orders")}
    return dates.join(_daily_rows(spark, sf_dir), "date_key", "left").withColumns(filled)


@query("dim_date", with_ctes(f"""
SELECT date_key, year, month_num AS month, day_num AS day, day_of_week, day_of_year, week_of_year, quarter,
       day_name, month_name, is_weekend, season, ifnull(e.n, 0) AS n_events, ifnull(o.n, 0) AS n_orders
FROM days {_DAILY_ROWS_SQL}""", "days"))
def dim_date(spark, sf_dir):
    return _with_rows(dims.dim_date_short(spark), spark, sf_dir)


@query("dim_date_model", with_ctes(f"""
SELECT days.*, ifnull(e.n, 0) AS n_events, ifnull(o.n, 0) AS n_orders
FROM days {_DAILY_ROWS_SQL}""", "days"))
def dim_date_model(spark, sf_dir):
    return _with_rows(dims.dim_date(spark), spark, sf_dir)


# ---- daily summaries ------------------------------------------------------


@query("urban_daily_two_way", with_ctes("""
SELECT date_key, round(ifnull(avg_daily_traffic, 0), 8) AS avg_daily_traffic,
       ifnull(total_daily_traffic, 0) AS total_daily_traffic,
       ifnull(total_stream_events, 0) AS total_stream_events, ifnull(sensors, 0) AS total_sensors_active
FROM (SELECT date_key, avg(avg_traffic_volume) AS avg_daily_traffic,
             CAST(sum(total_traffic_volume) AS BIGINT) AS total_daily_traffic
      FROM g_traffic GROUP BY date_key)
FULL JOIN e_daily USING (date_key)
WHERE date_key IS NOT NULL""", "g_traffic", "e_daily"))
def urban_daily_two_way(spark, sf_dir):
    traffic = gold.fact_traffic_hourly(silver.silver_traffic(t.bronze_traffic(spark, sf_dir)))
    return rounded(gold.urban_daily_two_way(traffic, events_fact(spark, sf_dir)), "avg_daily_traffic")


@query("agg_urban_daily", with_ctes("""
SELECT date_key, day_name, is_weekend, season, month_name,
       round(ifnull(avg_daily_traffic, 0), 8) AS avg_daily_traffic,
       ifnull(total_daily_traffic, 0) AS total_daily_traffic,
       ifnull(peak_traffic_volume, 0) AS peak_traffic_volume, ifnull(traffic_level, 'Unknown') AS traffic_level,
       ifnull(traffic_hours_measured, 0) AS traffic_hours_measured,
       round(ifnull(avg_daily_aqi, 0), 8) AS avg_daily_aqi, ifnull(peak_aqi, 0) AS peak_aqi,
       ifnull(total_hazardous_hours, 0) AS total_hazardous_hours, ifnull(cities_measured, 0) AS cities_measured,
       ifnull(total_stream_events, 0) AS total_stream_events, ifnull(sensors, 0) AS sensors_active,
       round(greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE),
             100 - ifnull(avg_daily_aqi, 0) / 10 + if(is_weekend, 5, 0))), 1) AS urban_health_score
FROM t_daily FULL JOIN a_daily USING (date_key) FULL JOIN e_daily USING (date_key)
LEFT JOIN days USING (date_key)
WHERE date_key IS NOT NULL
ORDER BY date_key""", "t_daily", "a_daily", "e_daily", "days"))
def agg_urban_daily(spark, sf_dir):
    daily = gold.agg_urban_daily(
        traffic_model(spark, sf_dir), air_model(spark, sf_dir), events_fact(spark, sf_dir), dims.dim_date(spark)
    )
    return rounded(daily, "avg_daily_traffic", "avg_daily_aqi").orderBy("date_key")


@query("exact_daily_sensors", with_ctes("""
SELECT CAST(event_hour AS DATE) AS date_key, count(DISTINCT sensor_id) AS distinct_sensors
FROM s_events GROUP BY CAST(event_hour AS DATE)""", "s_events"))
def exact_daily_sensors(spark, sf_dir):
    return gold.exact_daily_sensors(silver.silver_stream_events(t.bronze_events(spark, sf_dir)))
