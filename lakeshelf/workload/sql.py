"""Building blocks of the SQL twins: the bronze, silver and gold layers as CTEs.

The twins are written for the check engine only. ``with_ctes`` puts the blocks a query
needs, and the blocks those need, in front of it.
"""

from __future__ import annotations

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTE[name] = (needs, body.strip())


def with_ctes(body: str, *names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTE[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTE[n][1]}\n)" for n in ordered) + "\n" + body.strip()


def audit(source: str, ts: str) -> str:
    return f"{ts} AS _ingestion_timestamp, '{source}' AS _source_id, '{source}_1' AS _batch_id"


# ---- bronze ---------------------------------------------------------------

_cte("b_traffic", (), f"""
SELECT ts AS event_timestamp,
       CASE WHEN event_id % 33 = 0 THEN 'Holiday' END AS holiday_name,
       CASE WHEN hour(ts) <> 3 THEN CAST(250 + 2 * hour(ts) AS DOUBLE) END AS temperature_kelvin,
       CASE WHEN event_type = 'error' THEN CAST(event_id % 40 AS DOUBLE) / 8 END AS rainfall_mm,
       CASE WHEN event_type = 'signup' THEN CAST(event_id % 24 AS DOUBLE) / 8 END AS snowfall_mm,
       CASE WHEN event_id % 7 <> 0 THEN user_id % 101 END AS cloud_coverage_pct,
       '  ' || event_type || ' ' AS weather_condition,
       upper(event_type) AS weather_description,
       CASE WHEN event_id % 250 = 1 THEN NULL
            WHEN event_id % 500 = 0 THEN -1
            WHEN event_id % 501 = 0 THEN 200000
            ELSE CAST(floor(value * 20) AS BIGINT) END AS traffic_volume,
       {audit('traffic', 'ts')}
FROM events""")

_cte("b_events", (), f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE event_type WHEN 'click' THEN 'vehicle_detected' WHEN 'view' THEN 'pedestrian_count'
            WHEN 'error' THEN 'air_quality_reading' WHEN 'purchase' THEN 'order_placed'
            ELSE event_type END AS event_type,
       'sensor_' || CAST(user_id % 50 AS VARCHAR) AS sensor_id,
       'loc_' || json_extract_string(props, '$.k') AS location_id,
       CAST(40.5 AS DOUBLE) + CAST(user_id % 32 AS DOUBLE) / 64 AS latitude,
       CAST(-74.0 AS DOUBLE) - CAST(user_id % 16 AS DOUBLE) / 64 AS longitude,
       ts AS event_timestamp, value AS metric_value, ' unit ' AS metric_unit,
       'topic_' || CAST(event_id % 4 AS VARCHAR) AS kafka_topic,
       CAST(event_id % 3 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
       props AS raw_payload, {audit('events', 'ts')}
FROM events""")

_cte("b_air", (), f"""
SELECT n_name AS city, t AS measurement_timestamp,
       floor(i / 2) AS pm25, floor(i / 3) AS pm10,
       CASE WHEN o_orderkey % 9 <> 0 THEN floor(i / 4) END AS ozone,
       g AS nitric_oxide, g AS nitrogen_dioxide, g AS carbon_monoxide, g AS sulfur_dioxide,
       i AS aqi,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN i <= 50 THEN 'Good' WHEN i <= 100 THEN 'Satisfactory'
            WHEN i <= 200 THEN 'Moderate' WHEN i <= 300 THEN 'Poor' WHEN i <= 400 THEN 'Very Poor'
            ELSE 'Severe' END AS aqi_category,
       {audit('air', 't')}
FROM (SELECT o_orderkey, o_custkey, o_orderdate + INTERVAL 10592 DAY AS t,
             CAST(floor(o_totalprice / 1000) AS DOUBLE) AS i, CAST(o_orderkey % 64 AS DOUBLE) AS g
      FROM orders)
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey""")

_cte("b_weather", (), f"""
SELECT ' ' || n_name || '  ' AS city_name, e AS observation_timestamp,
       c AS temperature_celsius, c - 1.5 AS feels_like_celsius,
       CASE WHEN k % 4 <> 0 THEN k % 100 END AS humidity_pct,
       CASE WHEN k % 5 <> 0 THEN 980 + k % 50 END AS pressure_hpa,
       CASE WHEN k % 3 <> 0 THEN CAST(k % 40 AS DOUBLE) / 8 END AS wind_speed_ms,
       ' ' || lower(s_name) AS weather_condition,
       40 + CAST(k % 16 AS DOUBLE) / 8 AS latitude, -70 - CAST(k % 16 AS DOUBLE) / 8 AS longitude,
       {audit('weather', 'make_timestamp(e * 1000000)')}
FROM (SELECT s_suppkey AS k, s_suppkey * 3600 + 1704067200 AS e, s_name, s_nationkey,
             CAST(floor(s_acctbal) AS DOUBLE) / 200 AS c FROM supplier)
JOIN nation ON s_nationkey = n_nationkey""")

_cte("b_demographics", (), f"""
SELECT ' ' || c_name AS city_name, lower(substr(n_name, 1, 2)) || ' ' AS state_code, n_name AS state_name,
       CASE WHEN k % 6 <> 0 THEN CAST(k % 80 AS DOUBLE) END AS median_age,
       CASE WHEN k % 13 <> 0 THEN k * 1009 END AS total_population,
       CASE WHEN k % 17 <> 0 THEN k * 500 END AS male_population,
       CASE WHEN k % 19 <> 0 THEN k * 509 END AS female_population,
       CASE WHEN k % 7 <> 0 THEN CAST(k % 32 AS DOUBLE) / 8 END AS avg_household_size,
       c_mktsegment AS race, CASE WHEN k % 5 <> 0 THEN k * 3 END AS race_count,
       {audit('demographics', "TIMESTAMP '2024-01-01 00:00:00'")}
FROM (SELECT *, c_custkey AS k FROM customer) JOIN nation ON c_nationkey = n_nationkey""")

_cte("b_transit", (), """
SELECT CAST(p_partkey AS VARCHAR) AS route_id,
       CASE WHEN p_partkey % 10 <> 0 THEN p_name END AS route_name,
       CAST(p_size % 8 AS BIGINT) AS route_type_code, p_brand AS operator_name
FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey <= 3)""")

# ---- silver and staging ---------------------------------------------------

_WEEKDAY = "CAST(dayofweek(event_timestamp) AS INTEGER)"
_TRAFFIC_TIME = f"""event_timestamp, date_trunc('hour', event_timestamp) AS event_hour,
       CAST(event_timestamp AS DATE) AS event_date,
       CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day, {_WEEKDAY} AS day_of_week,
       {_WEEKDAY} IN (0, 6) AS is_weekend, ifnull(holiday_name, 'None') AS holiday_name"""
_TRAFFIC_FILLS = """ifnull(rainfall_mm, 0) AS rainfall_mm, ifnull(snowfall_mm, 0) AS snowfall_mm,
       ifnull(cloud_coverage_pct, 0) AS cloud_coverage_pct,
       upper(trim(weather_condition)) AS weather_condition"""
_TRAFFIC_KEPT = "event_timestamp IS NOT NULL AND traffic_volume >= 0 AND traffic_volume <= 100000"


def level(volume: str) -> str:
    return (f"CASE WHEN {volume} < 1000 THEN 'Low' WHEN {volume} < 3000 THEN 'Medium' "
            f"WHEN {volume} < 5000 THEN 'High' ELSE 'Very High' END")


def category(text: str) -> str:
    t = f"lower({text})"
    return (f"CASE WHEN contains({t}, 'traffic') OR contains({t}, 'vehicle') THEN 'TRAFFIC' "
            f"WHEN contains({t}, 'pedestrian') THEN 'PEDESTRIAN' "
            f"WHEN contains({t}, 'air') OR contains({t}, 'quality') THEN 'AIR_QUALITY' "
            f"WHEN contains({t}, 'order') THEN 'ORDER' ELSE 'OTHER' END")


_cte("s_traffic", ("b_traffic",), f"""
SELECT {_TRAFFIC_TIME}, round(temperature_kelvin - CAST(273.15 AS DOUBLE), 2) AS temperature_celsius,
       {_TRAFFIC_FILLS}, lower(trim(weather_description)) AS weather_description, traffic_volume,
       {level('traffic_volume')} AS traffic_level, _ingestion_timestamp, _source_id, _batch_id
FROM b_traffic WHERE {_TRAFFIC_KEPT}""")

_cte("st_traffic", ("b_traffic",), f"""
SELECT {_TRAFFIC_TIME},
       ifnull(temperature_kelvin - CAST(273.15 AS DOUBLE), CAST(20 AS DOUBLE)) AS temperature_celsius,
       {_TRAFFIC_FILLS}, traffic_volume, _ingestion_timestamp, _source_id, _batch_id
FROM b_traffic WHERE {_TRAFFIC_KEPT}""")

_cte("s_air", ("b_air",), """
SELECT upper(trim(city)) AS city, measurement_timestamp,
       date_trunc('hour', measurement_timestamp) AS measurement_hour,
       CAST(measurement_timestamp AS DATE) AS measurement_date,
       ifnull(pm25, 0) AS pm25, ifnull(pm10, 0) AS pm10, ifnull(aqi, 0) AS aqi,
       ifnull(aqi_category, 'Unknown') AS aqi_category, ifnull(ozone, 0) AS ozone,
       ifnull(carbon_monoxide, 0) AS carbon_monoxide, ifnull(sulfur_dioxide, 0) AS sulfur_dioxide,
       ifnull(nitrogen_dioxide, 0) AS nitrogen_dioxide, ifnull(aqi > 300, false) AS is_hazardous,
       _ingestion_timestamp, _source_id
FROM b_air WHERE city IS NOT NULL AND measurement_timestamp IS NOT NULL""")

_cte("s_weather", ("b_weather",), """
SELECT upper(trim(city_name)) AS city_name,
       make_timestamp(observation_timestamp * 1000000) AS observation_timestamp,
       date_trunc('hour', make_timestamp(observation_timestamp * 1000000)) AS observation_hour,
       round(temperature_celsius, 2) AS temperature_celsius,
       round(feels_like_celsius, 2) AS feels_like_celsius,
       ifnull(humidity_pct, 0) AS humidity_pct, ifnull(pressure_hpa, 1013) AS pressure_hpa,
       ifnull(wind_speed_ms, 0) AS wind_speed_ms, upper(trim(weather_condition)) AS weather_condition,
       latitude, longitude,
       CASE WHEN temperature_celsius < 0 THEN 'Cold' WHEN temperature_celsius < 10 THEN 'Cool'
            WHEN temperature_celsius < 25 THEN 'Mild' WHEN temperature_celsius < 35 THEN 'Warm'
            WHEN temperature_celsius >= 35 THEN 'Extreme Heat' ELSE 'Cold' END AS temperature_category,
       _ingestion_timestamp, _source_id
FROM b_weather WHERE city_name IS NOT NULL""")

_cte("st_events", ("b_events",), f"""
SELECT event_id, upper(trim(event_type)) AS event_type, sensor_id, location_id,
       round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, event_timestamp,
       date_trunc('minute', event_timestamp) AS event_minute,
       date_trunc('hour', event_timestamp) AS event_hour,
       round(metric_value, 4) AS metric_value, trim(metric_unit) AS metric_unit,
       kafka_topic, kafka_partition, kafka_offset, {category('event_type')} AS event_category,
       _ingestion_timestamp, _source_id, _batch_id
FROM b_events WHERE event_id IS NOT NULL AND event_type IS NOT NULL""")

_cte("s_events", ("st_events",), "SELECT * EXCLUDE (_batch_id) FROM st_events")

_cte("s_demographics", ("b_demographics",), """
SELECT upper(trim(city_name)) AS city_name, upper(trim(state_code)) AS state_code, state_name,
       ifnull(median_age, 35) AS median_age, ifnull(total_population, 0) AS total_population,
       ifnull(male_population, 0) AS male_population, ifnull(female_population, 0) AS female_population,
       ifnull(avg_household_size, CAST(2.5 AS DOUBLE)) AS avg_household_size, race,
       ifnull(race_count, 0) AS race_count,
       CASE WHEN total_population IS NULL OR total_population >= 1000000 THEN 'Mega'
            WHEN total_population >= 500000 THEN 'Large'
            WHEN total_population >= 100000 THEN 'Medium' ELSE 'Small' END AS city_size_category,
       _ingestion_timestamp, _source_id
FROM b_demographics WHERE city_name IS NOT NULL""")

# ---- gold -----------------------------------------------------------------

_VOLUMES = """max(traffic_volume) AS max_traffic_volume, min(traffic_volume) AS min_traffic_volume,
       CAST(sum(traffic_volume) AS BIGINT) AS total_traffic_volume, count(*) AS measurement_count"""

_cte("g_traffic", ("s_traffic",), f"""
SELECT event_hour AS hour_key, event_date AS date_key, hour_of_day, day_of_week, is_weekend,
       holiday_name <> 'None' AS is_holiday, weather_condition, temperature_celsius, rainfall_mm, snowfall_mm,
       CAST(round_even(avg(traffic_volume), 0) AS INTEGER) AS avg_traffic_volume, {_VOLUMES},
       stddev_samp(traffic_volume) AS traffic_stddev
FROM s_traffic GROUP BY ALL""")

_cte("g_traffic_model", ("st_traffic",), f"""
SELECT event_hour AS hour_key, event_date AS date_key, hour_of_day, day_of_week, is_weekend, weather_condition,
       round(avg(temperature_celsius), 2) AS avg_temperature_celsius,
       round(avg(rainfall_mm), 3) AS avg_rainfall_mm, round(avg(snowfall_mm), 3) AS avg_snowfall_mm,
       CAST(round(avg(traffic_volume), 0) AS INTEGER) AS avg_traffic_volume, {_VOLUMES},
       round(stddev_samp(traffic_volume), 2) AS traffic_stddev,
       {level('avg(traffic_volume)')} AS traffic_level
FROM st_traffic GROUP BY event_hour, event_date, hour_of_day, day_of_week, is_weekend, weather_condition""")


def mode_of(table: str, keys: str, value: str, name: str) -> str:
    """Most frequent value per key; ties go to the smallest."""
    return f"""SELECT {keys}, {value} AS {name} FROM (
    SELECT {keys}, {value}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {value}) AS place
    FROM {table} WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) WHERE place = 1"""


_cte("air_mode", ("s_air",), mode_of("s_air", "city, measurement_date", "aqi_category", "dominant_aqi_category"))

_cte("g_air", ("s_air", "air_mode"), """
SELECT a.*, m.dominant_aqi_category FROM (
    SELECT city, measurement_date AS date_key, avg(aqi) AS avg_aqi, max(aqi) AS max_aqi, min(aqi) AS min_aqi,
           avg(pm25) AS avg_pm25, avg(pm10) AS avg_pm10, avg(ozone) AS avg_ozone,
           avg(carbon_monoxide) AS avg_co, count(*) FILTER (WHERE is_hazardous) AS hazardous_hours,
           count(*) AS measurement_count
    FROM s_air GROUP BY city, measurement_date) a
JOIN air_mode m ON m.city = a.city AND m.measurement_date = a.date_key""")

_cte("g_air_model", ("s_air", "air_mode"), """
SELECT a.*, m.dominant_aqi_category FROM (
    SELECT city, measurement_date AS date_key, round(avg(aqi), 2) AS avg_aqi, round(max(aqi), 2) AS max_aqi,
           round(min(aqi), 2) AS min_aqi, round(avg(pm25), 2) AS avg_pm25, round(max(pm25), 2) AS max_pm25,
           round(avg(pm10), 2) AS avg_pm10, round(avg(ozone), 2) AS avg_ozone,
           round(avg(carbon_monoxide), 3) AS avg_carbon_monoxide,
           round(avg(sulfur_dioxide), 2) AS avg_sulfur_dioxide,
           round(avg(nitrogen_dioxide), 2) AS avg_nitrogen_dioxide,
           count(*) AS measurement_count, count(*) FILTER (WHERE is_hazardous) AS hazardous_hours_count,
           round(CAST(count(*) FILTER (WHERE is_hazardous) AS DOUBLE) * 100 / count(*), 2) AS hazardous_hours_pct
    FROM s_air GROUP BY city, measurement_date) a
JOIN air_mode m ON m.city = a.city AND m.measurement_date = a.date_key""")

_cte("g_events", ("s_events",), """
SELECT event_hour AS hour_key, event_category, kafka_topic, count(*) AS event_count,
       count(DISTINCT sensor_id) AS unique_sensors, count(DISTINCT location_id) AS unique_locations,
       avg(metric_value) AS avg_metric_value, max(metric_value) AS max_metric_value,
       min(metric_value) AS min_metric_value
FROM s_events GROUP BY event_hour, event_category, kafka_topic""")

_cte("days", (), """
SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month_num,
       CAST(day(date_key) AS INTEGER) AS day_num, CAST(dayofweek(date_key) AS INTEGER) AS day_of_week,
       CAST(dayofyear(date_key) AS INTEGER) AS day_of_year, CAST(week(date_key) AS INTEGER) AS week_of_year,
       CAST(quarter(date_key) AS INTEGER) AS quarter, dayname(date_key) AS day_name,
       left(dayname(date_key), 3) AS day_name_short, monthname(date_key) AS month_name,
       left(monthname(date_key), 3) AS month_name_short,
       CAST(strftime(date_key, '%Y%m%d') AS INTEGER) AS date_int,
       dayofweek(date_key) IN (0, 6) AS is_weekend, dayofweek(date_key) BETWEEN 1 AND 5 AS is_weekday,
       ['Winter', 'Spring', 'Summer', 'Autumn'][1 + (month(date_key) % 12) // 3] AS season,
       CAST(1 + (month(date_key) % 12) // 3 AS INTEGER) AS season_num,
       CAST(date_trunc('month', date_key) AS DATE) AS first_day_of_month,
       last_day(date_key) AS last_day_of_month,
       CAST(date_trunc('quarter', date_key) AS DATE) AS first_day_of_quarter,
       CAST(date_trunc('year', date_key) AS DATE) AS first_day_of_year
FROM (SELECT CAST(range AS DATE) AS date_key
      FROM range(TIMESTAMP '2020-01-01', TIMESTAMP '2027-01-01', INTERVAL 1 DAY))""")

_cte("e_daily", ("g_events",), """
SELECT CAST(hour_key AS DATE) AS date_key, CAST(sum(event_count) AS BIGINT) AS total_stream_events,
       CAST(sum(unique_sensors) AS BIGINT) AS sensors
FROM g_events GROUP BY CAST(hour_key AS DATE)""")

_cte("t_mode", ("g_traffic_model",), mode_of("g_traffic_model", "date_key", "traffic_level", "traffic_level"))

_cte("t_daily", ("g_traffic_model", "t_mode"), """
SELECT f.*, m.traffic_level FROM (
    SELECT date_key, avg(avg_traffic_volume) AS avg_daily_traffic,
           CAST(sum(total_traffic_volume) AS BIGINT) AS total_daily_traffic,
           max(max_traffic_volume) AS peak_traffic_volume, count(*) AS traffic_hours_measured
    FROM g_traffic_model GROUP BY date_key) f
JOIN t_mode m ON m.date_key = f.date_key""")

_cte("a_daily", ("g_air_model",), """
SELECT date_key, avg(avg_aqi) AS avg_daily_aqi, max(max_aqi) AS peak_aqi,
       CAST(sum(hazardous_hours_count) AS BIGINT) AS total_hazardous_hours,
       count(DISTINCT city) AS cities_measured
FROM g_air_model GROUP BY date_key""")
