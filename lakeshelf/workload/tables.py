"""Reading the test tables and projecting them into the bronze shapes.

The projections use integers and eighths on purpose: averages that are rounded later
must not sit on decimal ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeshelf.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the test tables and the SQL twins have them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _eighths(c: Column, modulus: int) -> Column:
    return (c % modulus).cast("double") / F.lit(8.0)


def _audit(source_id: str, ts: Column) -> list[Column]:
    return [
        ts.alias("_ingestion_timestamp"),
        F.lit(source_id).alias("_source_id"),
        F.lit(f"{source_id}_1").alias("_batch_id"),
    ]


def bronze_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i, kind, hour = F.col("event_id"), F.col("event_type"), F.hour("ts")
    return e.select(
        F.col("ts").alias("event_timestamp"),
        F.when(i % 33 == 0, F.lit("Holiday")).alias("holiday_name"),
        F.when(hour != 3, (250 + 2 * hour).cast("double")).alias("temperature_kelvin"),
        F.when(kind == "error", _eighths(i, 40)).alias("rainfall_mm"),
        F.when(kind == "signup", _eighths(i, 24)).alias("snowfall_mm"),
        F.when(i % 7 != 0, F.col("user_id") % 101).alias("cloud_coverage_pct"),
        F.concat(F.lit("  "), kind, F.lit(" ")).alias("weather_condition"),
        F.upper(kind).alias("weather_description"),
        F.when(i % 250 == 1, F.lit(None))
        .when(i % 500 == 0, F.lit(-1))
        .when(i % 501 == 0, F.lit(200000))
        .otherwise(F.floor(F.col("value") * 20))
        .cast("bigint")
        .alias("traffic_volume"),
        *_audit("traffic", F.col("ts")),
    )


# The five event types of the test table, as types that hit every category.
EVENT_TYPES = [
    ("click", "vehicle_detected"),
    ("view", "pedestrian_count"),
    ("error", "air_quality_reading"),
    ("purchase", "order_placed"),
]


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i, user = F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")
    for raw, name in EVENT_TYPES:
        kind = F.when(F.col("event_type") == raw, F.lit(name)).otherwise(kind)
    return e.select(
        i.cast("string").alias("event_id"),
        kind.alias("event_type"),
        F.concat(F.lit("sensor_"), (user % 50).cast("string")).alias("sensor_id"),
        F.concat(F.lit("loc_"), F.get_json_object("props", "$.k")).alias("location_id"),
        (F.lit(40.5) + (user % 32).cast("double") / 64).alias("latitude"),
        (F.lit(-74.0) - (user % 16).cast("double") / 64).alias("longitude"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("metric_value"),
        F.lit(" unit ").alias("metric_unit"),
        F.concat(F.lit("topic_"), (i % 4).cast("string")).alias("kafka_topic"),
        (i % 3).cast("int").alias("kafka_partition"),
        i.alias("kafka_offset"),
        F.col("props").alias("raw_payload"),
        *_audit("events", F.col("ts")),
    )


# Order dates start in 1995; moved by 29 years they meet the events of January 2024
# and run past the end of the date dimension.
ORDER_DAY_SHIFT = 10592

# Category of an index value, upper bounds included.
AQI_BUCKETS = [
    (50, "Good"), (100, "Satisfactory"), (200, "Moderate"), (300, "Poor"), (400, "Very Poor"),
]
AQI_BUCKET_TOP = "Severe"


def shifted_day(c: str) -> Column:
    return F.date_add(F.to_date(c), ORDER_DAY_SHIFT)


def bronze_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    homes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    aqi = F.floor(F.col("o_totalprice") / 1000)
    key = F.col("o_orderkey")
    label = F.lit(AQI_BUCKET_TOP)
    for bound, name in reversed(AQI_BUCKETS):
        label = F.when(aqi <= bound, F.lit(name)).otherwise(label)
    gases = ("nitric_oxide", "nitrogen_dioxide", "carbon_monoxide", "sulfur_dioxide")
    ts = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(ORDER_DAY_SHIFT))
    return orders.join(homes, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("n_name").alias("city"),
        ts.alias("measurement_timestamp"),
        F.floor(aqi / 2).cast("double").alias("pm25"),
        F.floor(aqi / 3).cast("double").alias("pm10"),
        F.when(key % 9 != 0, F.floor(aqi / 4)).cast("double").alias("ozone"),
        *[(key % 64).cast("double").alias(g) for g in gases],
        aqi.cast("double").alias("aqi"),
        F.when(key % 11 != 0, label).alias("aqi_category"),
        *_audit("air", ts),
    )


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    key = F.col("s_suppkey")
    celsius = F.floor("s_acctbal").cast("double") / 200
    return s.select(
        F.concat(F.lit(" "), F.col("n_name"), F.lit("  ")).alias("city_name"),
        (key * 3600 + 1704067200).alias("observation_timestamp"),
        celsius.alias("temperature_celsius"),
        (celsius - 1.5).alias("feels_like_celsius"),
        F.when(key % 4 != 0, key % 100).alias("humidity_pct"),
        F.when(key % 5 != 0, 980 + key % 50).alias("pressure_hpa"),
        F.when(key % 3 != 0, (key % 40).cast("double") / 8).alias("wind_speed_ms"),
        F.concat(F.lit(" "), F.lower("s_name")).alias("weather_condition"),
        (F.lit(40.0) + (key % 16).cast("double") / 8).alias("latitude"),
        (F.lit(-70.0) - (key % 16).cast("double") / 8).alias("longitude"),
        *_audit("weather", F.timestamp_seconds(key * 3600 + 1704067200)),
    )


def bronze_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    return c.select(
        F.concat(F.lit(" "), F.col("c_name")).alias("city_name"),
        F.concat(F.lower(F.substring("n_name", 1, 2)), F.lit(" ")).alias("state_code"),
        F.col("n_name").alias("state_name"),
        F.when(key % 6 != 0, (key % 80).cast("double")).alias("median_age"),
        F.when(key % 13 != 0, key * 1009).alias("total_population"),
        F.when(key % 17 != 0, key * 500).alias("male_population"),
        F.when(key % 19 != 0, key * 509).alias("female_population"),
        F.when(key % 7 != 0, (key % 32).cast("double") / 8).alias("avg_household_size"),
        F.col("c_mktsegment").alias("race"),
        F.when(key % 5 != 0, key * 3).alias("race_count"),
        *_audit("demographics", F.lit("2024-01-01 00:00:00").cast("timestamp")),
    )


def bronze_transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes, the first few of them twice, for the uniqueness check."""
    key = F.col("p_partkey")
    copies = F.when(key <= 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("route_id"),
        F.when(key % 10 != 0, F.col("p_name")).alias("route_name"),
        (F.col("p_size") % 8).cast("bigint").alias("route_type_code"),
        F.col("p_brand").alias("operator_name"),
        F.explode(copies).alias("copy_no"),
    )
