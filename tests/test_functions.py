from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from lakeshelf import functions as L
from lakeshelf.operators import aggregates
from lakeshelf.operators.filters import newer_than_target
from lakeshelf.plans import dims, gold, silver


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def values(spark, rows, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_integer_cast(spark):
    raw = ["12", "12.0", "1e3", "12.7", "x", "", None, "1e30", "9007199254740993", " 5 ", "NaN"]
    got = values(spark, raw, "string", lambda c: L.tolerant_cast(c, "bigint", T.StringType()))
    assert got == [12, 12, 1000, None, None, None, None, None, 9007199254740993, 5, None]
    got = values(spark, [12.0, 12.7, None], "double", lambda c: L.tolerant_cast(c, "int", T.DoubleType()))
    assert got == [12, None, None]


def test_other_casts(spark):
    cast = lambda kind: lambda c: L.tolerant_cast(c, kind, T.StringType())
    assert values(spark, ["1.5", "x", None], "string", cast("real")) == [1.5, None, None]
    assert values(spark, ["true", "no", "maybe"], "string", cast("bool")) == [True, False, None]
    assert values(spark, ["2024-01-01", "x"], "string", cast("date")) == ["2024-01-01", "x"]
    got = values(spark, ["2024-01-01 05:00:00", "2024-01-01T05:00:00+02:00", "01/02/2024 03:04", "x"], "string",
                 lambda c: L.tolerant_cast(c, "timestamp", T.StringType(), ["dd/MM/yyyy HH:mm"]).cast("timestamp_ntz"))
    assert got == [datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 3), datetime(2024, 2, 1, 3, 4), None]
    nanos = values(spark, [1_700_000_000_000_000_000], "bigint",
                   lambda c: L.tolerant_cast(c, "timestamp", T.LongType()).cast("timestamp_ntz"))
    assert nanos == [datetime(2023, 11, 14, 22, 13, 20)]


def test_rounding(spark):
    assert values(spark, [2.5, 3.5, 3.7, None], "double", L.round_half_even_int) == [2, 4, 4, None]
    assert values(spark, [1.005, 2.675, -0.125, 161.025], "double", lambda c: L.round_to(c, 2)) == [
        1.0, 2.68, -0.13, 161.03]
    assert values(spark, [2.5, -2.5], "double", lambda c: L.round_to(c, 0)) == [3.0, -3.0]


def test_days(spark):
    sunday, saturday, new_year = date(2024, 1, 7), date(2024, 1, 6), date(2021, 1, 1)
    assert values(spark, [sunday, saturday], "date", L.day_of_week) == [0, 6]
    assert values(spark, [sunday, saturday, new_year, None], "date", L.is_weekend) == [True, True, False, False]
    assert values(spark, [new_year], "date", F.weekofyear) == [53]
    months = [date(2024, m, 1) for m in range(1, 13)]
    assert values(spark, months, "date", L.season_name) == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"])
    assert values(spark, months, "date", L.season_number) == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]


def test_text_and_labels(spark):
    assert values(spark, ["\t a ", None], "string", L.tidy_upper) == ["\t A", None]
    kinds = ["traffic_jam", "AIR_quality", "order_x", "air_traffic", "Pedestrian", "misc"]
    assert values(spark, kinds, "string", silver.event_category) == [
        "TRAFFIC", "AIR_QUALITY", "ORDER", "TRAFFIC", "PEDESTRIAN", "OTHER"]
    bounds = [999, 1000, 2999, 3000, 4999, 5000, None]
    assert values(spark, bounds, "int", silver.traffic_level) == [
        "Low", "Medium", "Medium", "High", "High", "Very High", "Very High"]


def test_surrogate_key(spark):
    key = one(spark, L.surrogate_key(F.lit(1), F.lit(None).cast("string"), F.lit("a")))
    assert key == one(spark, F.md5(F.lit("1|__null__|a")))


def test_mode_ties_and_nulls(spark):
    rows = [("a", 3, 2), ("a", 2, 2), ("a", 1, 1), ("a", None, 9), ("b", None, 1)]
    df = spark.createDataFrame(rows, "g string, v int, n int")
    got = dict(df.groupBy("g").agg(aggregates.most_frequent("v", "n")).collect())
    assert got == {"a": 2, "b": None}


def test_stddev_of_one_row_is_null(spark):
    assert spark.range(1).agg(F.stddev_samp("id")).first()[0] is None


def test_tuple_distinct_counts_null_tuples(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1)], "a int, b int")
    row = df.agg(aggregates.count_distinct_tuple("a", "b").alias("t"), aggregates.count_distinct_tuple("a").alias("s")).first()
    assert (row["t"], row["s"]) == (2, 1)


def test_newer_than_empty_target_lets_nothing_through(spark):
    source = spark.range(3)
    assert newer_than_target(source, source.where("id < 0"), "id", "id").count() == 0
    assert newer_than_target(source, source.where("id < 2"), "id", "id").count() == 1


@pytest.mark.parametrize("aqi, weekend, score", [(None, True, 100.0), (0.0, False, 100.0), (123.0, True, 92.7), (2000.0, False, 0.0)])
def test_health_score(spark, aqi, weekend, score):
    c = gold.health_score(F.coalesce(F.lit(aqi).cast("double"), F.lit(0.0)), F.lit(weekend))
    assert one(spark, c) == score


def test_population_null_is_top_size(spark):
    row = {"city_name": "x", "state_code": "y", "state_name": "z", "race": "r", "_source_id": "s"}
    numbers = ["median_age", "total_population", "male_population", "female_population", "avg_household_size", "race_count"]
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    df = df.withColumns({n: F.lit(None).cast("double" if n in ("median_age", "avg_household_size") else "bigint") for n in numbers})
    out = silver.silver_demographics(df.withColumn("_ingestion_timestamp", F.current_timestamp())).first()
    assert (out["total_population"], out["city_size_category"], out["median_age"]) == (0, "Mega", 35.0)


def test_date_dimension(spark):
    days = dims.dim_date(spark)
    assert days.count() == 2557 and len(days.columns) == 21
    assert len(dims.dim_date_short(spark).columns) == 12
    leap = days.where("date_key = '2024-02-29'").first()
    assert (leap["day_of_year"], leap["last_day_of_month"], leap["date_int"]) == (60, date(2024, 2, 29), 20240229)


def test_date_dimension_is_not_broadcast_by_hint(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),)], "date_key date")
    large = spark.range(20_000_000).select(F.date_add(F.lit(date(1900, 1, 1)), (F.col("id") % 360_000).cast("int")).alias("date_key"))
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    for dates in (dims.dim_date(spark), large):
        assert "strategy=broadcast" not in plan(dims.join_dates(df, dates))
