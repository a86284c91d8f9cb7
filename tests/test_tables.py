from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import audit, incremental
from lakeshelf.operators.tables import qualify
from lakeshelf.plans import gold, medallion
from lakeshelf.plans.staging import stg_traffic
from lakeshelf.workload import tables as t


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(
    "name, schema, expected",
    [
        ("bronze_x", None, "bronze.bronze_x"),
        ("Silver_x", None, "silver.Silver_x"),
        ("gold_x", "other", "other.gold_x"),
        ("a.b", "other", "a.b"),
        ("plain", None, "plain"),
    ],
)
def test_qualify(name, schema, expected):
    assert qualify(name, schema) == expected


def test_append_is_by_name_and_counts(lake, spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    assert lake.append(a, "bronze_t") == 1
    assert lake.append(spark.createDataFrame([("y", 2), ("z", 3)], "b string, a int"), "bronze_t") == 2
    assert lake.append(spark.createDataFrame([(9,)], "a int"), "bronze_t") == 1
    assert [r for r in lake.read("bronze_t").orderBy("a").collect()] == [(1, "x"), (2, "y"), (3, "z"), (9, None)]
    with pytest.raises(ValueError):
        lake.append(spark.createDataFrame([(1, 2)], "a int, c int"), "bronze_t")


def test_empty_frame_writes_nothing(lake, spark):
    lake.append(spark.createDataFrame([(1,)], "a int"), "bronze_t")
    assert lake.append(spark.createDataFrame([], "a int"), "bronze_t") == 0
    assert lake.append(spark.range(5).where("id < 0").select(F.col("id").cast("int").alias("a")), "bronze_t") == 0
    assert lake.stats("bronze_t") == {"table": lake.table("bronze_t"), "rows": 1}


def test_overwrite_and_catalog(lake, spark):
    lake.overwrite(spark.range(3), "gold_t")
    assert lake.overwrite(spark.range(2), "gold_t") == 2
    assert lake.stats("gold_t")["rows"] == 2
    assert lake.exists("gold_t") and not lake.exists("gold_none")
    assert ("gold", "gold_t") in lake.list_tables("gold")
    assert "error" in lake.stats("gold_none")
    assert lake.read("gold_t", limit=1).count() == 1
    assert lake.read(query=f"select max(id) m from {lake.table('gold_t')}").first()["m"] == 1
    lake.create_sql_view("staging_v", f"SELECT id FROM {lake.table('gold_t')}")
    assert lake.read("staging_v").count() == 2
    assert ("staging", "staging_v") in lake.list_tables()
    with pytest.raises(ValueError):
        lake.write(spark.range(1), "gold_t", "merge")


def test_overwrite_partitions_touches_only_its_own(lake, spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    lake.overwrite_partitions(df, "gold_t", ["p"])
    for _ in range(2):
        lake.overwrite_partitions(spark.createDataFrame([(7, "b")], "v int, p string"), "gold_t", ["p"])
    assert rows(lake.read("gold_t").select("p", "v")) == [("a", 1), ("b", 7)]


def hours(spark, *values):
    base = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(base + timedelta(hours=h), v) for h, v in values], "event_hour timestamp, v int"
    )


def build(df):
    by_hour = df.groupBy(F.col("event_hour").alias("hour_key"), F.to_date("event_hour").alias("date_key")).agg(
        F.sum("v").alias("total")
    )
    return incremental.with_month(by_hour)


def load(lake, source, **kw):
    return incremental.load(lake, "gold_f", source, build, "event_hour", "hour_key", "date_key", "month_key", **kw)


def test_incremental_strict(lake, spark):
    first = hours(spark, (0, 1), (1, 2))
    assert load(lake, first) == 2
    assert load(lake, first) == 0
    # a late row of hour 1 is left out, hour 2 is added
    assert load(lake, hours(spark, (1, 50), (2, 3))) == 1
    assert [r["total"] for r in lake.read("gold_f").orderBy("hour_key").collect()] == [1, 2, 3]


def test_incremental_lookback_rebuilds_days(lake, spark):
    load(lake, hours(spark, (0, 1), (23, 2), (25, 4)))
    everything = hours(spark, (0, 99), (23, 2), (25, 4), (25, 10), (50, 5))
    load(lake, everything, lookback_days=0)
    # the first day keeps its old rows, the newest day is rebuilt, a new day is added
    assert [r["total"] for r in lake.read("gold_f").orderBy("hour_key").collect()] == [1, 2, 14, 5]


def test_incremental_empty_target_is_full_load(lake, spark):
    load(lake, hours(spark))
    assert load(lake, hours(spark, (0, 1))) == 1


def test_replace_by_key(lake, spark):
    cols = "k int, d date, v int"
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    lake.overwrite(spark.createDataFrame([(1, d1, 1), (2, d1, 2), (None, d2, 3)], cols), "gold_k", ["d"])
    delta = spark.createDataFrame([(2, d1, 20), (None, d2, 30), (5, d2, 5)], cols)
    for _ in range(2):
        incremental.replace_by_key(lake, "gold_k", delta, ["k", "d"], "d")
    got = {(r["k"], r["d"]): r["v"] for r in lake.read("gold_k").collect()}
    assert got == {(1, d1): 1, (2, d1): 20, (None, d2): 30, (5, d2): 5}
    with pytest.raises(ValueError):
        incremental.replace_by_key(lake, "gold_k", delta, ["k"], "d")


def test_sync_columns(lake, spark):
    d = date(2024, 1, 1)
    lake.overwrite(spark.createDataFrame([(1, 2, d)], "a int, old int, d date"), "gold_s", ["d"])
    added = spark.createDataFrame([(1, 2, "n", d)], "a int, old int, new string, d date")
    assert incremental.sync_columns(lake, "gold_s", added).added == ("new",)
    lake.append(added, "gold_s")
    final = spark.createDataFrame([(1, "n", d)], "a bigint, new string, d date")
    change = incremental.sync_columns(lake, "gold_s", final)
    assert change.removed == ("old",) and change.retyped == ("a",)
    got = lake.read("gold_s").select("a", "new", "d")
    assert sorted(map(str, got.collect())) == sorted(map(str, [
        got.first().__class__(a=1, new=None, d=d), got.first().__class__(a=1, new="n", d=d)]))
    assert set(lake.read("gold_s").columns) == {"a", "new", "d"}
    assert lake.partition_columns("gold_s") == ["d"]


def as_timestamp(df, name):
    return df.withColumn(name, F.col(name).cast("timestamp"))


def test_layers_build_and_skip(lake, spark, sf):
    assert {r.status for r in medallion.build_silver(lake)} == {audit.SKIPPED}
    lake.overwrite(as_timestamp(t.bronze_traffic(spark, sf), "event_timestamp"), medallion.BRONZE_TRAFFIC)
    # two months are enough here; the whole span would be thousands of day folders
    air = as_timestamp(t.bronze_air_quality(spark, sf), "measurement_timestamp")
    lake.overwrite(air.where("measurement_timestamp < '2024-03-01'"), medallion.BRONZE_AIR)
    lake.overwrite(t.bronze_events(spark, sf), medallion.BRONZE_EVENTS)
    lake.overwrite(t.bronze_weather(spark, sf), medallion.BRONZE_WEATHER)
    lake.overwrite(t.bronze_demographics(spark, sf), medallion.BRONZE_DEMOGRAPHICS)
    assert all(r.status == audit.SUCCESS and r.rows for r in medallion.build_silver(lake))
    assert all(r.status == audit.SUCCESS and r.rows for r in medallion.build_gold(lake))
    full = rows(lake.read(medallion.FACT_TRAFFIC).drop("gold_processed_at"))
    # rebuilding the last days changes nothing but them
    medallion.build_silver(lake, since=date(2024, 1, 20))
    medallion.build_gold(lake, since=date(2024, 1, 20))
    assert list(map(str, rows(lake.read(medallion.FACT_TRAFFIC).drop("gold_processed_at")))) == list(map(str, full))

    assert all(r.status == audit.SUCCESS and r.rows for r in medallion.build_models(lake))
    again = {r.target: r.rows for r in medallion.build_models(lake)}
    assert again[medallion.FACT_TRAFFIC_MODEL] == 0 and again[medallion.FACT_AIR_MODEL] == 0
    redone = {r.target: r.rows for r in medallion.build_models(lake, lookback_days=1)}
    assert redone[medallion.FACT_TRAFFIC_MODEL] > 0
    expected = gold.fact_traffic_hourly_model(stg_traffic(lake.read(medallion.BRONZE_TRAFFIC)))
    assert lake.read(medallion.FACT_TRAFFIC_MODEL).count() == expected.count()
    assert lake.read(medallion.DAILY_SUMMARY).count() > 30

    audit.create_audit_tables(lake)
    report = medallion.run_quality(lake)
    assert report.count() == 13 + 25  # the standing suite and the declared column tests
    assert lake.stats(audit.QUALITY_AUDIT)["rows"] == 13 + 25
