"""Groups touched by rows that arrived late are recomputed, and nothing else is read."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from lakeshelf.operators import incremental

BASE = datetime(2024, 1, 1)
GROUPS = incremental.Groups("hour", "hour_key", "month_key", lambda h: F.trunc(h, "month"), "day", F.to_date, "ts")


def rows(spark, *listed):
    """(hours after BASE, value, days after BASE of arrival)"""
    data = [(BASE + timedelta(hours=h) if h is not None else None, v, BASE + timedelta(days=a) if a is not None else None) for h, v, a in listed]
    df = spark.createDataFrame(data, "ts timestamp, v int, _ingestion_timestamp timestamp")
    return df.select(F.date_trunc("hour", "ts").alias("hour"), "ts", "v", "_ingestion_timestamp", F.to_date("ts").alias("day"))


def build(df):
    fact = df.groupBy(F.col("hour").alias("hour_key"), (F.col("v") % 2).alias("kind")).agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    return fact.withColumn("month_key", F.trunc("hour_key", "month"))


@pytest.fixture()
def refreshed(lake):
    def run(df=None):
        if df is not None:
            lake.append(df, "bronze_s", ["day"])
        return incremental.refresh_groups(lake, "gold_f", lake.read("bronze_s"), build, GROUPS)
    return run


def same_as_full(lake):
    full = build(lake.read("bronze_s"))
    assert sorted(map(str, lake.read("gold_f").select(full.columns).collect())) == sorted(map(str, full.collect()))


def test_late_rows_equal_a_full_build(lake, spark, refreshed):
    assert refreshed(rows(spark, (0.5, 1, 0), (1.5, 2, 0), (800, 3, 34), (1600, 4, 67), (None, 9, 67))) == -1
    same_as_full(lake)
    # a late row of a known hour, one of a new hour, one of an hour without time, in a month without rows
    assert refreshed(rows(spark, (0.2, 10, 80), (5, 5, 80), (None, 8, 80), (2400, 1, 100))) == 5  # with the hour at the mark
    same_as_full(lake)
    assert refreshed() == 1  # what arrived at the very time of the mark is taken again
    same_as_full(lake)
    assert refreshed(rows(spark, (0.2, 11, 100))) == 2  # the same arrival time as the mark
    same_as_full(lake)


def test_untouched_partitions_are_not_read(lake, spark, refreshed):
    refreshed(rows(spark, (0.5, 1, 0), (30, 2, 1), (800, 3, 34), (1600, 4, 67)))
    lake.append(rows(spark, (30.2, 7, 80)), "bronze_s")
    source, target = (lake.location(n).removeprefix("file:") for n in ("bronze_s", "gold_f"))
    # files that would fail if they were opened for more than their arrival times
    for folder, kept in ((target, "month_key=2024-01-01"),):
        for name in glob.glob(f"{folder}/*/*.parquet"):
            if kept not in name:
                os.rename(name, f"{name}.away")
    plan = incremental._rows_of(
        lake.read("bronze_s"), spark.createDataFrame([(BASE + timedelta(hours=30),)], "__group timestamp"), GROUPS)
    files = {os.path.basename(os.path.dirname(r[0])) for r in plan.select("_metadata.file_path").distinct().collect()}
    assert files == {"day=2024-01-02"} and source
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "day#" in text.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(ts" in text
    assert refreshed() == 2
    for name in glob.glob(f"{target}/*/*.away"):
        os.rename(name, name.removesuffix(".away"))
    spark.catalog.refreshTable(lake.table("gold_f"))
    same_as_full(lake)


def test_a_group_that_builds_nothing_leaves_the_target(lake, spark):
    lake.append(rows(spark, (0.5, 1, 0), (800, 3, 34)), "bronze_s", ["day"])

    def positive(df):
        least = F.min("v").over(Window.partitionBy("hour"))
        return build(df.withColumn("least", least).where("least > 0").drop("least"))

    incremental.refresh_groups(lake, "gold_f", lake.read("bronze_s"), positive, GROUPS)
    lake.append(rows(spark, (800, -1, 40)), "bronze_s")
    assert incremental.refresh_groups(lake, "gold_f", lake.read("bronze_s"), positive, GROUPS) == 1
    assert [r["hour_key"] for r in lake.read("gold_f").collect()] == [BASE]


def test_many_partitions_are_joined(lake, spark, refreshed, monkeypatch):
    monkeypatch.setattr(incremental, "NAMED_PARTITIONS", 1)
    refreshed(rows(spark, (0.5, 1, 0), (30, 2, 1), (800, 3, 34), (None, 1, 1)))
    refreshed(rows(spark, (0.5, 5, 50), (30, 6, 50), (None, 2, 50)))
    same_as_full(lake)


def test_nothing_new(lake, spark, refreshed):
    refreshed(rows(spark, (0.5, 1, None)))
    assert incremental.arrived_upto(lake, "gold_f") is None
    same_as_full(lake)


def test_model_facts_by_arrival(lake, spark, sf):
    from lakeshelf.plans import medallion
    from lakeshelf.workload import tables as t

    bronze = t.bronze_traffic(spark, sf).withColumn(
        "_ingestion_timestamp", F.when(F.col("traffic_volume") % 5 == 0, F.lit("2024-06-01")).otherwise(F.lit("2024-02-01")).cast("timestamp"))
    on_time = F.col("_ingestion_timestamp") < F.lit("2024-03-01")
    lake.overwrite(bronze.where(on_time), medallion.BRONZE_TRAFFIC)
    first = {r.target: r for r in medallion.build_models(lake, late_rows=True)}
    lake.append(bronze.where(~on_time), medallion.BRONZE_TRAFFIC)
    second = {r.target: r for r in medallion.build_models(lake, late_rows=True)}
    assert first[medallion.FACT_TRAFFIC_MODEL].rows == -1 and second[medallion.FACT_TRAFFIC_MODEL].rows > 0
    full = medallion._traffic_model(lake.read("staging.stg_traffic"))
    columns = [c for c in full.columns if c not in ("dbt_updated_at",)]
    got = lake.read(medallion.FACT_TRAFFIC_MODEL)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, full.select(columns).collect()))
