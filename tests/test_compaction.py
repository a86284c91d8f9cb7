"""Compaction of the stored stream: the same rows in fewer files, also when batches are replayed or a run fails."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators import tables
from lakeshelf.streaming import bronze, compaction
from lakeshelf.workload import writes

TABLE = "bronze_e"


def write(lake, spark, number, day, n=3, label="x", mark=""):
    rows = [(None, json.dumps({"event_id": f"{label}{number}-{i}{mark}"}).encode(), "t", 0, number * 100 + i) for i in range(n)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long").repartition(2)
    df = df.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    bronze.batch_writer(lake, TABLE, label)(bronze.project(df, now=F.lit(f"{day} 10:00:00").cast("timestamp")), number)


def ids(lake, name=TABLE):
    return sorted((r["_batch_id"], r["event_id"], str(r["_ingestion_date"])) for r in lake.read(name).collect())


@pytest.fixture()
def stored(lake, spark):
    for number, day in enumerate(["2024-01-01"] * 3 + ["2024-01-02"] * 2 + ["2024-01-03"] * 2):
        write(lake, spark, number, day)
    return lake


def test_rows_stay_and_files_become_few(stored, spark):
    before = ids(stored)
    run = compaction.compact(stored, TABLE, date(2024, 1, 3))
    assert (run.batches, run.days, run.dropped) == (5, (date(2024, 1, 1), date(2024, 1, 2)), 0)
    assert run.files_before >= 5 and run.files_after == 2
    assert ids(stored, f"{TABLE}_all") == before
    assert stored.read(f"{TABLE}_all").columns == stored.columns(TABLE)
    again = compaction.compact(stored, TABLE, date(2024, 1, 3))
    assert (again.batches, again.dropped) == (0, 5)
    assert ids(stored, f"{TABLE}_all") == before and len(ids(stored)) == 6
    assert compaction.boundary(stored, TABLE) == {"x": 4}


def test_a_replayed_batch_changes_nothing(stored, spark):
    before = ids(stored)
    compaction.compact(stored, TABLE, date(2024, 1, 3), remove_now=True)
    write(stored, spark, 1, "2024-01-01")
    write(stored, spark, 4, "2024-01-02", mark="changed")
    assert ids(stored, f"{TABLE}_all") == before
    assert compaction.compact(stored, TABLE, date(2024, 1, 3)).dropped == 2
    assert ids(stored, f"{TABLE}_all") == before


def test_the_newest_batch_stays_open_and_joins_its_day_later(stored, spark):
    compaction.compact(stored, TABLE, date(2024, 2, 1))
    assert compaction.boundary(stored, TABLE) == {"x": 5}
    write(stored, spark, 6, "2024-01-03", mark="again")  # the replay of an unfinished batch
    write(stored, spark, 7, "2024-01-04")
    write(stored, spark, 0, "2024-01-04", label="other intake_a'b")
    want = ids(stored)
    assert ids(stored, f"{TABLE}_all") == want and sum("again" in r[1] for r in want) == 3
    run = compaction.compact(stored, TABLE, date(2024, 2, 1), remove_now=True)
    assert run.batches == 1 and run.days == (date(2024, 1, 3),) and run.files_after == 1
    assert ids(stored, f"{TABLE}_all") == want


def test_a_failed_run_is_repeated(stored, spark, monkeypatch):
    before = ids(stored)
    compaction.compact(stored, TABLE, date(2024, 1, 2))
    replace = compaction._replace_view

    def fail(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(compaction, "_replace_view", fail)
    with pytest.raises(RuntimeError):
        compaction.compact(stored, TABLE, date(2024, 1, 3))
    assert ids(stored, f"{TABLE}_all") == before  # what it wrote is behind the boundary
    monkeypatch.setattr(compaction, "_replace_view", replace)
    compaction.compact(stored, TABLE, date(2024, 1, 3), remove_now=True)
    assert ids(stored, f"{TABLE}_all") == before


def test_a_large_day_is_several_files(stored, spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        for number in range(7, 12):
            write(stored, spark, number, "2024-01-03", n=300)
        before = ids(stored)
        run = compaction.compact(stored, TABLE, date(2024, 1, 4), remove_now=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert ids(stored, f"{TABLE}_all") == before and run.files_after > 3


def test_closed_batches_are_not_read_from_the_open_table(stored, spark):
    compaction.compact(stored, TABLE, date(2024, 1, 3))
    plan = stored.read(f"{TABLE}_all").where("_ingestion_date = DATE'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters") == 2 and "regexp_extract(_batch_id" in plan.split("PartitionFilters")[1].split("]")[0]


def test_empty_open_table(lake, spark):
    write(lake, spark, 0, "2024-01-01")
    assert compaction.compact(lake, TABLE, date(2024, 1, 1)).batches == 0
    assert ids(lake, f"{TABLE}_all") == ids(lake) and tables.qualify(TABLE) == "bronze.bronze_e"


def test_ordered_messages_of_a_batch_are_spread_over_tasks(spark, tmp_path, monkeypatch):
    """The table is in the order of its ids, so a batch lies in one of its splits."""
    ids = spark.range(0, 16_000, 1, 8).withColumnRenamed("id", "event_id")
    ids.select("event_id", F.col("event_id").alias("user_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts")).write.parquet(
        str(tmp_path / "events.parquet"))
    spread, make = {}, bronze.batch_writer

    def batch_writer(lake, table, label):
        write = make(lake, table, label)

        def counted(batch, number):
            spread.setdefault(number, []).append([r["count"] for r in batch.groupBy(F.spark_partition_id()).count().collect()])
            write(batch, number)

        return counted

    monkeypatch.setattr(bronze, "batch_writer", batch_writer)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        got = {r["event_id"]: (r["_batch_id"], r["compacted"]) for r in writes.stream_compacted_days(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert got == {str(i): (f"taken_{i // 2000}", i // 2000 < 4) for i in range(16_000)}
    assert {k: [sum(n) for n in runs] for k, runs in spread.items()} == {k: [2000] * (1 + (k == 0)) + [1000] * (k == 3) for k in range(8)}
    assert all(max(n) < 0.6 * sum(n) for runs in spread.values() for n in runs)
