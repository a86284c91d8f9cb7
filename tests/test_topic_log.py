"""Landed topic logs: every message once, whatever the number of runs, tasks and partitions."""

import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakeshelf.streaming import topic_log


def messages(spark, *spans):
    """(topic, partition, first offset, end offset) each."""
    rows = [(f"k{o}".encode(), None if o % 7 == 0 else f"{t}{p}:{o}".encode(), t, p, o) for t, p, a, b in spans for o in range(a, b)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    return df.withColumn("timestamp", F.timestamp_seconds(1_700_000_000 + F.col("offset")))


@pytest.fixture()
def run(spark, tmp_path):
    def run(**options):
        out = str(tmp_path / "out")
        stream = topic_log.stream_log(spark, str(tmp_path / "log"), **options)
        query = (stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
                 .trigger(availableNow=True).start(out))
        query.awaitTermination()
        read = sum(p["numInputRows"] for p in query.recentProgress)
        return spark.read.schema(stream.schema).parquet(out), read
    return run


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_restart_reads_only_new_offsets_and_added_partitions_whole(spark, tmp_path, run):
    log = str(tmp_path / "log")
    first = messages(spark, ("a", 0, 5, 60), ("a", 1, 0, 3), ("b", 0, 0, 10))
    assert topic_log.land(first, log, segment_rows=20) == 68
    got, read = run(rowsPerTask="13")
    same(got, first)
    assert read == 68
    more = messages(spark, ("a", 0, 60, 75), ("a", 2, 100, 140), ("c", 0, 0, 4))
    topic_log.land(more, log, segment_rows=20)
    got, read = run(rowsPerTask="13")
    same(got, first.unionByName(more))
    assert read == 59
    assert run()[1] == 0
    same(topic_log.read_log(spark, log), first.unionByName(more))
    same(topic_log.read_log(spark, log, ["a"]).where("partition = 2"), more.where("topic = 'a' AND partition = 2"))


def test_gaps_in_offsets(spark, tmp_path, run):
    kept = messages(spark, ("a", 0, 0, 300)).where("offset % 50 < 3")
    topic_log.land(kept, str(tmp_path / "log"), segment_rows=4)
    same(run(rowsPerTask="10")[0], kept)


def test_a_large_partition_is_read_by_many_tasks(spark, tmp_path):
    log = str(tmp_path / "log")
    topic_log.land(messages(spark, ("a", 0, 0, 1000)).coalesce(1), log)
    df = topic_log.read_log(spark, log, rowsPerTask="100")
    assert df.rdd.getNumPartitions() == 10
    assert [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()] == [100] * 10


def test_deleted_offsets_are_an_error_unless_allowed(spark, tmp_path, run):
    log = str(tmp_path / "log")
    topic_log.land(messages(spark, ("a", 0, 0, 10)), log)
    run()
    topic_log.land(messages(spark, ("a", 0, 10, 30)).coalesce(1), log, segment_rows=10)
    for name in sorted(glob.glob(f"{log}/topic=a/partition=0/*"))[:-1]:
        os.remove(name)
    with pytest.raises(StreamingQueryException, match="deleted before they were read"):
        run()
    assert run(failOnDataLoss="false")[1] == 10


def test_unfinished_and_foreign_files_are_left_alone(spark, tmp_path, run):
    log = str(tmp_path / "log")
    topic_log.land(messages(spark, ("a", 0, 0, 10)), log)
    for name in ("00000000000000000010.part", "notes.parquet", "_SUCCESS"):
        (tmp_path / "log" / "topic=a" / "partition=0" / name).write_text("x")
    assert run()[0].count() == 10


def test_nothing_landed_yet(spark, tmp_path, run):
    assert run()[0].isEmpty() if os.path.isdir(tmp_path / "out") else True
    assert topic_log.read_log(spark, str(tmp_path / "log")).isEmpty()
    with pytest.raises(Exception, match="at least 1"):
        topic_log.read_log(spark, str(tmp_path / "log"), rowsPerTask="0").collect()
