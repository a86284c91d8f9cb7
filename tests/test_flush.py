"""Batches by number or by time: none too large, none left behind, the same on a replay."""

import os
import time

import pytest
from pyspark.sql import functions as F

from lakeshelf.streaming import flush, topic_log


def messages(spark, *spans):
    rows = [(f"k{o}".encode(), None if o % 5 == 0 else b"v", t, p, o) for t, p, a, b in spans for o in range(a, b)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    return df.withColumn("timestamp", F.when(F.col("offset") % 3 > 0, F.timestamp_seconds(1_700_000_000 + F.col("offset"))))


def started(spark, tmp_path, trigger, **options):
    stream = flush.flush_batches(topic_log.stream_log(spark, str(tmp_path / "log")), **options)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(**trigger).start(out)
    return query, lambda: spark.read.schema(stream.schema).parquet(out)


def batches(df):
    """(topic, partition, number) -> (offsets, reason)"""
    found = {}
    for r in df.collect():
        offsets, reason, size = found.setdefault((r["topic"], r["partition"], r["batch_no"]), ([], r["reason"], r["batch_size"]))
        offsets.append(r["offset"])
        assert (reason, size) == (r["reason"], r["batch_size"])
    return {k: (sorted(o), reason) for k, (o, reason, size) in found.items() if len(o) == size}


def test_scheduled_runs_hold_nothing_back(spark, tmp_path):
    log = str(tmp_path / "log")
    topic_log.land(messages(spark, ("a", 0, 0, 25), ("a", 1, 0, 10), ("b", 0, 0, 3)), log)
    for _ in range(2):
        query, read = started(spark, tmp_path, {"availableNow": True}, batch_size=10, flush_seconds=0)
        query.awaitTermination()
        topic_log.land(messages(spark, ("a", 0, 25, 31)), log) if _ == 0 else None
    found = batches(read())
    assert found == {
        ("a", 0, 0): ([*range(10)], "full"), ("a", 0, 1): ([*range(10, 20)], "full"), ("a", 0, 2): ([*range(20, 25)], "end"),
        ("a", 0, 3): ([*range(25, 31)], "end"), ("a", 1, 0): ([*range(10)], "full"), ("b", 0, 0): ([0, 1, 2], "end"),
    }
    sent = {(r["offset"], r["key"], r["value"], r["timestamp"]) for r in messages(spark, ("b", 0, 0, 3)).collect()}
    assert {(r["offset"], r["key"], r["value"], r["timestamp"]) for r in read().where("topic = 'b'").collect()} == sent


def test_messages_are_held_between_runs_and_a_replay_gives_the_same(spark, tmp_path):
    log = str(tmp_path / "log")
    topic_log.land(messages(spark, ("a", 0, 0, 25)), log)
    query, read = started(spark, tmp_path, {"availableNow": True}, batch_size=10, flush_seconds=3600)
    query.awaitTermination()
    assert batches(read()) == {("a", 0, 0): ([*range(10)], "full"), ("a", 0, 1): ([*range(10, 20)], "full")}
    topic_log.land(messages(spark, ("a", 0, 25, 36)), log)
    query, read = started(spark, tmp_path, {"availableNow": True}, batch_size=10, flush_seconds=3600)
    query.awaitTermination()
    once = batches(read())
    assert once[("a", 0, 2)] == ([*range(20, 30)], "full") and len(once) == 3
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    os.remove(commits[-1])  # the last micro-batch runs again
    crc = commits[-1].with_name(f".{commits[-1].name}.crc")
    crc.unlink(missing_ok=True)
    query, read = started(spark, tmp_path, {"availableNow": True}, batch_size=10, flush_seconds=3600)
    query.awaitTermination()
    assert batches(read()) == once and read().count() == 30


def test_the_rest_leaves_when_its_time_is_up(spark, tmp_path):
    topic_log.land(messages(spark, ("a", 0, 0, 14)), str(tmp_path / "log"))
    query, read = started(spark, tmp_path, {"processingTime": "500 milliseconds"}, batch_size=10, flush_seconds=1)
    try:
        until = time.time() + 90
        while time.time() < until and (not os.path.isdir(tmp_path / "out") or len(batches(read())) < 2):
            time.sleep(0.5)
    finally:
        query.stop()
    assert batches(read()) == {("a", 0, 0): ([*range(10)], "full"), ("a", 0, 1): ([*range(10, 14)], "time")}


def test_lanes_split_a_hot_partition(spark, tmp_path):
    topic_log.land(messages(spark, ("a", 0, 0, 40)), str(tmp_path / "log"))
    query, read = started(spark, tmp_path, {"availableNow": True}, batch_size=10, flush_seconds=0, lanes=4)
    query.awaitTermination()
    got = {(r["lane"], r["batch_no"]): r["n"] for r in read().groupBy("lane", "batch_no").agg(F.count("*").alias("n")).collect()}
    assert got == {(k, 0): 10 for k in range(4)}


def test_options(spark):
    for wrong in ({"batch_size": 0}, {"flush_seconds": -1}, {"lanes": 0}):
        with pytest.raises(ValueError):
            flush.flush_batches(messages(spark, ("a", 0, 0, 1)), **wrong)
