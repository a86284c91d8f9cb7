import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeshelf.plans import gold, silver
from lakeshelf.sources import messages
from lakeshelf.streaming import bronze, windows


def envelopes(spark, *values, first=0):
    rows = [(None, v if isinstance(v, bytes) else json.dumps(v).encode(), "t", 0, first + i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    return df.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def intake(lake, landed, checkpoint):
    source = lake.spark.readStream.schema(messages.ENVELOPE).parquet(landed)
    bronze.start(lake, source, checkpoint, "bronze_e", once=True).awaitTermination()


def test_intake_restart_and_quarantine(lake, spark, tmp_path):
    landed, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    envelopes(spark, {"event_id": "a", "value": "x"}, b"{bad").write.parquet(landed)
    intake(lake, landed, checkpoint)
    envelopes(spark, {"timestamp": "2024-01-01T00:00:00Z", "payload": {"k": 1}}, first=2).write.mode("append").parquet(landed)
    intake(lake, landed, checkpoint)
    intake(lake, landed, checkpoint)
    rows = {r["kafka_offset"]: r for r in lake.read("bronze_e").collect()}
    assert sorted(rows) == [0, 2]
    assert (rows[0]["event_id"], rows[0]["event_type"], rows[0]["metric_value"], rows[0]["raw_payload"]) == ("a", "unknown", None, "{}")
    assert rows[0]["event_timestamp"] == rows[0]["_ingestion_timestamp"]
    assert len(rows[2]["event_id"]) == 32 and rows[2]["raw_payload"] == '{"k":1}'
    assert rows[0]["_batch_id"] != rows[2]["_batch_id"]
    assert [r["raw_text"] for r in lake.read("bronze_e_quarantine").collect()] == ["{bad"]
    assert set(lake.columns("bronze_e")) == set(bronze.BRONZE_COLUMNS)


def test_a_replayed_batch_changes_nothing(lake, spark):
    write = bronze.batch_writer(lake, "bronze_e", "x")
    now = F.lit("2024-01-01 10:00:00").cast("timestamp")
    first = bronze.project(envelopes(spark, {"event_id": "a"}, {}), now=now)
    write(first, 0)
    write(bronze.project(envelopes(spark, {"event_id": "b"}, first=5), now=now), 1)
    before = sorted(map(str, lake.read("bronze_e").collect()))
    write(first, 0)
    assert sorted(map(str, lake.read("bronze_e").collect())) == before and len(before) == 3


def events(spark, *rows):
    base = datetime(2024, 1, 1)
    data = [(str(i), "order_x", f"s{s}", "l", 1.0, 2.0, base + timedelta(minutes=m), float(m), "u", "t", 0, n)
            for n, (i, s, m) in enumerate(rows)]
    df = spark.createDataFrame(
        data, "event_id string, event_type string, sensor_id string, location_id string, latitude double, longitude double, "
        "event_timestamp timestamp, metric_value double, metric_unit string, kafka_topic string, kafka_partition int, kafka_offset long")
    return df.withColumns({"_ingestion_timestamp": F.col("event_timestamp"), "_source_id": F.lit("s")})


@pytest.fixture()
def run_stream(spark, tmp_path):
    def run(df, transform):
        where = str(tmp_path / "stream-in")
        df.write.parquet(where)
        out = transform(spark.readStream.schema(df.schema).parquet(where))
        query = (out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
                 .trigger(availableNow=True).start(str(tmp_path / "out")))
        query.awaitTermination()
        return spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    return run


def test_only_closed_hours_are_emitted(spark, run_stream):
    df = events(spark, (1, 1, 5), (2, 1, 10), (3, 2, 59), (4, 1, 65), (5, 1, 185))
    got = {r["hour_key"].hour: r for r in run_stream(df, windows.hourly_events).collect()}
    assert sorted(got) == [0, 1]
    assert (got[0]["event_count"], got[0]["unique_sensors"], got[0]["max_metric_value"]) == (3, 2, 59.0)
    batch = windows.hourly_events(df)
    assert batch.count() == 3


def test_hours_are_exact_and_equal_the_batch_fact(spark, run_stream):
    rows = [(i, i % 97, i % 170) for i in range(900)] + [(901, 1, 400), (902, 1, 700)]
    df = events(spark, *rows).withColumns({
        "sensor_id": F.when(F.col("kafka_offset") % 11 > 0, F.col("sensor_id")),
        "location_id": F.concat(F.lit("l"), (F.col("kafka_offset") % 37).cast("string")),
        "metric_value": F.when(F.col("kafka_offset") % 5 > 0, F.col("metric_value")),
        "event_type": F.when(F.col("kafka_offset") % 2 > 0, "vehicle").otherwise("order"),
        "kafka_topic": F.when(F.col("kafka_offset") % 3 > 0, F.lit("t")),
    })
    want = gold.fact_stream_events_hourly(silver.silver_stream_events(df)).where("hour_key < '2024-01-01 10:00:00'")
    got = run_stream(df.repartition(3), windows.hourly_events)
    for found in (got, windows.hourly_events(df).where("hour_key < '2024-01-01 10:00:00'")):
        found = found.select(want.columns).withColumn("avg_metric_value", F.round("avg_metric_value", 9))
        assert sorted(map(str, found.collect())) == sorted(map(str, want.withColumn("avg_metric_value", F.round("avg_metric_value", 9)).collect()))


def test_repeats_are_dropped(spark, run_stream):
    df = events(spark, (1, 1, 5), (1, 1, 6), (2, 1, 7))
    assert sorted(r["event_id"] for r in run_stream(df, windows.first_of_each_event).collect()) == ["1", "2"]


def test_freshness(spark):
    df = events(spark, (1, 1, 0), (2, 1, 55))
    row = bronze.freshness(df, F.lit("2024-01-01 01:00:00").cast("timestamp")).first()
    assert (row["total_events"], row["event_types"]) == (1, 1)
