"""Messages to the bronze event table.

Exactly once by replay: the files of a micro-batch live in partitions named after its
batch id, and a batch that runs again replaces them. All values of a row are the same on
a replay: the ingestion time is the batch time Spark keeps in its offset log, and a
missing event id is derived from the message position.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakeshelf.functions import number_of
from lakeshelf.operators.filters import recent
from lakeshelf.operators.tables import Lake
from lakeshelf.sources import messages

# Message fields and what they are called in the bronze table, the
# defaults of absent fields, and the names the intake writes.
MESSAGE_FIELDS = (
    "event_id", "event_type", "sensor_id", "location_id", "latitude", "longitude", "timestamp", "value", "unit",
    "payload",
)
UNKNOWN_TYPE = "unknown"
EMPTY_PAYLOAD = "{}"
STREAM_SOURCE_ID = "urban_events_kafka"
STREAM_SOURCE_TYPE = "kafka"
BRONZE_EVENTS = "bronze.bronze_urban_stream_events"
BRONZE_COLUMNS = (
    "event_id", "event_type", "sensor_id", "location_id", "latitude", "longitude", "event_timestamp",
    "metric_value", "metric_unit", "kafka_topic", "kafka_partition", "kafka_offset", "raw_payload",
    "_ingestion_timestamp", "_ingestion_date", "_source_id", "_source_type", "_batch_id",
)

PARTITIONS = ("_ingestion_date", "_batch_id")


def message_position_id() -> Column:
    """An id that a message keeps however often it is read."""
    place = F.concat_ws("|", "kafka_topic", F.col("kafka_partition").cast("string"), F.col("kafka_offset").cast("string"))
    return F.md5(place)


def project(envelope: DataFrame, batch_id: Column | None = None, now: Column | None = None) -> DataFrame:
    """Envelope to the 18 bronze columns, plus ``_corrupt_message`` for the caller to split on.

    Every field is read as text first and cast tolerantly, so one odd value does not
    make the whole message unreadable.
    """
    now = F.current_timestamp() if now is None else now
    text_fields = T.StructType([T.StructField(name, T.StringType()) for name in MESSAGE_FIELDS])
    decoded = messages.decode(envelope, text_fields)

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    def number(name: str) -> Column:
        return number_of(F.col(name))

    return decoded.select(
        F.coalesce(F.col("event_id"), message_position_id()).alias("event_id"),
        text("event_type", UNKNOWN_TYPE).alias("event_type"),
        text("sensor_id", "").alias("sensor_id"),
        text("location_id", "").alias("location_id"),
        number("latitude").alias("latitude"),
        number("longitude").alias("longitude"),
        F.coalesce(F.col("timestamp").try_cast("timestamp"), now).alias("event_timestamp"),
        number("value").alias("metric_value"),
        text("unit", "").alias("metric_unit"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        text("payload", EMPTY_PAYLOAD).alias("raw_payload"),
        now.alias("_ingestion_timestamp"),
        F.to_date(now).alias("_ingestion_date"),
        F.lit(STREAM_SOURCE_ID).alias("_source_id"),
        F.lit(STREAM_SOURCE_TYPE).alias("_source_type"),
        (F.lit(None).cast("string") if batch_id is None else batch_id).alias("_batch_id"),
        messages.CORRUPT,
    )


def batch_writer(lake: Lake, table: str, label: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: good rows to ``table``, broken messages beside it."""
    quarantine = f"{table}_quarantine"

    def write(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("_batch_id", F.lit(f"{label}_{batch_id}"))
        named.persist()
        try:
            broken = F.col(messages.CORRUPT).isNotNull()
            # a batch is one partition, which its tasks write side by side
            lake.overwrite_partitions(
                named.where(~broken).select(*BRONZE_COLUMNS), table, PARTITIONS, rebalance=False
            )
            bad = named.where(broken).select(
                F.col(messages.CORRUPT).alias("raw_text"), "kafka_topic", "kafka_partition", "kafka_offset",
                "_ingestion_timestamp", *PARTITIONS,
            )
            lake.overwrite_partitions(bad, quarantine, PARTITIONS, rebalance=False)
        finally:
            named.unpersist()

    return write


def start(
    lake: Lake,
    envelopes: DataFrame,
    checkpoint: str,
    table: str = BRONZE_EVENTS,
    label: str = STREAM_SOURCE_ID,
    once: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start the intake of a streaming frame of message envelopes.

    ``once`` drains what is there and stops (a scheduled run); otherwise it runs on,
    at the pace of ``every`` or of the source. ``query.stop()`` ends it between batches;
    an unfinished batch is replayed at the next start. Give each checkpoint its own label.
    """
    writer = (
        project(envelopes)
        .writeStream.queryName(f"{label}_intake")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch_writer(lake, table, label))
    )
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def freshness(events: DataFrame, now: Column, minutes: int = 10) -> DataFrame:
    """One row on the events taken in during the last minutes."""
    return events.where(recent(F.col("_ingestion_timestamp"), now, minutes=minutes)).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.max("event_timestamp").alias("latest_event"),
        F.min("event_timestamp").alias("oldest_event"),
        F.count_distinct("event_type").alias("event_types"),
    )
