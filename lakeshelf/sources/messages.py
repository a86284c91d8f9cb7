"""Message topics: the Kafka readers and decoding of the message envelope."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeshelf.operators.mapping import _quoted

# Columns every reader of this module delivers, as the Kafka source names them.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

CORRUPT = "_corrupt_message"


def _kafka(reader, servers: str, topics: Sequence[str], options: dict[str, str]):
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        **options,
    }
    return reader.format("kafka").options(**settings)


def starting_at(topics: Sequence[str], progress: Sequence[tuple[str, int, int]]) -> dict[str, str]:
    """The option that starts each (topic, partition) at its next offset. All of ``topics`` must have been
    read before; a partition that was added since makes the source fail, and is not passed over."""
    known: dict[str, dict[str, int]] = {t: {} for t in topics}
    for topic, partition, following in progress:
        if topic in known:
            known[topic][str(partition)] = following
    return {"startingOffsets": json.dumps(known), "failOnDataLoss": "true"}


def read_topics(spark: SparkSession, servers: str, topics: Sequence[str], **options: str) -> DataFrame:
    """Everything the topics hold now. Needs the Kafka connector on the class path.

    ``minPartitions`` splits large topic partitions over more tasks.
    """
    return _kafka(spark.read, servers, topics, {"endingOffsets": "latest", **options}).load()


def stream_topics(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    batch_size: int = 100,
    flush_seconds: int = 30,
    **options: str,
) -> DataFrame:
    """The topics as a stream. A micro-batch starts at ``batch_size`` messages or after
    ``flush_seconds``, whichever comes first, and takes all that is there by then."""
    flush = {"minOffsetsPerTrigger": str(batch_size), "maxTriggerDelay": f"{flush_seconds}s"}
    return _kafka(spark.readStream, servers, topics, {**flush, **options}).load()


def decode(envelope: DataFrame, fields: T.StructType | str) -> DataFrame:
    """Topic, partition, offset, key and time, with the JSON fields of the value as columns.

    A field with the name of one of the first five replaces it. A value that is no JSON
    object keeps its text in ``_corrupt_message`` and has null fields.
    """
    ddl = fields if isinstance(fields, str) else ", ".join(
        f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields.fields
    )
    names = [f.name for f in T.StructType.fromDDL(ddl).fields]
    text = F.col("value").cast("string")
    parsed = F.from_json(
        text, f"{ddl}, {CORRUPT} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    meta = {
        "kafka_topic": F.col("topic"),
        "kafka_partition": F.col("partition"),
        "kafka_offset": F.col("offset"),
        "kafka_key": F.col("key").cast("string"),
        "kafka_timestamp": F.col("timestamp"),
    }
    kept = [c.alias(n) for n, c in meta.items() if n not in names]
    carried = envelope.select(*kept, text.alias("__text"), parsed.alias("__v"))
    broken = F.when(
        F.col("__v").isNull() | F.col(f"__v.{CORRUPT}").isNotNull(), F.coalesce(F.col("__text"), F.lit(""))
    )
    values = [F.col(f"__v.{_quoted(n)}").alias(n) for n in names]
    return carried.select(*[n for n in meta if n not in names], *values, broken.alias(CORRUPT))
