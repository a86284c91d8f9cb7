"""Round trips: the tables are written by a sink, a stream or as files, and read back.

Everything is put below the shared scratch folder of the session, in a new place for
every call; catalog entries are dropped again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeshelf.operators import audit, incremental, quality
from lakeshelf.operators.tables import LAYERS, Lake
from lakeshelf.plans import gold
from lakeshelf.plans.staging import stg_traffic
from lakeshelf.session import scratch_path
from lakeshelf.sources import files, messages
from lakeshelf.sources.ingest import Ingestor
from lakeshelf.sources.spec import SourceSpec
from lakeshelf.streaming import bronze, compaction, flush, topic_log, windows
from lakeshelf.workload import checks, ingest, tables as t
from lakeshelf.workload.registry import TWINS, query
from lakeshelf.workload.sql import with_ctes


def with_lake(spark: SparkSession, table: str, work: Callable[[Lake], None]) -> DataFrame:
    """Let ``work`` fill a table of a scratch lake; returns the table's rows."""
    lake = Lake(spark, scratch_path(spark, "lake"), f"scratch_{uuid.uuid4().hex}_")
    lake.create_layers()
    try:
        work(lake)
        where, schema = lake.location(table), lake.read(table).schema
    finally:
        # the tables are external: their files stay
        for layer in LAYERS:
            spark.sql(f"DROP DATABASE {lake.namespace}{layer} CASCADE")
    return spark.read.schema(schema).parquet(where)


# ---- files ----------------------------------------------------------------


@query("scan_csv_by_name", """
SELECT o_orderkey, o_totalprice, o_orderstatus,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def scan_csv_by_name(spark, sf_dir):
    """Two sets of CSV files with different headers, one set lacking a column."""
    where = scratch_path(spark, "csv")
    orders = t.table(spark, sf_dir, "orders")
    done = F.col("o_orderstatus") == "F"
    orders.where(~done).select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority").write.csv(
        f"{where}/a", header=True)
    orders.where(done).select("o_orderstatus", "o_orderkey", "o_totalprice").write.csv(f"{where}/b", header=True)
    raw = files.read_files(spark, where, "*.csv", recursive=True)
    return raw.select(
        F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"), "o_orderstatus", "o_orderpriority"
    )


@query("scan_csv_skip_rows", "SELECT c_custkey, c_name FROM customer")
def scan_csv_skip_rows(spark, sf_dir):
    """Two preamble lines before the header of every file."""
    where = scratch_path(spark, "skip")
    lines = t.table(spark, sf_dir, "customer").select(
        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value")
    )

    def with_preamble(batches):
        yield pd.DataFrame({"value": ["made by hand", "not data", "c_custkey,c_name"]})
        yield from batches

    # one task writes one file, and its rows in order
    lines.mapInPandas(with_preamble, "value string").write.text(where)
    options = files.FileOptions(skip_rows=2)
    raw = files.read_files(spark, where, "*.txt", options=options)
    return raw.select(F.col("c_custkey").cast("bigint"), "c_name")


@query("scan_json_lines", "SELECT event_id, event_type, value FROM events")
def scan_json_lines(spark, sf_dir):
    where = scratch_path(spark, "json")
    t.table(spark, sf_dir, "events").select("event_id", "event_type", "value").write.json(where)
    options = files.FileOptions(json_lines=True, schema="event_id string, event_type string, value string")
    raw = files.read_files(spark, where, "*.json", "json", options=options)
    return raw.select(F.col("event_id").cast("bigint"), "event_type", F.col("value").cast("double"))


@query("ingest_csv_source", TWINS["map_full"])
def ingest_csv_source(spark, sf_dir):
    """A file source run from its spec: read, map, add audit columns, write, record."""
    landed = scratch_path(spark, "landed")
    ingest.raw_traffic(spark, sf_dir).write.csv(landed, header=True)
    spec = SourceSpec.from_dict({
        "source_id": "traffic_files", "source_type": "file", "format": "csv",
        "file": {"base_path": landed, "pattern": "*.csv"},
        "target": {"table": "bronze_traffic_files", "partition_by": "ingestion_date"},
        "schema_mapping": ingest.TRAFFIC_MAPPING,
    })
    stored = with_lake(spark, "bronze_traffic_files", lambda lake: Ingestor(lake, [spec]).run_source("traffic_files"))
    names = [r["target"] for r in ingest.TRAFFIC_MAPPING.values()]
    return t.as_ntz(stored.select(*names, "station"))


# ---- sinks ----------------------------------------------------------------


@query("sink_append_by_name", """
SELECT s_suppkey AS "key", s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT c_custkey, c_name, NULL FROM customer""")
def sink_append_by_name(spark, sf_dir):
    sellers = t.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    buyers = t.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("key"))

    def work(lake: Lake) -> None:
        lake.append(sellers, "bronze_parties")
        lake.append(buyers, "bronze_parties")

    return with_lake(spark, "bronze_parties", work)


def _status_rows(spark, sf_dir, status: str | None = None) -> DataFrame:
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return orders.where(F.col("o_orderstatus") == status) if status else orders


@query("sink_overwrite_partitions", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
       o_orderstatus FROM orders""")
def sink_overwrite_partitions(spark, sf_dir):
    """One partition is replaced, twice; the others stay."""

    def work(lake: Lake) -> None:
        lake.overwrite(_status_rows(spark, sf_dir), "silver_orders", ["o_orderstatus"])
        negated = _status_rows(spark, sf_dir, "P").withColumn("o_totalprice", -F.col("o_totalprice"))
        for _ in range(2):
            lake.overwrite_partitions(negated, "silver_orders", ["o_orderstatus"])

    return with_lake(spark, "silver_orders", work)


def _traffic_model(df: DataFrame) -> DataFrame:
    return incremental.with_month(gold.fact_traffic_hourly_model(df))


def _load_traffic(lake: Lake, source: DataFrame, lookback_days: int | None = None) -> int:
    return incremental.load(
        lake, "gold_traffic", source, _traffic_model, "event_hour", "hour_key", "date_key", "month_key",
        lookback_days, "event_timestamp",
    )


def _staged_traffic(spark, sf_dir) -> DataFrame:
    return stg_traffic(t.bronze_traffic(spark, sf_dir))


_FULL_MODEL = with_ctes("SELECT * FROM g_traffic_model", "g_traffic_model")


@query("incremental_load_twice", _FULL_MODEL)
def incremental_load_twice(spark, sf_dir):
    """Up to an hour, then the rest, then the same again: equal to one full load."""
    source = _staged_traffic(spark, sf_dir)

    def work(lake: Lake) -> None:
        _load_traffic(lake, source.where(F.col("event_hour") < F.lit("2024-01-20 07:00:00").cast("timestamp")))
        for _ in range(2):
            _load_traffic(lake, source)

    return t.as_ntz(with_lake(spark, "gold_traffic", work).drop("month_key"))


@query("incremental_lookback", _FULL_MODEL)
def incremental_lookback(spark, sf_dir):
    """The first load misses rows of its last days; the look-back brings them in."""
    source = _staged_traffic(spark, sf_dir)
    early = source.where(F.col("event_hour") < F.lit("2024-01-20 07:30:00").cast("timestamp"))
    incomplete = early.where(
        (F.col("event_date") < F.lit("2024-01-19").cast("date")) | (F.col("weather_condition") != "CLICK"))

    def work(lake: Lake) -> None:
        _load_traffic(lake, incomplete)
        _load_traffic(lake, source, lookback_days=1)

    return t.as_ntz(with_lake(spark, "gold_traffic", work).drop("month_key"))


_BY_HOUR = incremental.Groups(
    "event_hour", "hour_key", "month_key", lambda hour: F.trunc(hour, "month"), "event_date", F.to_date, "event_timestamp")


@query("incremental_late_rows", _FULL_MODEL)
def incremental_late_rows(spark, sf_dir):
    """Rows arrive in three runs, some weeks late: only their hours are computed again, and the fact equals a full build."""
    late = F.when(F.col("traffic_volume") % 11 == 0, F.lit("2024-05-01")).when(F.col("traffic_volume") % 7 == 0, F.lit("2024-04-01"))
    arrival = F.coalesce(late.cast("timestamp"), F.col("event_timestamp").cast("timestamp"))
    source = _staged_traffic(spark, sf_dir).withColumn("_ingestion_timestamp", arrival)

    def work(lake: Lake) -> None:
        lake.overwrite(source.where("_ingestion_timestamp < '2024-04-01'"), "silver_staged", ["event_date"])
        for day in ("2024-04-01", "2024-05-01", None):
            incremental.refresh_groups(lake, "gold_traffic", lake.read("silver_staged"), _traffic_model, _BY_HOUR)
            if day:
                lake.append(source.where(F.col("_ingestion_timestamp") == F.lit(day).cast("timestamp")), "silver_staged")

    return t.as_ntz(with_lake(spark, "gold_traffic", work).drop("month_key"))


@query("replace_by_key", """
SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def replace_by_key(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", F.trunc("o_orderdate", "year").alias("year_start"), "o_totalprice")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", F.trunc("o_orderdate", "year").alias("year_start"), (F.col("o_totalprice") * 2).alias("o_totalprice"))

    def work(lake: Lake) -> None:
        lake.overwrite(rows, "gold_orders", ["year_start"])
        incremental.replace_by_key(lake, "gold_orders", urgent, ["o_orderkey", "year_start"], "year_start")

    return with_lake(spark, "gold_orders", work)


@query("schema_sync", """
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS VARCHAR) AS p_brand FROM part
UNION ALL SELECT p_partkey, p_size, p_brand FROM part""")
def schema_sync(spark, sf_dir):
    """The second load has a new column, lacks one, and widens one."""
    part = t.table(spark, sf_dir, "part")
    old = part.select("p_partkey", "p_size", "p_retailprice")
    new = part.select("p_partkey", F.col("p_size").cast("bigint").alias("p_size"), "p_brand")

    def work(lake: Lake) -> None:
        lake.overwrite(old, "gold_part")
        incremental.sync_columns(lake, "gold_part", new)
        lake.append(new, "gold_part")

    return with_lake(spark, "gold_part", work)


@query("quality_audit_append", with_ctes(checks._REPORT, *checks._REPORT_CTES))
def quality_audit_append(spark, sf_dir):
    def work(lake: Lake) -> None:
        audit.create_audit_tables(lake)
        audit.record_checks(lake, checks._suite(spark, sf_dir))

    return with_lake(spark, audit.QUALITY_AUDIT, work).select(*checks._KEPT)


# ---- streams --------------------------------------------------------------


def _stream_of(df: DataFrame, label: str) -> DataFrame:
    """A file stream over the rows of ``df``."""
    stored = scratch_path(df.sparkSession, label)
    df.write.parquet(stored)
    return df.sparkSession.readStream.schema(df.schema).parquet(stored)


def _drained(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is there, into files; returns them."""
    spark = stream.sparkSession
    out = scratch_path(spark, label)
    running = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", scratch_path(spark, f"{label}-checkpoint"))
        .trigger(availableNow=True).start(out)
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


_STORED = [c for c in bronze.BRONZE_COLUMNS if not c.startswith("_ingestion") and c not in ("_batch_id", "event_timestamp")]


@query("stream_intake", f"""
SELECT {', '.join(_STORED)}, event_timestamp FROM ({TWINS['stream_bronze_projection'].replace(
    f"ELSE TIMESTAMP '{ingest._NOW}' END AS event_timestamp", "END AS event_timestamp")})
WHERE kafka_offset % 50 <> 0""")
def stream_intake(spark, sf_dir):
    """Messages through the intake, in two runs of one checkpoint; every fiftieth is
    broken and goes to quarantine. Times filled in by the intake are blanked."""
    i = F.col("event_id")
    body = F.when(i % 50 == 0, F.lit('{"event_id": ')).otherwise(ingest.stream_bodies())
    stored = scratch_path(spark, "envelopes")
    both = ingest.envelopes(spark, sf_dir, body)
    checkpoint = scratch_path(spark, "intake-checkpoint")

    def work(lake: Lake) -> None:
        for topics in (["topic_0", "topic_1"], ["topic_2", "topic_3"]):
            both.where(F.col("topic").isin(topics)).write.mode("append").parquet(stored)
            source = spark.readStream.schema(messages.ENVELOPE).parquet(stored)
            bronze.start(lake, source, checkpoint, "bronze_intake", once=True).awaitTermination()

    taken = with_lake(spark, "bronze_intake", work)
    sent = F.when(F.col("kafka_offset") % 9 != 0, F.col("event_timestamp")).alias("event_timestamp")
    return t.as_ntz(taken.select(*_STORED, sent))


@query("stream_hourly_windows", with_ctes("""
SELECT * REPLACE (round(avg_metric_value, 8) AS avg_metric_value)
FROM g_events WHERE hour_key + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""", "g_events"))
def stream_hourly_windows(spark, sf_dir):
    """Closed hours of an event stream with all measures; the last hours stay open behind the watermark."""
    stream = _stream_of(t.bronze_events(spark, sf_dir), "windows-in")
    counted = _drained(windows.hourly_events(stream), "windows-out")
    return t.as_ntz(counted.withColumn("avg_metric_value", F.round("avg_metric_value", 8)))


@query("stream_deduplicate", "SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp FROM events")
def stream_deduplicate(spark, sf_dir):
    """Every event is sent twice, and counts once."""
    events = t.bronze_events(spark, sf_dir).select(
        "event_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("sent"))
    stream = _stream_of(events, "dedup-in")
    return t.as_ntz(_drained(windows.first_of_each_event(stream).drop("sent"), "dedup-out"))


def _topic_messages(spark, sf_dir) -> DataFrame:
    """The events as messages whose offsets run within each topic and partition."""
    sent = ingest.envelopes(spark, sf_dir, F.to_json(F.struct("event_id", "event_type", "ts")))
    return sent.withColumn("offset", F.floor(F.col("offset") / 12).cast("long"))  # 4 topics, 3 partitions


@query("stream_topic_log", """
SELECT 'topic_' || CAST(event_id % 4 AS VARCHAR) AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 12 AS "offset",
       CAST(user_id AS VARCHAR) AS key, event_id, event_type, ts AS "timestamp",
       CASE WHEN event_id % 3 = 2 OR event_id % 4 = 3 OR event_id // 12 > (SELECT max(event_id) // 24 FROM events) THEN 2 ELSE 1 END AS run
FROM events""")
def stream_topic_log(spark, sf_dir):
    """Landed topic logs as a stream, in two runs of one checkpoint; a partition of every topic, and a topic, come
    with the second. Each message is read once, by the run in which it was new."""
    sent, log = _topic_messages(spark, sf_dir), scratch_path(spark, "topics")
    out, checkpoint = scratch_path(spark, "topics-out"), scratch_path(spark, "topics-checkpoint")
    half = F.col("offset") <= F.floor(sent.agg(F.max("offset")).scalar() / 2)
    early = half & (F.col("partition") < 2) & (F.col("topic") != "topic_3")
    read = None
    for number, messages_ in enumerate((sent.where(early), sent.where(~early)), 1):
        topic_log.land(messages_, log, segment_rows=2000)
        stream = topic_log.stream_log(spark, log, rowsPerTask="1000").withColumn("run", F.lit(number))
        running = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        running.awaitTermination()
        read = spark.read.schema(stream.schema).parquet(out)
    event = F.from_json(F.col("value").cast("string"), "event_id bigint, event_type string")
    return t.as_ntz(read.select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"), event["event_id"].alias("event_id"),
        event["event_type"].alias("event_type"), "timestamp", "run"))


@query("stream_flush_batches", """
WITH sent AS (
    SELECT 'topic_' || CAST(event_id % 4 AS VARCHAR) AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 12 AS "offset",
           CASE WHEN event_id // 12 <= (SELECT max(event_id) // 24 FROM events) THEN 1 ELSE 2 END AS run
    FROM events
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY topic, "partition", run ORDER BY "offset") - 1 AS place,
           count(*) FILTER (WHERE run = 1) OVER (PARTITION BY topic, "partition") AS early FROM sent
), numbered AS (
    SELECT *, place // 100 + CASE WHEN run = 2 THEN (early + 99) // 100 ELSE 0 END AS batch_no FROM placed
), sized AS (
    SELECT *, count(*) OVER (PARTITION BY topic, "partition", batch_no) AS n FROM numbered
)
SELECT topic, "partition", "offset", CAST(batch_no AS BIGINT) AS batch_no, CAST(n AS INTEGER) AS batch_size,
       CASE WHEN n = 100 THEN 'full' ELSE 'end' END AS reason
FROM sized""")
def stream_flush_batches(spark, sf_dir):
    """Messages in batches of at most a hundred, in two scheduled runs of one checkpoint; none is held back
    at the end of a run, and numbers go on in the second."""
    sent, log = _topic_messages(spark, sf_dir), scratch_path(spark, "flush-topics")
    out, checkpoint = scratch_path(spark, "flush-out"), scratch_path(spark, "flush-checkpoint")
    half = F.floor(sent.agg(F.max("offset")).scalar() / 2)
    read = None
    for messages_ in (sent.where(F.col("offset") <= half), sent.where(F.col("offset") > half)):
        topic_log.land(messages_, log)
        stream = flush.flush_batches(topic_log.stream_log(spark, log), flush_seconds=0)
        running = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        running.awaitTermination()
        read = spark.read.schema(stream.schema).parquet(out)
    return read.select("topic", "partition", "offset", "batch_no", "batch_size", "reason")


@query("stream_compacted_days", """
WITH batches AS (SELECT *, event_id * 8 // ((SELECT max(event_id) FROM events) + 1) AS number FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_id, 'topic_' || CAST(event_id % 4 AS VARCHAR) AS kafka_topic, event_id AS kafka_offset,
       'taken_' || CAST(number AS VARCHAR) AS "_batch_id", DATE '2024-03-01' + CAST(number // 2 AS INTEGER) AS "_ingestion_date",
       number < 4 AS compacted
FROM batches""")
def stream_compacted_days(spark, sf_dir):
    """Eight micro-batches over four days: the first two days are compacted in two runs, then two of their batches
    are replayed, one with other rows. Read through the view."""
    table, label = "bronze_taken", "taken"
    sent = ingest.envelopes(spark, sf_dir, F.to_json(F.struct("event_id")))
    number = F.floor(F.col("offset") * 8 / (sent.agg(F.max("offset")).scalar() + 1)).cast("int")
    numbered, landed = sent.withColumn("number", number), scratch_path(spark, "batches")
    # each batch is read on its own and by all cores, also where the messages lie in the order of time
    numbered.repartition("offset", "timestamp").write.partitionBy("number").parquet(landed)
    batches = spark.read.schema(numbered.schema).parquet(landed)

    def write(lake: Lake, k: int, rows: DataFrame) -> None:
        now = F.lit(f"2024-03-0{1 + k // 2} 12:00:00").cast("timestamp")
        bronze.batch_writer(lake, table, label)(bronze.project(rows.drop("number"), now=now), k)

    def work(lake: Lake) -> None:
        for k in range(8):
            write(lake, k, batches.where(F.col("number") == k))
        compaction.compact(lake, table, date(2024, 3, 2))
        compaction.compact(lake, table, date(2024, 3, 3))
        write(lake, 0, batches.where("number = 0"))
        write(lake, 3, batches.where("number = 3 AND offset % 2 = 0"))
        seen = lake.read(compaction.view_name(table))
        upto = compaction.boundary(lake, table)[label]
        closed = F.regexp_extract("_batch_id", "[0-9]+$", 0).cast("int") <= upto
        lake.overwrite(seen.select("event_id", "kafka_topic", "kafka_offset", "_batch_id", "_ingestion_date", closed.alias("compacted")), "silver_seen")

    return with_lake(spark, "silver_seen", work)
