"""Sources, mapping and stream projections over the test tables.

Raw text, JSON bodies and message envelopes are made from the tables by Spark, and then
read by the operators; the SQL twins give the expected rows directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeshelf.operators import audit
from lakeshelf.operators.mapping import FieldMapping
from lakeshelf.sources import files, messages, payloads
from lakeshelf.streaming import bronze
from lakeshelf.workload import tables as t
from lakeshelf.workload.registry import query
from lakeshelf.workload.sql import with_ctes

# ---- scans ----------------------------------------------------------------


@query("scan_parquet", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders""")
def scan_parquet(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("read_table_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def read_table_limit(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("table_stats", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _COUNTED))
def table_stats(spark, sf_dir):
    return files.unite([
        t.table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count"
        )
        for n in _COUNTED
    ])


@query("union_by_name", """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment,
       'customer.parquet' AS _source_file FROM customer
UNION ALL
SELECT s_name, s_nationkey, s_acctbal, NULL, 'supplier.parquet' FROM supplier""")
def union_by_name(spark, sf_dir):
    name = F.col("_metadata.file_name").alias(files.SOURCE_FILE)
    buyers = t.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), name,
    )
    sellers = t.table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"), name,
    )
    return files.unite([buyers, sellers])


# ---- landed payloads ------------------------------------------------------


def _json_object(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


@query("json_flatten", """
SELECT event_id AS "id", user_id AS user_no, event_type AS meta_kind,
       CAST(json_extract(props, '$.k') AS BIGINT) AS meta_props_k FROM events""")
def json_flatten(spark, sf_dir):
    body = F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"user":{"no":'),
        F.col("user_id").cast("string"), F.lit('},"meta":{"kind":"'), F.col("event_type"),
        F.lit('","props":'), F.col("props"), F.lit("}}"),
    )
    records = t.table(spark, sf_dir, "events").select(body.alias(payloads.RECORD))
    flat = payloads.flatten_records(
        records, schema="id bigint, user struct<no: bigint>, meta struct<kind: string, props: struct<k: bigint>>"
    )
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


@query("json_envelope_unwrap", """
SELECT event_id AS response_id, event_id * 10 + n AS record_id
FROM events, (VALUES (1), (2)) copies(n)
WHERE n = 1 OR event_id % 6 IN (0, 1, 3, 4)
  AND event_id % 6 <> 5""")
def json_envelope_unwrap(spark, sf_dir):
    i = F.col("event_id")

    def record(n: int) -> Column:
        return F.concat(F.lit('{"record_id":'), (i * 10 + n).cast("string"), F.lit("}"))

    pair = F.concat(F.lit("["), record(1), F.lit(","), record(2), F.lit("]"))
    body = (
        F.when(i % 6 == 0, F.concat(F.lit('{"data":'), pair, F.lit("}")))
        .when(i % 6 == 1, F.concat(F.lit('{"meta":1,"results":'), pair, F.lit("}")))
        # one bare object
        .when(i % 6 == 2, record(1))
        # a key that holds no list falls through to a later one
        .when(i % 6 == 3, F.concat(F.lit('{"data":{"total":2},"items":'), pair, F.lit("}")))
        # a top-level list
        .when(i % 6 == 4, pair)
        .otherwise(F.concat(F.lit('{"data":"none","features":['), record(1), F.lit("]}")))
    )
    landed = t.table(spark, sf_dir, "events").select(i.alias("response_id"), body.alias("body"))
    records = payloads.unwrap_responses(landed)
    return records.select(
        "response_id", F.get_json_object(payloads.RECORD, "$.record_id").cast("bigint").alias("record_id")
    )


@query("page_union_until_empty", """
WITH pages AS (
    SELECT l_orderkey AS entity, l_linenumber AS page_no, l_partkey,
           CAST(l_quantity AS BIGINT) % 4 AS n FROM lineitem),
stops AS (SELECT entity, min(page_no) AS stop FROM pages WHERE n = 0 AND page_no <= 5 GROUP BY entity)
SELECT entity, page_no, l_partkey * 10 + k AS record_id
FROM pages LEFT JOIN stops USING (entity), (VALUES (1), (2), (3)) ks(k)
WHERE page_no <= 5 AND k <= n AND (stop IS NULL OR page_no < stop)""")
def page_union_until_empty(spark, sf_dir):
    """Order lines stand for pages: the line number is the page, the quantity its size. Some numbers hold several
    pages; one empty page among them ends the order."""
    n = F.col("l_quantity").cast("bigint") % 4
    numbers = F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n)).otherwise(F.array().cast("array<bigint>"))
    records = F.transform(numbers, lambda k: F.struct((F.col("l_partkey") * 10 + k).alias("record_id")))
    pages = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("entity"), F.col("l_linenumber").alias("page_no"),
        F.to_json(F.struct(records.alias("data"))).alias("body"),
    )
    united = payloads.unite_pages(pages, ["entity"], max_pages=5, end_at="empty body")
    return united.select(
        "entity", "page_no", F.get_json_object(payloads.RECORD, "$.record_id").cast("bigint").alias("record_id")
    )


# ---- messages -------------------------------------------------------------


def _message_fields() -> dict[str, Column]:
    return {
        "event_id": F.col("event_id").cast("string"),
        "event_type": F.col("event_type"),
        "value": F.col("value"),
        "payload": F.from_json("props", "k bigint"),
    }


def envelopes(spark, sf_dir, body: Column) -> DataFrame:
    """The events table as topic messages."""
    i = F.col("event_id")
    return t.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.concat(F.lit("topic_"), (i % 4).cast("string")).alias("topic"),
        (i % 3).cast("int").alias("partition"),
        i.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query("kafka_envelope_decode", """
SELECT 'topic_' || CAST(event_id % 4 AS VARCHAR) AS kafka_topic, CAST(event_id % 3 AS INTEGER) AS kafka_partition,
       event_id AS kafka_offset, CAST(user_id AS VARCHAR) AS kafka_key, ts AS kafka_timestamp,
       CASE WHEN event_id % 50 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN event_id % 50 <> 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 50 <> 0 THEN value END AS value,
       CASE WHEN event_id % 50 <> 0 THEN replace(props, ' ', '') END AS payload,
       CASE WHEN event_id % 50 = 0 THEN '{"event_id": ' || CAST(event_id AS VARCHAR) END AS broken
FROM events""")
def kafka_envelope_decode(spark, sf_dir):
    """Every fiftieth message is cut off and must come out as broken text."""
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"))
    body = F.when(F.col("event_id") % 50 == 0, cut).otherwise(_json_object(**_message_fields()))
    decoded = messages.decode(
        envelopes(spark, sf_dir, body), "event_id string, event_type string, value double, payload string"
    )
    return t.as_ntz(decoded.withColumnRenamed(messages.CORRUPT, "broken"))


_NOW = "2024-02-01 00:00:00"


def stream_bodies() -> Column:
    """Messages with absent keys: every seventh has no id, every ninth no type and no
    time, every eleventh no payload."""
    i = F.col("event_id")
    return _json_object(
        event_id=F.when(i % 7 != 0, i.cast("string")),
        event_type=F.when(i % 9 != 0, F.col("event_type")),
        sensor_id=F.concat(F.lit("sensor_"), (F.col("user_id") % 50).cast("string")),
        latitude=F.lit(40.5) + (F.col("user_id") % 32).cast("double") / 64,
        timestamp=F.when(i % 9 != 0, F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        value=F.col("value"),
        unit=F.lit("u"),
        payload=F.when(i % 11 != 0, F.from_json("props", "k bigint")),
    )


_BRONZE_SQL = f"""
SELECT CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR)
            ELSE md5('topic_' || CAST(event_id % 4 AS VARCHAR) || '|' || CAST(event_id % 3 AS VARCHAR) || '|'
                     || CAST(event_id AS VARCHAR)) END AS event_id,
       CASE WHEN event_id % 9 <> 0 THEN event_type ELSE 'unknown' END AS event_type,
       'sensor_' || CAST(user_id % 50 AS VARCHAR) AS sensor_id, '' AS location_id,
       CAST(40.5 AS DOUBLE) + CAST(user_id % 32 AS DOUBLE) / 64 AS latitude, CAST(NULL AS DOUBLE) AS longitude,
       CASE WHEN event_id % 9 <> 0 THEN ts ELSE TIMESTAMP '{_NOW}' END AS event_timestamp,
       value AS metric_value, 'u' AS metric_unit, 'topic_' || CAST(event_id % 4 AS VARCHAR) AS kafka_topic,
       CAST(event_id % 3 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
       CASE WHEN event_id % 11 <> 0 THEN replace(props, ' ', '') ELSE '{{}}' END AS raw_payload,
       TIMESTAMP '{_NOW}' AS _ingestion_timestamp, DATE '2024-02-01' AS _ingestion_date,
       'urban_events_kafka' AS _source_id, 'kafka' AS _source_type, 'batch_1' AS _batch_id
FROM events"""


@query("stream_bronze_projection", _BRONZE_SQL)
def stream_bronze_projection(spark, sf_dir):
    projected = bronze.project(
        envelopes(spark, sf_dir, stream_bodies()), F.lit("batch_1"), F.lit(_NOW).cast("timestamp")
    )
    return t.as_ntz(projected.select(*bronze.BRONZE_COLUMNS))


@query("stream_freshness", with_ctes("""
SELECT count(*) AS total_events, max(event_timestamp) AS latest_event, min(event_timestamp) AS oldest_event,
       count(DISTINCT event_type) AS event_types
FROM b_events WHERE _ingestion_timestamp >= (SELECT max(ts) FROM events) - INTERVAL 600 MINUTE""", "b_events"))
def stream_freshness(spark, sf_dir):
    events = t.bronze_events(spark, sf_dir)
    now = t.table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    return t.as_ntz(bronze.freshness(events, now, minutes=600))


@query("ingestion_summary", """
SELECT count(*) AS total_sources, count(*) FILTER (WHERE o_orderstatus <> 'F') AS successful,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS failed,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END) AS BIGINT)
         AS total_rows
FROM orders""")
def ingestion_summary(spark, sf_dir):
    """Orders stand for ingestion runs."""
    bad = F.col("o_orderstatus") == "F"
    runs = t.table(spark, sf_dir, "orders").select(
        F.when(bad, F.lit(audit.FAILED)).otherwise(F.lit(audit.SUCCESS)).alias("status"),
        F.when(bad, F.lit(0)).otherwise(F.floor("o_totalprice")).alias("rows_written"),
    )
    return audit.ingestion_summary(runs)


# ---- mapping --------------------------------------------------------------


def _text(c: str) -> Column:
    return F.col(c).cast("string")


@query("map_rename", """
SELECT p_partkey AS part_id, p_name AS title, p_size AS "size", p_brand FROM part""")
def map_rename(spark, sf_dir):
    """One rule has a dotted source, one names an absent column, one column has no rule."""
    raw = t.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("p.name"), "p_size", "p_brand"
    )
    rules = {"p_partkey": "part_id", "p.name": "title", "p_size": "size", "p_absent": "absent"}
    return FieldMapping.from_dict({s: {"target": g} for s, g in rules.items()}).apply(raw)


@query("map_jsonpath", """
SELECT event_id AS station, CAST(json_extract(props, '$.k') AS DOUBLE) AS temperature, event_type AS condition,
       CAST(NULL AS VARCHAR) AS absent_value
FROM events""")
def map_jsonpath(spark, sf_dir):
    body = F.concat(
        F.lit('{"id":'), _text("event_id"), F.lit(',"main":{"temp":'), F.get_json_object("props", "$.k"),
        F.lit('},"weather":[{"main":"'), F.col("event_type"), F.lit('"},{"main":"other"}]}'),
    )
    raw = t.table(spark, sf_dir, "events").select(body.alias("body"))
    mapping = FieldMapping.from_dict({
        "$.id": {"target": "station", "type": "bigint"},
        "$.main.temp": {"target": "temperature", "type": "double"},
        "$.weather[0].main": {"target": "condition", "type": "varchar"},
        "$.weather[5].main": {"target": "absent_value", "type": "varchar"},
    })
    return mapping.apply_to_json(raw, "body", keep_raw=False)


@query("map_default", """
SELECT o_orderkey, ifnull(nullif(o_orderstatus, 'P'), 'None') AS status,
       CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 3 = 1 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END
         AS amount
FROM orders""")
def map_default(spark, sf_dir):
    """A null gets the default; text that then fails the cast stays null."""
    amount = F.when(F.col("o_orderkey") % 3 == 1, F.lit("x")).when(F.col("o_orderkey") % 3 == 2, _text("o_custkey"))
    raw = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), amount.alias("amount")
    )
    return FieldMapping.from_dict({
        "status": {"default": "None"}, "amount": {"type": "double", "default": 7.0},
    }).apply(raw)


def _odd_numbers() -> Column:
    """Number texts in every form the integer cast has to judge."""
    i, user = F.col("event_id") % 8, _text("user_id")
    return (
        F.when(i == 0, user)
        .when(i == 1, F.concat(user, F.lit(".0")))
        .when(i == 2, F.concat(user, F.lit(".7")))
        .when(i == 3, F.concat(user, F.lit("e2")))
        .when(i == 4, F.lit("x"))
        .when(i == 5, F.lit(""))
        .when(i == 6, F.concat(F.lit("90071992547"), F.lpad(user, 5, "0")))
    )


@query("map_cast_int", """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN user_id WHEN 1 THEN user_id WHEN 3 THEN user_id * 100
       WHEN 6 THEN CAST('90071992547' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS BIGINT) END AS n
FROM events""")
def map_cast_int(spark, sf_dir):
    raw = t.table(spark, sf_dir, "events").select("event_id", _odd_numbers().alias("n"))
    return FieldMapping.from_dict({"n": {"type": "integer"}}).apply(raw)


@query("map_cast_double", """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN CAST(user_id AS DOUBLE) WHEN 1 THEN CAST(user_id AS DOUBLE)
       WHEN 2 THEN CAST(CAST(user_id AS VARCHAR) || '.7' AS DOUBLE) WHEN 3 THEN CAST(user_id * 100 AS DOUBLE)
       WHEN 6 THEN CAST('90071992547' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS DOUBLE) END AS n
FROM events""")
def map_cast_double(spark, sf_dir):
    raw = t.table(spark, sf_dir, "events").select("event_id", _odd_numbers().alias("n"))
    return FieldMapping.from_dict({"n": {"type": "double"}}).apply(raw)


@query("map_cast_timestamp", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
       WHEN 2 THEN date_trunc('second', ts) - INTERVAL 2 HOUR END AS at
FROM events""")
def map_cast_timestamp(spark, sf_dir):
    """Naive text is UTC, an offset is honoured, other text is null."""
    i = F.col("event_id") % 4
    ts = F.col("ts")
    text = (
        F.when(i == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(i == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(i == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .otherwise(F.lit("yesterday"))
    )
    raw = t.table(spark, sf_dir, "events").select("event_id", text.alias("at"))
    return t.as_ntz(FieldMapping.from_dict({"at": {"type": "timestamp"}}).apply(raw))


@query("map_range_nullify", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity BETWEEN 10 AND 40 THEN l_quantity END AS quantity,
       CASE WHEN l_tax >= CAST(0.02 AS DOUBLE) THEN l_tax END AS tax,
       CASE WHEN l_partkey <= 500 THEN l_partkey END AS part
FROM lineitem""")
def map_range_nullify(spark, sf_dir):
    raw = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_partkey"
    )
    return FieldMapping.from_dict({
        "l_quantity": {"target": "quantity", "type": "double", "validation": {"min": 10, "max": 40}},
        "l_tax": {"target": "tax", "type": "double", "validation": {"min": 0.02}},
        "l_partkey": {"target": "part", "type": "bigint", "validation": {"max": 500}},
    }).apply(raw)


# The traffic source's columns and rules.
TRAFFIC_MAPPING = {
    "date_time": {"target": "event_timestamp", "type": "timestamp", "required": True},
    "holiday": {"target": "holiday_name", "type": "varchar", "default": "None"},
    "temp": {"target": "temperature_kelvin", "type": "double", "required": True, "validation": {"min": 200, "max": 350}},
    "rain_1h": {"target": "rainfall_mm", "type": "double", "default": 0.0},
    "snow_1h": {"target": "snowfall_mm", "type": "double", "default": 0.0},
    "clouds_all": {"target": "cloud_coverage_pct", "type": "integer"},
    "weather_main": {"target": "weather_condition", "type": "varchar"},
    "weather_description": {"target": "weather_description", "type": "varchar"},
    "traffic_volume": {"target": "traffic_volume", "type": "integer", "required": True, "validation": {"min": 0, "max": 100000}},
}


def raw_traffic(spark, sf_dir) -> DataFrame:
    """Traffic as the text columns of a CSV file, with broken values."""
    i, user = F.col("event_id"), _text("user_id")
    return t.table(spark, sf_dir, "events").select(
        F.when(i % 13 == 0, F.lit("never")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("date_time"),
        F.when(i % 33 == 0, F.lit("Holiday")).alias("holiday"),
        F.when(i % 17 == 0, F.lit("400")).when(i % 19 == 0, F.lit("warm")).otherwise(F.concat(F.lit("280."), user)).alias("temp"),
        F.when(i % 5 == 0, F.lit("0.25")).when(i % 5 == 1, F.lit("wet")).alias("rain_1h"),
        F.when(i % 6 == 0, F.lit("1e-3")).alias("snow_1h"),
        F.when(i % 7 != 0, F.concat(user, F.lit(".0"))).alias("clouds_all"),
        F.col("event_type").alias("weather_main"),
        F.upper("event_type").alias("weather_description"),
        F.when(i % 250 == 1, F.lit("-1")).when(i % 250 == 2, F.lit("100001")).when(i % 250 == 3, F.lit(None))
        .otherwise(F.floor(F.col("value") * 20).cast("string")).alias("traffic_volume"),
        _text("event_id").alias("station"),
    )


@query("map_full", """
SELECT CASE WHEN event_id % 13 <> 0 THEN date_trunc('second', ts) END AS event_timestamp,
       CASE WHEN event_id % 33 = 0 THEN 'Holiday' ELSE 'None' END AS holiday_name,
       CASE WHEN event_id % 17 <> 0 AND event_id % 19 <> 0 THEN CAST('280.' || CAST(user_id AS VARCHAR) AS DOUBLE) END
         AS temperature_kelvin,
       CASE event_id % 5 WHEN 0 THEN CAST(0.25 AS DOUBLE) WHEN 1 THEN NULL ELSE 0 END AS rainfall_mm,
       CASE event_id % 6 WHEN 0 THEN CAST(0.001 AS DOUBLE) ELSE 0 END AS snowfall_mm,
       CASE WHEN event_id % 7 <> 0 THEN user_id END AS cloud_coverage_pct,
       event_type AS weather_condition, upper(event_type) AS weather_description,
       CASE WHEN event_id % 250 NOT IN (1, 2, 3) THEN CAST(floor(value * 20) AS BIGINT) END AS traffic_volume,
       CAST(event_id AS VARCHAR) AS station
FROM events""")
def map_full(spark, sf_dir):
    return t.as_ntz(FieldMapping.from_dict(TRAFFIC_MAPPING).apply(raw_traffic(spark, sf_dir)))
