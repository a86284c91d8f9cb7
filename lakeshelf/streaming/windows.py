"""Event-time operators on streams of bronze events. Each also runs on a batch frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeshelf.plans.silver import silver_stream_events


SENSOR, LOCATION = "sensor", "location"


def hourly_events(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Events per hour, category and topic, emitted when the hour is closed; all measures are exact.

    Streams allow no distinct count, so two windowed aggregates are chained: the first has a row for each sensor and
    each location of an hour, the second counts those rows. Both combine before their shuffle, and the state is that of the
    open hours' distinct sensors and locations. Measures come from the rows by sensor, which hold every event once.
    """
    silver = silver_stream_events(events)
    value, by_sensor = F.col("metric_value"), F.col("of.kind") == SENSOR
    each = F.array(
        F.struct(F.lit(SENSOR).alias("kind"), F.col("sensor_id").alias("name")),
        F.struct(F.lit(LOCATION).alias("kind"), F.col("location_id").alias("name")),
    )
    seen = (
        silver.withWatermark("event_timestamp", lateness)
        .select("event_timestamp", "event_category", "kafka_topic", "metric_value", F.explode(each).alias("of"))
        .groupBy(F.window("event_timestamp", "1 hour").alias("w"), "event_category", "kafka_topic", "of")
        .agg(
            F.count(F.lit(1)).alias("events"), F.count(value).alias("readings"), F.sum(value).alias("total"),
            F.max(value).alias("highest"), F.min(value).alias("lowest"),
        )
    )

    def found(kind: str) -> Column:
        return F.count_if((F.col("of.kind") == kind) & F.col("of.name").isNotNull())

    def measure(c: str) -> Column:
        return F.when(by_sensor, F.col(c))

    return (
        seen.groupBy(F.window(F.window_time("w"), "1 hour").alias("hour"), "event_category", "kafka_topic")
        .agg(
            F.sum(measure("events")).alias("event_count"),
            found(SENSOR).alias("unique_sensors"),
            found(LOCATION).alias("unique_locations"),
            F.try_divide(F.sum(measure("total")), F.sum(measure("readings"))).alias("avg_metric_value"),
            F.max(measure("highest")).alias("max_metric_value"),
            F.min(measure("lowest")).alias("min_metric_value"),
        )
        .select(F.col("hour.start").alias("hour_key"), "*")
        .drop("hour")
    )


def first_of_each_event(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drop repeats of an event id that arrive within the lateness; state older than that
    is forgotten, so it does not grow with the stream."""
    return events.withWatermark("event_timestamp", lateness).dropDuplicatesWithinWatermark(["event_id"])
