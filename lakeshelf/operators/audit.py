"""Audit trail: one row per ingestion run, and the result rows of quality checks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from lakeshelf.operators.tables import Lake

# Names and columns of the audit tables.
INGESTION_AUDIT = "bronze.ingestion_audit"
QUALITY_AUDIT = "bronze.quality_audit"
INGESTION_COLUMNS = (
    "run_id string, source_id string, source_type string, status string, rows_extracted bigint, "
    "rows_written bigint, duration_seconds double, started_at timestamp, finished_at timestamp, "
    "errors string, created_at timestamp"
)
QUALITY_COLUMNS = (
    "run_id string, source_id string, check_type string, check_column string, passed boolean, "
    "failed_rows bigint, total_rows bigint, failure_rate double, details string, checked_at timestamp"
)

TOPIC_PROGRESS = "bronze.topic_progress"
PROGRESS_COLUMNS = "source_id string, topic string, partition int, next_offset bigint, recorded_at timestamp"

FILE_LEDGER = "bronze.file_ledger"

SUCCESS, FAILED, SKIPPED = "success", "failed", "skipped"


@dataclass
class RunResult:
    """What one source run did."""

    source_id: str
    source_type: str = ""
    status: str = "unknown"
    rows_extracted: int = 0
    rows_written: int = 0
    rows_rejected: int = 0
    duration_seconds: float = 0.0
    started_at: datetime | None = None
    finished_at: datetime | None = None
    errors: list[str] = field(default_factory=list)
    cast_rejects: dict[str, int] = field(default_factory=dict)

    def as_dict(self) -> dict:
        return asdict(self)


def create_audit_tables(lake: Lake) -> None:
    for name, columns in ((INGESTION_AUDIT, INGESTION_COLUMNS), (QUALITY_AUDIT, QUALITY_COLUMNS)):
        if not lake.exists(name):
            lake.append(lake.spark.createDataFrame([], columns), name)


def record_runs(lake: Lake, results: Sequence[RunResult]) -> int:
    """Append one row per result, in one write."""
    if not results:
        return 0
    now = datetime.now(timezone.utc)
    rows = [
        (
            str(uuid.uuid4()), r.source_id, r.source_type, r.status, r.rows_extracted, r.rows_written,
            float(r.duration_seconds), r.started_at, r.finished_at, json.dumps(r.errors), now,
        )
        for r in results
    ]
    return lake.append(lake.spark.createDataFrame(rows, INGESTION_COLUMNS).coalesce(1), INGESTION_AUDIT)


def topic_progress(lake: Lake, source_id: str) -> list[tuple[str, int, int]]:
    """(topic, partition, next offset) that earlier runs of a source came to; one row per topic partition."""
    if not lake.exists(TOPIC_PROGRESS):
        return []
    rows = lake.read(TOPIC_PROGRESS).where(F.col("source_id") == source_id)
    far = rows.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))
    return [(r["topic"], r["partition"], r["next_offset"]) for r in far.collect()]


def record_topic_progress(lake: Lake, source_id: str, envelope: DataFrame, now: datetime) -> int:
    """Record the offsets behind the messages that a run has loaded."""
    reached = envelope.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset")).select(
        F.lit(source_id).alias("source_id"), "topic", "partition", "next_offset", F.lit(now).alias("recorded_at")
    )
    return lake.append(reached.coalesce(1), TOPIC_PROGRESS)


def record_checks(lake: Lake, report: DataFrame) -> int:
    """Append a quality report, by column name."""
    return lake.append(report, QUALITY_AUDIT)


def ingestion_summary(runs: DataFrame) -> DataFrame:
    """One row: sources run, successes, failures, rows written."""
    status = F.col("status")
    return runs.agg(
        F.count(F.lit(1)).alias("total_sources"),
        F.count_if(status == SUCCESS).alias("successful"),
        F.count_if(status == FAILED).alias("failed"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("total_rows"),
    )


def record_files(lake: Lake, source_id: str, started: datetime, outcomes: Sequence[DataFrame]) -> None:
    """Append what became of each file of a run: path, status, size, damaged_at, detail; a later outcome of a path stands."""
    if not outcomes:
        return
    ranked = [df.withColumn("rank", F.lit(k)) for k, df in enumerate(outcomes)]
    together = ranked[0]
    for df in ranked[1:]:
        together = together.unionByName(df)
    columns = [c for c in outcomes[0].columns if c != "path"]
    last = together.groupBy("path").agg(F.max_by(F.struct(*columns), "rank").alias("last")).select("path", "last.*")
    stamped = last.select(F.lit(source_id).alias("source_id"), F.lit(started).cast("timestamp").alias("started_at"), "path", *columns)
    lake.append(stamped, FILE_LEDGER)
