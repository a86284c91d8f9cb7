"""Running source specs: read, map, add audit columns, write, record.

Every source is one Spark write. Row counts and cast rejects are observed during that
write. A failing source is recorded and does not stop the others.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lakeshelf.operators import audit, quality
from lakeshelf.operators.mapping import columns_of
from lakeshelf.operators.tables import Lake
from lakeshelf.session import staged
from lakeshelf.sources import files, messages, payloads
from lakeshelf.sources.spec import SourceSpec, SpecFolder

log = logging.getLogger(__name__)

Reader = Callable[[SparkSession, SourceSpec], DataFrame]
RAW_JSON = "_raw_record"


# ---- readers by source type ----------------------------------------------


def read_file_source(spark: SparkSession, spec: SourceSpec, outcomes: list[DataFrame] | None = None) -> DataFrame:
    s = spec.settings
    return files.read_files(
        spark,
        s["base_path"],
        s.get("pattern", "*.csv"),
        spec.format,
        s.get("recursive", False),
        files.FileOptions.from_dict(s),
        outcomes,
    )


def read_dataset_source(spark: SparkSession, spec: SourceSpec, outcomes: list[DataFrame] | None = None) -> DataFrame:
    """A dataset file that was downloaded before."""
    s = spec.settings
    path = files.dataset_file(spark, s["download_path"], s.get("filename", ""))
    kind = "parquet" if path.lower().endswith(".parquet") else "csv"
    return files.read_paths(
        spark, [path], kind, files.FileOptions.from_dict(s), outcomes
    ).drop(files.SOURCE_FILE)


def read_api_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Landed responses below ``landing_path``.

    Unpaged: one response per file. Paged: JSON Lines with ``page_no``, ``body`` and,
    where several entities are fetched, ``entity``. Fetching is not part of this library.
    """
    s = spec.settings
    if not s.get("landing_path"):
        raise ValueError(f"source {spec.source_id!r} names no landing_path with fetched responses")
    if not s.get("pagination", False):
        sound, broken = payloads.split_broken(payloads.read_documents(spark, s["landing_path"]))
        return _with_broken(payloads.unwrap_responses(sound), broken)
    pages = spark.read.schema("entity string, page_no int, body string").json(s["landing_path"])
    # the pages are here already: only a spec that names a limit leaves some out, and says how many
    limit = s.get("max_pages")
    if limit is not None and (beyond := pages.where(F.col("page_no") > limit).count()):
        log.warning("source %s: %d landed pages beyond max_pages=%d are left out", spec.source_id, beyond, limit)
        pages = pages.where(F.col("page_no") <= limit)
    gaps = payloads.missing_pages(pages, ["entity"], max_pages=limit).take(5)
    if gaps:
        raise RuntimeError(f"landed pages have gaps: {[r.asDict() for r in gaps]}")
    sound, broken = payloads.split_broken(pages)
    return _with_broken(payloads.unite_pages(sound, ["entity"], max_pages=limit), broken)


def _with_broken(records: DataFrame, broken: DataFrame) -> DataFrame:
    """Records, and bodies that are no JSON as rows with their text in ``_corrupt_record``."""
    return records.withColumn(files.CORRUPT, F.lit(None).cast("string")).unionByName(
        broken.withColumnRenamed("body", files.CORRUPT).withColumn(
            files.CORRUPT, F.coalesce(files.CORRUPT, F.lit(""))
        ),
        allowMissingColumns=True,
    )


Progress = Sequence[tuple[str, int, int]]


def read_envelopes(spark: SparkSession, spec: SourceSpec, progress: Progress = ()) -> DataFrame:
    """Messages of the topics, or landed envelopes where ``landing_path`` is set, from ``progress`` on:
    the next offset of each (topic, partition) that was read before."""
    s = spec.settings
    if not s.get("landing_path"):
        topics = [t["name"] for t in s.get("topics", [])]
        read = {topic for topic, _, _ in progress}
        known, new = [t for t in topics if t in read], [t for t in topics if t not in read]
        parts = []
        if known:
            parts.append(messages.read_topics(spark, s["bootstrap_servers"], known, **messages.starting_at(known, progress)))
        if new or not known:
            parts.append(messages.read_topics(spark, s["bootstrap_servers"], new))
        return files.unite(parts)
    envelope = spark.read.schema(messages.ENVELOPE).parquet(s["landing_path"])
    if not progress:
        return envelope
    # one row per topic partition
    seen = spark.createDataFrame(list(progress), "topic string, partition int, __next long")
    joined = envelope.join(seen, ["topic", "partition"], "left")
    return joined.where(F.col("__next").isNull() | (F.col("offset") >= F.col("__next"))).select(*envelope.columns)


def read_topic_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """All messages of the topics, decoded. A run of the ``Ingestor`` reads only what is new."""
    return decode_envelopes(read_envelopes(spark, spec), spec)


def decode_envelopes(envelope: DataFrame, spec: SourceSpec) -> DataFrame:
    # the envelope itself supplies these names of a mapping
    own = {"topic", "partition", "offset"}
    fields = ", ".join(f"`{r.source}` string" for r in spec.mapping.rules if r.source not in own)
    decoded = messages.decode(envelope, fields)
    return decoded.withColumnsRenamed({f"kafka_{n}": n for n in own})


READERS: dict[str, Reader] = {
    "file": read_file_source,
    "kaggle": read_dataset_source,
    "api": read_api_source,
    "kafka": read_topic_source,
}


# ---- mapping and audit columns -------------------------------------------


def audit_columns(spec: SourceSpec, now: datetime) -> dict[str, Column]:
    """Fixed once per run, so every task and every retry writes the same values."""
    return {
        "_ingestion_timestamp": F.lit(now),
        "_ingestion_date": F.lit(now.date()),
        "_source_id": F.lit(spec.source_id),
        "_source_type": F.lit(spec.source_type),
        "_batch_id": F.lit(f"{spec.source_id}_{int(now.timestamp())}"),
    }


Watch = Callable[[DataFrame, Sequence[Column]], DataFrame]


def transform(raw: DataFrame, spec: SourceSpec, now: datetime, watch: Watch | None = None) -> DataFrame:
    """Map the raw columns (or the paths of raw JSON records) and add the audit columns.

    ``watch`` gets the frame that the casts read, with one count of rejected values for each rule.
    """
    watch = watch or (lambda df, counts: df)
    if payloads.RECORD in raw.columns:
        records = raw.withColumnRenamed(payloads.RECORD, RAW_JSON)
        if spec.mapping.rules and not spec.settings.get("infer_columns", False):
            mapped = spec.mapping.apply_to_json(records, RAW_JSON, watch=watch)
        else:
            flat = payloads.flatten_records(records, RAW_JSON)
            mapped = spec.mapping.apply(watch(flat, spec.mapping.rejected_casts(flat)))
    else:
        mapped = spec.mapping.apply(watch(raw, spec.mapping.rejected_casts(raw)))
    return mapped.withColumns(audit_columns(spec, now))


def check_sources(lake: Lake, specs: Iterable[SourceSpec], now: datetime | None = None) -> DataFrame | None:
    """Run the checks that the specs declare over their target tables, and append the
    results to the quality audit. Sources without a table or without checks are skipped."""
    suite = [
        (s.source_id, lake.read(s.target_table), s.checks())
        for s in specs
        if s.checks() and lake.exists(s.target_table)
    ]
    report = quality.report_all(suite, now=now)
    if report is not None:
        audit.record_checks(lake, report)
    return report


class Ingestor:
    """Runs the specs of a folder against a lake."""

    def __init__(self, lake: Lake, specs: SpecFolder | Sequence[SourceSpec], readers: dict[str, Reader] | None = None):
        self.lake = lake
        self.specs = specs
        self.readers = dict(READERS if readers is None else readers)

    def register(self, source_type: str, reader: Reader) -> None:
        """Add a source type, or replace one."""
        self.readers[source_type] = reader

    def source_types(self) -> dict[str, str]:
        return {kind: reader.__name__ for kind, reader in self.readers.items()}

    def _enabled(self) -> list[SourceSpec]:
        return [s for s in self.specs if s.enabled]

    def run_source(self, source_id: str) -> audit.RunResult:
        """Run one source; a failure is recorded and raised."""
        spec = next((s for s in self._enabled() if s.source_id == source_id), None)
        if spec is None:
            raise ValueError(f"no enabled source {source_id!r}")
        return self._run(spec)

    def run_type(self, source_type: str, parallel: int = 1) -> list[audit.RunResult]:
        return self._run_all([s for s in self._enabled() if s.source_type == source_type], parallel)

    def run_all(self, parallel: int = 1) -> list[audit.RunResult]:
        """Run every enabled source; up to ``parallel`` writes share the cluster."""
        return self._run_all(self._enabled(), parallel)

    def _run_all(self, specs: list[SourceSpec], parallel: int) -> list[audit.RunResult]:
        def guarded(spec: SourceSpec) -> audit.RunResult:
            try:
                return self._run(spec)
            except Exception as error:  # noqa: BLE001 - the other sources go on
                log.exception("source %s failed", spec.source_id)
                return audit.RunResult(
                    spec.source_id, spec.source_type, audit.FAILED, errors=[str(error)]
                )

        if parallel <= 1:
            return [guarded(s) for s in specs]
        with ThreadPoolExecutor(parallel) as pool:
            return list(pool.map(inheritable_thread_target(self.lake.spark)(guarded), specs))

    def _run(self, spec: SourceSpec) -> audit.RunResult:
        started, clock = datetime.now(timezone.utc), time.monotonic()
        result = audit.RunResult(spec.source_id, spec.source_type, started_at=started)
        try:
            reader = self.readers.get(spec.source_type)
            if reader is None:
                raise ValueError(
                    f"unknown source type {spec.source_type!r} of {spec.source_id!r}; "
                    f"known: {', '.join(self.readers)}"
                )
            if reader is read_topic_source:
                self._load_topics(spec, started, result)
            elif reader in (read_file_source, read_dataset_source):
                outcomes: list[DataFrame] = []
                try:
                    self._load(reader(self.lake.spark, spec, outcomes), spec, started, result)
                finally:
                    audit.record_files(self.lake, spec.source_id, started, outcomes)
            else:
                self._load(reader(self.lake.spark, spec), spec, started, result)
            result.status = audit.SUCCESS
        except Exception as error:
            result.status = audit.FAILED
            result.errors.append(str(error))
            raise
        finally:
            result.duration_seconds = round(time.monotonic() - clock, 2)
            result.finished_at = datetime.now(timezone.utc)
            try:
                audit.record_runs(self.lake, [result])
            except Exception:  # noqa: BLE001 - an audit problem must not hide the run's own outcome
                log.exception("cannot record the run of %s", spec.source_id)
        return result

    def _load_topics(self, spec: SourceSpec, now: datetime, result: audit.RunResult) -> None:
        """Load the messages since the last run, and record how far it came.

        They are fetched once, to the shared folder: good and broken messages and the offsets
        come from the same rows, whatever arrives meanwhile. The offsets are recorded after the write; a run
        that fails between the two is repeated, and so gives its messages twice at worst.
        """
        spark = self.lake.spark
        progress = audit.topic_progress(self.lake, spec.source_id)
        envelope, release = staged(read_envelopes(spark, spec, progress), "topics")
        try:
            self._load(decode_envelopes(envelope, spec), spec, now, result)
            audit.record_topic_progress(self.lake, spec.source_id, envelope, now)
        finally:
            release()

    def _load(self, raw: DataFrame, spec: SourceSpec, now: datetime, result: audit.RunResult) -> None:
        seen = Observation()

        def watch(df: DataFrame, rejected: Sequence[Column]) -> DataFrame:
            return df.observe(seen, F.count(F.lit(1)).alias("__rows"), *rejected)

        mapped = transform(raw, spec, now, watch)
        corrupt = next((c for c in (files.CORRUPT, messages.CORRUPT) if c in mapped.columns), None)
        good = mapped
        if corrupt:
            good = mapped.where(columns_of(mapped, [corrupt])[0].isNull()).drop(corrupt)
        partitions = [spec.partition_column] if spec.partition_column else []
        # a run has one ingestion date: its tasks write that partition side by side
        spread = partitions != ["_ingestion_date"]
        result.rows_written = self.lake.write(
            good, spec.target_table, spec.write_mode, partitions, rebalance=spread
        )
        counts = seen.get
        result.rows_extracted = int(counts.pop("__rows"))
        result.cast_rejects = {k: int(v) for k, v in counts.items() if v}
        result.rows_rejected = result.rows_extracted - result.rows_written
        if corrupt and result.rows_rejected:
            self._quarantine(transform(raw, spec, now), corrupt, spec)

    def _quarantine(self, mapped: DataFrame, corrupt: str, spec: SourceSpec) -> None:
        """Broken rows beside the target: their text, and what could be parsed of it. Files
        are read again for them, the ones listed for this run, and only when there are any."""
        stamps = ["_ingestion_timestamp", "_ingestion_date", "_source_id", "_batch_id"]
        parsed = [c for c in mapped.columns if c not in (corrupt, *stamps)]
        text = columns_of(mapped, [corrupt])[0]
        broken = mapped.where(text.isNotNull()).select(
            text.alias("raw_text"), F.to_json(F.struct(*columns_of(mapped, parsed))).alias("parsed"), *stamps
        )
        self.lake.append(broken, f"{spec.target_table}_quarantine")
