"""Topic logs as a source of their own: messages that a connector landed as segment files, read in batch or as a stream.

Layout: ``root/topic=<name>/partition=<number>/<offset of the first message, 20 digits>.parquet``; a segment holds the columns
offset, key, value and timestamp in order of offset, and is final once it appears under its name. Offsets of a partition may
have gaps (compacted topics), not repeats.

The stream's position is the next offset of every topic and partition, kept in Spark's checkpoint. A partition that the position
does not name begins at its first message, so partitions and topics added later are read whole. A new range is planned from names
alone (one footer for the newest segment of a partition) and is cut into tasks of ``rowsPerTask`` offsets, so one hot partition is
read by many tasks, each of which reads only the row groups in its range.

Where messages were deleted before they were read, the stream fails, unless ``failOnDataLoss`` is false. Segments are read with
pyarrow's file systems (local paths and URIs that it knows), not through Hadoop's.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "topic_log"
SEGMENT_ROWS = 100_000
ROWS_PER_TASK = 500_000
BATCH_ROWS = 8192
ENVELOPE = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"

Position = dict[str, dict[str, int]]

_SCHEMA = pa.schema([
    ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
    ("timestamp", pa.timestamp("us", "UTC")),
])

# Spark runs a source's planning and reading in processes of its own, which need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


@dataclass
class Span(InputPartition):
    """Offsets of one partition, from ``first`` up to but without ``end``, and the segments that may hold them."""

    topic: str
    partition: int
    first: int
    end: int
    files: tuple[str, ...]


class TopicLog:
    """The segments below a root folder."""

    def __init__(self, options):
        self.root = options["path"].rstrip("/")
        listed = options.get("topics", "")
        self.topics = {t.strip() for t in listed.split(",") if t.strip()} or None
        self.rows_per_task = int(options.get("rowsPerTask", ROWS_PER_TASK))
        self.strict = str(options.get("failOnDataLoss", "true")).lower() == "true"
        if self.rows_per_task < 1:
            raise ValueError("rowsPerTask must be at least 1")

    def segments(self) -> dict[tuple[str, int], list[tuple[int, str]]]:
        """(first offset, path) of every segment of the wanted topics, by topic and partition, in order."""
        system, root = _located(self.root)
        found: dict[tuple[str, int], list[tuple[int, str]]] = {}
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            parts = info.path.rsplit("/", 3)
            if info.type != fs.FileType.File or len(parts) < 4 or not parts[3].endswith(".parquet"):
                continue
            topic, _, name = parts[1].partition("=")
            label, _, number = parts[2].partition("=")
            base = parts[3].removesuffix(".parquet")
            if (topic, label) != ("topic", "partition") or not number.isdigit() or not base.isdigit():
                continue
            if self.topics is None or name in self.topics:
                found.setdefault((name, int(number)), []).append((int(base), info.path))
        return {place: sorted(files) for place, files in found.items()}

    def ends(self) -> Position:
        """The offset after the newest message of every partition."""
        system, _ = _located(self.root)
        ends: Position = {}
        for (topic, partition), files in sorted(self.segments().items()):
            with system.open_input_file(files[-1][1]) as source:
                footer = pq.ParquetFile(source).metadata
                at = footer.schema.to_arrow_schema().get_field_index("offset")
                groups = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
                ends.setdefault(topic, {})[str(partition)] = max([files[-1][0], *(g.max + 1 for g in groups if g)])
        return ends

    def spans(self, start: Position, end: Position) -> list[Span]:
        """What lies between two positions, as tasks."""
        spans = []
        for (topic, partition), files in sorted(self.segments().items()):
            until = end.get(topic, {}).get(str(partition))
            if until is None:
                continue
            first = start.get(topic, {}).get(str(partition))
            if first is None:
                first = files[0][0]
            elif first < files[0][0] and first < until and self.strict:
                raise ValueError(f"{topic}/{partition}: offsets {first} to {files[0][0] - 1} were deleted before they were read")
            for at in range(max(first, files[0][0]), until, self.rows_per_task):
                stop = min(at + self.rows_per_task, until)
                # a segment ends where the next one begins
                paths = [p for k, (base, p) in enumerate(files) if base < stop and (k + 1 == len(files) or files[k + 1][0] > at)]
                if paths:
                    spans.append(Span(topic, partition, at, stop, tuple(paths)))
        gone = [f"{t}/{p}" for t, known in start.items() for p, n in known.items()
                if n < end.get(t, {}).get(p, 0) and not any((s.topic, str(s.partition)) == (t, p) for s in spans)]
        if gone and self.strict:
            raise ValueError(f"offsets were deleted before they were read: {', '.join(gone)}")
        return spans

    def read(self, span: Span | None) -> Iterator[pa.RecordBatch]:
        if span is None:  # nothing was planned
            return
        system, _ = _located(self.root)
        for path in span.files:
            with system.open_input_file(path) as source:
                held = pq.ParquetFile(source)
                at = held.schema_arrow.get_field_index("offset")
                groups = []
                for g in range(held.num_row_groups):
                    range_ = held.metadata.row_group(g).column(at).statistics
                    if range_ is None or range_.min < span.end and range_.max >= span.first:
                        groups.append(g)
                for b in held.iter_batches(BATCH_ROWS, groups, columns=["offset", "key", "value", "timestamp"]):
                    offset = b.column("offset").to_numpy()
                    b = b.filter(pa.array((offset >= span.first) & (offset < span.end)))
                    if b.num_rows:
                        n = b.num_rows
                        columns = {
                            "topic": pa.repeat(span.topic, n), "partition": pa.array([span.partition] * n, pa.int32()),
                            **{c: b.column(c) for c in ("key", "value", "offset", "timestamp")},
                        }
                        yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in _SCHEMA], schema=_SCHEMA)


class TopicLogReader(DataSourceReader):
    """Everything that is there now."""

    def __init__(self, log: TopicLog):
        self.log = log

    def partitions(self) -> Sequence[InputPartition]:
        return self.log.spans({}, self.log.ends())

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)


class TopicLogStreamReader(DataSourceStreamReader):
    """What came since the position that the checkpoint holds."""

    def __init__(self, log: TopicLog):
        self.log = log

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.log.ends()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.log.spans(start, end)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)


class TopicLogSource(DataSource):
    """Options: path; topics (comma-separated, all by default); rowsPerTask; failOnDataLoss."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ENVELOPE

    def reader(self, schema) -> DataSourceReader:
        return TopicLogReader(TopicLog(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TopicLogStreamReader(TopicLog(self.options))


def _reading(reader, path: str, topics: Sequence[str], options: dict) -> DataFrame:
    named = {"topics": ",".join(topics)} if topics else {}
    return reader.format(FORMAT).options(**named, **options).option("path", path).load()


def read_log(spark: SparkSession, path: str, topics: Sequence[str] = (), **options: str) -> DataFrame:
    """All landed messages of the topics (of all, if none is named), as envelopes."""
    spark.dataSource.register(TopicLogSource)
    return _reading(spark.read, path, topics, options)


def stream_log(spark: SparkSession, path: str, topics: Sequence[str] = (), **options: str) -> DataFrame:
    """The topics as a stream of envelopes, from their first message on."""
    spark.dataSource.register(TopicLogSource)
    return _reading(spark.readStream, path, topics, options)


def land(envelopes: DataFrame, path: str, segment_rows: int = SEGMENT_ROWS) -> int:
    """Write envelopes as segments; returns how many messages.

    Messages are dealt in ranges of (topic, partition, offset), so a hot partition is written by many tasks. A task that runs again
    replaces its own segments. The offsets must lie behind those that landed before.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _located(path)
        held, now, rows, written = [], None, 0, 0

        def close() -> None:
            if held:
                segment = pa.Table.from_batches(held)
                folder = f"{root}/topic={now[0]}/partition={now[1]}"
                system.create_dir(folder, recursive=True)
                name = f"{folder}/{segment.column('offset')[0].as_py():020d}"
                with system.open_output_stream(f"{name}.part") as out:
                    pq.write_table(segment, out, compression="zstd")
                system.move(f"{name}.part", f"{name}.parquet")
                held.clear()

        for b in batches:
            written += b.num_rows
            places = list(zip(b.column("topic").to_pylist(), b.column("partition").to_pylist()))
            kept = b.select(["offset", "key", "value", "timestamp"])
            start = 0
            while start < b.num_rows:
                stop = start
                room = segment_rows - rows if places[start] == now else segment_rows
                while stop < b.num_rows and places[stop] == places[start] and stop - start < room:
                    stop += 1
                if places[start] != now or rows >= segment_rows:
                    close()
                    now, rows = places[start], 0
                held.append(kept.slice(start, stop - start))
                rows += stop - start
                if rows >= segment_rows:
                    close()
                    rows = 0
                start = stop
        close()
        yield pa.RecordBatch.from_pydict({"messages": pa.array([written], pa.int64())})

    ordered = envelopes.repartitionByRange("topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
    return ordered.mapInArrow(write, "messages long").agg(F.sum("messages")).first()[0] or 0
