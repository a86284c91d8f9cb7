"""File sources: CSV, JSON, JSON Lines and Parquet, united by column name.

Listing is left to Spark (parallel for large trees). File contents are read by
executors; the driver sees file names and, for CSV, the first bytes of each file up to the end of
its header (one file's where ``same_header`` is promised), 32 files at a time.
"""

from __future__ import annotations

import csv
import logging
import re
from bisect import bisect_right
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Any
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeshelf.operators.mapping import _quoted
from lakeshelf.session import staged
from lakeshelf.sources import ledger

log = logging.getLogger(__name__)

# CSV fields that mean "no value".
CSV_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

FORMATS = ("csv", "json", "jsonl", "ndjson", "parquet")
SOURCE_FILE = "_source_file"
CORRUPT = "_corrupt_record"

_HEADER_CHUNK = 64 * 1024
#: A header that is longer than this, because its line or its quote never ends, is none.
_HEADER_MOST = 16 * 1024 * 1024
_PROBE_THREADS = 32
#: Splits that are set smaller than this share a task up to it: each task starts Python, and each split reads a buffer beyond its end.
_TASK_BYTES = 1024 * 1024


@dataclass(frozen=True)
class FileOptions:
    """How files are read. The first six are the keys of a source spec."""

    encoding: str = "utf-8"
    delimiter: str = ","
    has_header: bool = True
    skip_rows: int = 0
    quote_char: str = '"'
    json_lines: bool = False
    # Quoted line breaks inside CSV fields; such files cannot be split.
    multi_line: bool = False
    # All CSV files promise the header of the first one: no header probe per file,
    # and Spark fails on a file that breaks the promise.
    same_header: bool = False
    # DDL of JSON files; without it Spark infers one in an extra pass.
    schema: str | None = None
    # Keep the text of broken CSV and JSON rows in ``_corrupt_record``.
    keep_corrupt: bool = True
    # Leave files out that cannot be read to their end, each as a whole; otherwise one of them fails the load.
    tolerate_bad_files: bool = True
    # Look through compressed and Parquet files before they are read (see ``ledger``). Without it damage within a file fails the load.
    verify_files: bool = True
    extra: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, raw: dict[str, Any] | None) -> FileOptions:
        known = {k: v for k, v in (raw or {}).items() if k in cls.__dataclass_fields__}
        return cls(**known)


class UnreadableFile(Exception):
    """A file whose header cannot be read."""


# ---- discovery ------------------------------------------------------------


def discover(spark: SparkSession, base_path: str, pattern: str, recursive: bool = False) -> list[str]:
    """Paths of the matching files, sorted. Only listings are read, never contents."""
    reader = spark.read.format("binaryFile")
    head, _, name = pattern.rpartition("/")
    base = f"{base_path.rstrip('/')}/{head}".rstrip("/")
    try:
        if recursive:
            found = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name).load(base)
        else:
            found = reader.load(f"{base}/{name}")
        return sorted(r.path for r in found.select("path").collect())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def format_of(path: str, configured: str) -> str:
    """A known extension wins over the configured format; an unknown format is an error."""
    extension = path.rsplit("/", 1)[-1].rpartition(".")[2].lower()
    chosen = extension if extension in FORMATS else configured.lower()
    if chosen not in FORMATS:
        raise ValueError(f"unsupported format {chosen!r} for {path}; supported: {', '.join(FORMATS)}")
    return chosen


def dataset_file(spark: SparkSession, folder: str, filename: str) -> str:
    """The named file of a downloaded dataset, or else the first CSV file of its folder."""
    files = discover(spark, folder, "*")
    exact = [p for p in files if p.rsplit("/", 1)[-1] == filename]
    tables = [p for p in files if p.lower().endswith(".csv")]
    if not exact and not tables:
        raise FileNotFoundError(f"{folder} holds neither {filename} nor a CSV file")
    return (exact or tables)[0]


# ---- CSV ------------------------------------------------------------------


@dataclass(frozen=True)
class _Head:
    """The first record of a CSV file, and the lines that come before the data."""

    record: tuple[str, ...]
    # lines in front of the record, and up to its end
    lines_before: int
    lines_through: int
    # byte offset at which each of those lines begins
    offsets: tuple[int, ...]
    size: int


def _head(spark: SparkSession, path: str, options: FileOptions) -> _Head | None:
    """The head of a file after the skipped lines; None if nothing follows them.

    As much of the file is read as that takes, in growing portions: however long a preamble or
    a header is, it is found. A file that cannot be opened or decoded so far is an error.
    """
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    try:
        stream = hadoop_path.getFileSystem(conf).open(hadoop_path)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hadoop_path)
        if codec is not None:
            stream = codec.createInputStream(stream)
    except Exception as error:  # noqa: BLE001 - any read error means "unreadable"
        raise UnreadableFile(path) from error
    try:
        data, size = b"", _HEADER_CHUNK
        while True:
            try:
                more = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
                    jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)
                ))
            except Exception as error:  # noqa: BLE001
                raise UnreadableFile(path) from error
            data += more
            at_end = len(more) < size
            try:
                found = _head_in(data, at_end, options)
            except csv.Error as error:
                raise UnreadableFile(f"{path}: {error}") from error
            if found is not None or at_end:
                return found
            if len(data) > _HEADER_MOST:
                raise UnreadableFile(f"{path} has no header within {len(data)} bytes")
            size = min(size * 4, 64 * 1024 * 1024)
    finally:
        stream.close()


def _head_in(data: bytes, at_end: bool, options: FileOptions) -> _Head | None:
    text = data.decode(options.encoding, errors="replace")
    mark = text.startswith("\ufeff")
    # line ends as the text reader knows them; the last line may go on
    lines = re.findall(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+$", text.removeprefix("\ufeff"))
    if not at_end:
        lines = lines[:-1]
    body = lines[options.skip_rows:]
    rows = csv.reader(iter(body), delimiter=options.delimiter, quotechar=options.quote_char)
    before = 0
    for row in rows:
        if not row or (len(row) == 1 and not row[0].strip()):
            before = rows.line_num  # a blank line in front of the header
            continue
        if not at_end and rows.line_num >= len(body):
            return None  # the record may go on behind what was read
        through = options.skip_rows + rows.line_num
        width = lambda t: len(t.encode(options.encoding, errors="replace"))
        starts, at = [], width("\ufeff") if mark else 0
        for line in lines[:through]:
            starts.append(at)
            at += width(line)
        return _Head(tuple(row), options.skip_rows + before, through, tuple(starts), at)
    return None


def _column_names(header: list[str]) -> tuple[str, ...]:
    """Names as given; blanks become ``Unnamed: i`` and repeats get a number."""
    names: list[str] = []
    for i, raw in enumerate(header):
        name = raw or f"Unnamed: {i}"
        candidate, n = name, 0
        while candidate in names:
            n += 1
            candidate = f"{name}.{n}"
        names.append(candidate)
    return tuple(names)


def _columns_of_head(head: _Head, options: FileOptions) -> tuple[str, ...]:
    if options.has_header:
        return _column_names(list(head.record))
    return tuple(str(i) for i in range(len(head.record)))


@dataclass
class _Group:
    """Files with the same columns and the same number of lines in front of the data."""

    columns: tuple[str, ...]
    drop: int
    paths: list[str] = field(default_factory=list)
    # where the dropped lines begin, for files in which they may reach beyond the first split
    long_heads: dict[str, tuple[int, ...]] = field(default_factory=dict)


def _csv_groups(spark: SparkSession, paths: list[str], options: FileOptions, bad: list[tuple[str, str]]) -> list[_Group]:
    """Files by their columns; those without a readable header are added to ``bad``. Reading files with other columns under one schema would
    shift values into the wrong columns."""

    def probe(path: str) -> tuple[str, _Head | None]:
        try:
            head = _head(spark, path, options)
            if head is None:
                raise UnreadableFile(f"{path} holds no record")
        except UnreadableFile as error:
            if not options.tolerate_bad_files:
                raise
            log.exception("skipping unreadable file %s", path)
            bad.append((path, str(error)))
            return path, None
        return path, head

    groups: dict[tuple, _Group] = {}
    first = paths[:1] if options.same_header and not options.skip_rows else paths
    shortest = _shortest_split(spark)
    with ThreadPoolExecutor(_PROBE_THREADS) as pool:
        for path, head in pool.map(probe, first):
            if head is None:
                continue
            columns = _columns_of_head(head, options)
            drop = (head.lines_through if options.has_header else head.lines_before) if options.skip_rows else 0
            group = groups.setdefault((columns, drop), _Group(columns, drop))
            group.paths.append(path)
            if drop and head.size >= shortest:
                group.long_heads[path] = head.offsets[:drop]
    if len(first) < len(paths) and groups:
        next(iter(groups.values())).paths = list(paths)
    return list(groups.values())


def _bytes_of(spark: SparkSession, key: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def _shortest_split(spark: SparkSession) -> int:
    """No split of a file is shorter than this many bytes, but the last of the file."""
    return min(_bytes_of(spark, "spark.sql.files.maxPartitionBytes"), _bytes_of(spark, "spark.sql.files.openCostInBytes"))


def _share_tasks(lines: DataFrame) -> DataFrame:
    """Several small splits to a task, each still whole and in file order; the number of tasks grows with the input.

    Splits of the usual sizes stay as they are."""
    spark = lines.sparkSession
    each = _TASK_BYTES // _bytes_of(spark, "spark.sql.files.maxPartitionBytes")
    if each < 2:
        return lines
    splits = lines.rdd.getNumPartitions()
    return lines.coalesce(max(-(-splits // each), min(splits, spark.sparkContext.defaultParallelism)))


def _csv_parse_options(options: FileOptions) -> dict[str, str]:
    return {
        "sep": options.delimiter,
        "quote": options.quote_char,
        # a quote inside a quoted field is written twice
        "escape": options.quote_char,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        **options.extra,
    }


def _plain_path(path: str) -> str:
    """One form for the paths of listings and of row metadata."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(path))


def _drop_first_lines(lines: DataFrame, count: int, long_heads: dict[str, tuple[int, ...]]) -> DataFrame:
    """Drop the first ``count`` lines of every file.

    Rows of a split arrive in file order. Where the lines fit into the split at byte 0 (nearly always), the first
    ``count`` rows of that split go. For the files of ``long_heads`` it is known where each of the lines begins: a
    split holds the lines that begin behind its first byte, up to its end (the split at byte 0 also
    the first), and so its share of them.
    """
    heads = {_plain_path(path): sorted(starts) for path, starts in long_heads.items()}

    def share(path: str, start: int, length: int) -> int:
        starts = heads.get(_plain_path(path)) if heads else None
        if starts is None:
            return count if start == 0 else 0
        return bisect_right(starts, start + length) - (bisect_right(starts, start) if start else 0)

    def skim(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        current, left = None, 0
        for batch in batches:
            if batch.empty:
                continue
            keep = np.ones(len(batch), bool)
            splits = pd.MultiIndex.from_frame(batch[["file", "start"]])
            changes = np.flatnonzero(np.r_[True, splits[1:] != splits[:-1]])
            for begin, end in zip(changes, [*changes[1:], len(batch)]):
                split = splits[begin]
                if split != current:
                    current, left = split, share(split[0], split[1], int(batch["length"].iat[begin]))
                gone = min(left, end - begin)
                keep[begin : begin + gone] = False
                left -= gone
            yield batch.loc[keep] if not keep.all() else batch

    return lines.mapInPandas(skim, lines.schema)


def _read_csv_group(spark: SparkSession, group: _Group, options: FileOptions) -> DataFrame:
    columns, paths = group.columns, group.paths
    fields = [T.StructField(c, T.StringType()) for c in columns]
    schema = T.StructType(fields + ([T.StructField(CORRUPT, T.StringType())] if options.keep_corrupt else []))
    # a reader that skips the rest of a bad file would load half of it
    reading = {"ignoreCorruptFiles": "false"}
    if options.skip_rows:
        if options.multi_line:
            raise ValueError("skip_rows and multi_line cannot be used together")
        lines = (
            spark.read.options(**reading, encoding=options.encoding).text(paths)
            .select(
                "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                F.col("_metadata.file_block_length").alias("length"),
            )
        )
        body = _drop_first_lines(_share_tasks(lines), group.drop, group.long_heads)
        row = _from_csv(F.col("value"), schema, options)
        name = F.element_at(F.split("file", "/"), -1)
        raw = body.where(F.trim("value") != "").select(row.alias("row"), name.alias(SOURCE_FILE)).select("row.*", SOURCE_FILE)
    else:
        raw = (
            spark.read.schema(schema)
            .options(
                **reading,
                **_csv_parse_options(options),
                header=str(options.has_header).lower(),
                enforceSchema=str(not (options.same_header and options.has_header)).lower(),
                encoding=options.encoding,
                multiLine=str(options.multi_line).lower(),
            )
            .csv(paths)
            .select("*", F.col("_metadata.file_name").alias(SOURCE_FILE))
        )
    cleaned = [_null_tokens(F.col(_quoted(c))).alias(c) for c in columns]
    kept = [F.col(CORRUPT)] if options.keep_corrupt else []
    return raw.select(*cleaned, *kept, SOURCE_FILE)


def _null_tokens(c: Column) -> Column:
    return F.when(~c.isin(*CSV_NULLS), c)


def _from_csv(c: Column, schema: T.StructType, options: FileOptions) -> Column:
    ddl = ", ".join(f"{_quoted(f.name)} STRING" for f in schema.fields)
    return F.from_csv(c, ddl, _csv_parse_options(options))


# ---- JSON and Parquet -----------------------------------------------------


def _read_json(spark: SparkSession, paths: list[str], options: FileOptions, lines: bool) -> DataFrame:
    """Scalars are read as text: the mapping casts them, the same way for every file."""
    reader = spark.read.options(
        multiLine=str(not lines).lower(),
        primitivesAsString="true",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
        ignoreCorruptFiles="false",
        encoding=options.encoding,
        **options.extra,
    )
    if options.schema:
        corrupt = f", {CORRUPT} STRING" if options.keep_corrupt else ""
        reader = reader.schema(options.schema + corrupt)
    df = reader.json(paths).select("*", F.col("_metadata.file_name").alias(SOURCE_FILE))
    # inference adds the column as soon as one record is broken
    return df if options.keep_corrupt else df.drop(CORRUPT)


def _read_parquet(spark: SparkSession, paths: list[str], options: FileOptions) -> DataFrame:
    return (
        spark.read.options(
            mergeSchema="true", ignoreCorruptFiles="false", **options.extra
        )
        .parquet(*paths)
        .select("*", F.col("_metadata.file_name").alias(SOURCE_FILE))
    )


# ---- the source -----------------------------------------------------------


def unite(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _whole_files(spark: SparkSession, paths: list[str], options: FileOptions, outcomes: list[DataFrame]) -> list[str]:
    """The files that are whole (or can't be examined); the outcome of all is added to ``outcomes``."""
    if not options.verify_files:
        return paths
    found, _ = staged(ledger.examine(spark, paths), "ledger")
    outcomes.append(found)
    bad = {r["path"]: r for r in found.where(~F.col("status").isin(ledger.WHOLE, ledger.UNEXAMINED)).collect()}
    for path, row in bad.items():
        if not options.tolerate_bad_files:
            raise UnreadableFile(f"{path} is {row['status']}: {row['detail']}")
        log.error("leaving out %s file %s: %s", row["status"], path, row["detail"])
    return [p for p in paths if p not in bad]


def read_paths(
    spark: SparkSession, paths: list[str], configured_format: str, options: FileOptions | None = None,
    outcomes: list[DataFrame] | None = None,
) -> DataFrame:
    """Read files of any mix of formats and columns into one frame with ``_source_file``.

    Files that aren't whole are left out as a whole. ``outcomes`` is given frames of ``ledger.COLUMNS``: what became of each
    file (where a path occurs twice, the later frame has found more).
    """
    options, outcomes = options or FileOptions(), [] if outcomes is None else outcomes
    by_format: dict[str, list[str]] = {}
    bad: list[tuple[str, str]] = []
    for path in paths:
        try:
            by_format.setdefault(format_of(path, configured_format), []).append(path)
        except ValueError as error:
            if not options.tolerate_bad_files:
                raise
            log.exception("skipping file %s", path)
            bad.append((path, str(error)))
    known = [p for members in by_format.values() for p in members]
    whole = set(_whole_files(spark, known, options, outcomes)) if known else set()
    frames: list[DataFrame] = []
    for fmt, listed in sorted(by_format.items()):
        members = [p for p in listed if p in whole]
        if not members:
            continue
        if fmt == "csv":
            for group in _csv_groups(spark, members, options, bad):
                frames.append(_read_csv_group(spark, group, options))
            continue
        try:
            if fmt == "parquet":
                frames.append(_read_parquet(spark, members, options))
            else:
                lines = fmt in ("jsonl", "ndjson") or options.json_lines
                frames.append(_read_json(spark, members, options, lines))
        except AnalysisException as error:
            # no file of the group gave a schema
            if not options.tolerate_bad_files:
                raise
            log.exception("skipping %d unreadable %s files", len(members), fmt)
            bad += [(p, str(error)[:500]) for p in members]
    if bad:
        rows = [(path, ledger.UNREADABLE, None, None, detail[:500]) for path, detail in bad]
        outcomes.append(spark.createDataFrame(rows, ledger.COLUMNS))
    if not frames:
        raise RuntimeError(f"none of the {len(paths)} files could be read")
    return unite(frames)


def read_files(
    spark: SparkSession,
    base_path: str,
    pattern: str = "*.csv",
    configured_format: str = "csv",
    recursive: bool = False,
    options: FileOptions | None = None,
    outcomes: list[DataFrame] | None = None,
) -> DataFrame:
    """Discover and read the matching files (see ``read_paths``); no match is an error."""
    paths = discover(spark, base_path, pattern, recursive)
    if not paths:
        raise FileNotFoundError(f"no file matches {pattern} in {base_path}")
    return read_paths(spark, paths, configured_format, options, outcomes)
