"""The outcome of every file of a load, found in tasks before the files are read.

A reader that meets damage half way has already handed on the rows in front of it. So files whose damage shows late only are examined
first: gzip and bzip2 files are unpacked to their checksum, Parquet files are decoded group by group. Nothing is kept but the outcome; a file
that isn't whole is then left out of the load as a whole. Other text files can't be damaged within: what their rows hold is judged row by row.

Files are opened with pyarrow's file systems. Those of schemes that it doesn't know are ``unexamined``: damage in them fails the load.
"""

from __future__ import annotations

import bz2
import gzip
import re
import sys
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: Read to its end; broken after its beginning, at a byte of the file; broken from the start; not looked at.
WHOLE, DAMAGED, UNREADABLE, UNEXAMINED = "whole", "damaged", "unreadable", "unexamined"
COLUMNS = "path string, status string, size long, damaged_at long, detail string"

_UNPACK = {".gz": gzip.GzipFile, ".bz2": bz2.BZ2File}
_PORTION = 1 << 16
#: Files of one task, about: their sizes differ too much to plan by number alone.
FILES_A_TASK = 8

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _unpacked(source, opener) -> tuple[str, int | None, str | None]:
    read = 0
    try:
        with opener(fileobj=source) if opener is gzip.GzipFile else opener(source) as stream:
            while portion := stream.read1(_PORTION):
                read += len(portion)
    except (OSError, EOFError, ValueError, zlib.error) as error:
        return (DAMAGED if read else UNREADABLE), min(source.tell(), source.size()), str(error)
    return WHOLE, None, None


def _decoded(source) -> tuple[str, int | None, str | None]:
    try:
        held = pq.ParquetFile(source, page_checksum_verification=True)
    except (OSError, ValueError, pa.ArrowException) as error:
        return UNREADABLE, None, str(error)
    for group in range(held.num_row_groups):
        for column in range(held.metadata.num_columns):
            chunk = held.metadata.row_group(group).column(column)
            at = chunk.dictionary_page_offset or chunk.data_page_offset
            try:
                for _ in held.iter_batches(8192, [group], columns=[chunk.path_in_schema], use_threads=False):
                    pass
            except (OSError, ValueError, pa.ArrowException) as error:
                return DAMAGED, at, str(error)
    return WHOLE, None, None


def outcome(path: str) -> tuple[str, str, int | None, int | None, str | None]:
    """path, status, size, where it is damaged (the last byte read, or the start of the damaged column chunk), and what was found."""
    local = re.sub(r"^file:/+", "/", path)
    try:
        system, name = fs.FileSystem.from_uri(local) if ":/" in local else (fs.LocalFileSystem(), local)
    except (OSError, ValueError, pa.ArrowException) as error:
        return path, UNEXAMINED, None, None, str(error)[:500]
    try:
        with system.open_input_file(name) as source:
            size = source.size()
            opener = next((o for end, o in _UNPACK.items() if name.lower().endswith(end)), None)
            if opener:
                status, at, detail = _unpacked(source, opener)
            elif name.lower().endswith(".parquet"):
                status, at, detail = _decoded(source)
            else:
                status, at, detail = WHOLE, None, None
    except OSError as error:
        return path, UNREADABLE, None, None, str(error)[:500]
    return path, status, size, at, detail and detail[:500]


def examine(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A row for each file: path, status, size, damaged_at, detail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for b in batches:
            rows = [outcome(p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.repartition(max(1, -(-len(paths) // FILES_A_TASK))).mapInArrow(run, COLUMNS)
