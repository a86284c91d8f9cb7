"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lakeshelf

#: Rows of an Arrow batch handed to Python: a batch of long texts stays within a few tens of MB.
BATCH_ROWS = 512

#: Ids that are broadcast as such: some 20 MB in an executor.
BROADCAST_IDS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what a Python worker holds of its input at once, and see that it can import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if not getattr(context, "_lakeshelf_sent", False):
        root = Path(lakeshelf.__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="lakeshelf-")) / "lakeshelf.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.glob("lakeshelf/**/*.py")):
                out.write(path, path.relative_to(root))
        context.addPyFile(str(archive))
        context._lakeshelf_sent = True


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where it is unset, a temporary folder is made, for a local master only: on a cluster each
    machine would have a folder of its own, and later reads would miss files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeshelf-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, never reused."""
    return f"{scratch_root(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut by files that outlive executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def unused(name: str, taken: Iterable[str]) -> str:
    """A column name that isn't among ``taken`` (which Spark compares without case)."""
    taken = {c.lower() for c in taken}
    while name in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- rows in Python


def texts_of(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# ---------------------------------------------------------------- keeping rows by a filter of bounded size

_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads any differences over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows_with_ids(docs: DataFrame, ids: DataFrame, id_column: str = "doc_id", max_bits: int = 27) -> DataFrame:
    """Rows of ``docs`` whose integer id is in ``ids``, without shuffling most of the others.

    Up to BROADCAST_IDS ids (their number is counted here) are broadcast. Beyond, a bitmap of hashed ids is made in the tasks, united on the driver and broadcast; the rows it lets
    through are then joined exactly. It has at most ``2 ** max_bits`` bits (16 MB), however many ids
    there are: beyond that it lets more rows through to the join, which stays exact.
    """
    spark = docs.sparkSession
    ids = ids.select(id_column).distinct()
    n = ids.count()
    if n <= BROADCAST_IDS:
        return docs.join(F.broadcast(ids), id_column, "left_semi")
    bits = int(min(max_bits, max(13, np.ceil(np.log2(16 * n + 1)))))
    shift = np.uint64(64 - bits)
    schema = pa.schema([("page", pa.int32()), ("bits", pa.binary())])

    def places(column: pa.Array) -> np.ndarray:
        column = column.cast(pa.int64()).fill_null(0)
        return mixed(column.to_numpy(zero_copy_only=False).astype(np.uint64) * _MIX + _MIX) >> shift

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << bits, np.uint8)
        for b in batches:
            found[places(b.column(0))] = 1
        packed = np.packbits(found)
        pages = np.split(packed, max(1, len(packed) // 65536))
        some = [k for k, p in enumerate(pages) if p.any()]
        yield batch(schema, some, [pages[k].tobytes() for k in some])

    def unite(key, pages):
        out = np.zeros(len(pages["bits"][0].as_py()), np.uint8)
        for p in pages["bits"]:
            out |= np.frombuffer(p.as_py(), np.uint8)
        return pa.table({"page": pa.array([key[0].as_py()], pa.int32()), "bits": [out.tobytes()]}, schema=schema)

    made = ids.mapInArrow(collect, "page int, bits binary").groupBy("page").applyInArrow(unite, "page int, bits binary")
    packed = np.zeros(1 << (bits - 3), np.uint8)
    for row in made.collect():  # at most 16 MB in all, whatever the input
        packed[row["page"] * 65536 : row["page"] * 65536 + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(packed)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = places(b.column(b.schema.get_field_index(id_column)))
            hit = (shared.value[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1
            yield b.filter(pa.array(hit.astype(bool)))

    return docs.mapInArrow(pick, docs.schema).join(ids, id_column, "left_semi")


def rows_without(rows: DataFrame, gone: DataFrame, on, at_most: int = BROADCAST_IDS) -> DataFrame:
    """Rows of ``rows`` that match no row of ``gone`` under the condition ``on``.

    Up to ``at_most`` rows of ``gone`` (counted here) are broadcast, so the others aren't shuffled; beyond, both sides are joined by key.
    """
    return rows.join(F.broadcast(gone) if gone.count() <= at_most else gone, on, "left_anti")


# ---------------------------------------------------------------- words and shingles


def words(text: str) -> list[bytes]:
    """Lower-case A-Z and take the runs that hold no ASCII white space, in UTF-8."""
    return text.encode().lower().split()


def shingle_hashes(text: str, width: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; of the whole sequence where it is shorter."""
    w = words(text)
    n = len(w)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, n)
    k = min(n, width)
    out = h[: n - k + 1].copy()
    for i in range(1, k):
        out *= _MIX
        out += h[i : n - k + 1 + i]
    if n < width:
        out += np.uint64(n)  # so that a short sequence isn't taken for a part of a shingle
    out = mixed(out)
    out.sort()
    return out[np.r_[True, out[1:] != out[:-1]]]
