"""Exact deduplication by a Golomb-coded exchange of fingerprints.

1. Every input task hashes its normalised texts to fingerprints of about log2(rows) + 10 bits, sorts
   them and sends each owner (a range of fingerprints) the differences in Golomb-Rice code: some 12 bits
   a document instead of its text.
2. An owner decodes the sorted lists it got, finds fingerprints that occur more than once, and replies
   with one bitmap per list.
3. The bitmaps meet the fingerprints of their task again: the documents whose bit is set are suspects.
4. Only suspects' texts are shuffled. They are grouped by their bytes, so that a false match of
   fingerprints never counts.

Defined results: a null text counts as empty, so null and empty texts are one group; texts are compared
whole after lower-casing A-Z only. The row with the largest doc_id of a group stays (null doc_ids are the
smallest); of rows that repeat a doc_id within a group all count towards the size and all are marked as
kept if theirs is the largest doc_id; ``keep_one_of_each`` keeps one of them, which the pipeline uses. An empty table gives an empty result. Further columns of the input
are ignored by ``exact_groups`` and kept by ``drop_exact_copies``.

A group that holds a third of all rows: in step 2 each task sends a fingerprint with repeats as zero
differences; in step 4 rows are counted before the shuffle, and the join that gives each row its group
has one row per group on the other side, so Spark splits the large side of a skewed partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.common import (
    ascii_lower, batch, rows_with_ids, rows_without, scratch_path, shuffle_partitions, small_batches, stored, texts_of,
)

#: Bits beyond log2(rows): about one false suspect in 2 ** SPARE_BITS documents.
SPARE_BITS = 10


# ---------------------------------------------------------------- Golomb-Rice code of a sorted list


def encode_sorted(values: np.ndarray, bits: int) -> bytes:
    """Sorted integers below ``2 ** bits`` as differences in Golomb-Rice code.

    Layout: count and parameter k (4 and 1 bytes), the k low bits of each difference, then the unary
    high parts, each ended by a 1.
    """
    n = len(values)
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    k = int(max(0, bits - max(1, n).bit_length()))
    low = (gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)
    high = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(high.sum()) + n, np.uint8)
    unary[np.cumsum(high + 1) - 1] = 1
    return n.to_bytes(4, "little") + bytes([k]) + np.packbits(low.astype(np.uint8)).tobytes() + np.packbits(unary).tobytes()


def decode_sorted(data: bytes) -> np.ndarray:
    n, k = int.from_bytes(data[:4], "little"), data[4]
    if not n:
        return np.empty(0, np.uint64)
    size = (n * k + 7) // 8
    low = np.unpackbits(np.frombuffer(data, np.uint8, size, 5), count=n * k).reshape(n, k).astype(np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=5 + size)))[:n]
    high = np.diff(ends, prepend=-1) - 1
    gaps = (high.astype(np.uint64) << np.uint64(k)) + (low << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


# ---------------------------------------------------------------- the exchange

_SENT = pa.schema([
    ("part", pa.int64()), ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("print", pa.int64()),
])
_LISTS = "part long, owner int, list binary, again binary"
_REPLIES = pa.schema([("part", pa.int64()), ("owner", pa.int32()), ("bitmap", pa.binary())])
#: A task's documents are sent in portions of this many, so that neither side holds more at once.
PORTION = 65_536


def fingerprints(docs: DataFrame, bits: int) -> DataFrame:
    """part, doc_id, text_sha256, print of every row; ``part`` names the portion of the task it came from.

    Written once, since the portions must be the same ones when the replies come back.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            texts = [t.encode() for t in texts_of(b.column(1))]
            parts = (np.arange(seen, seen + len(texts)) // PORTION) + (task << 24)
            seen += len(texts)
            prints = np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts)) >> np.uint64(64 - bits)
            yield batch(_SENT, parts, b.column(0), [hashlib.sha256(t).hexdigest() for t in texts], prints.astype(np.int64))

    rows = docs.select(F.col("doc_id").cast("long"), ascii_lower(F.col("text")).alias("text"))
    path = scratch_path(docs.sparkSession, "dedup-prints")
    schema = "part long, doc_id long, text_sha256 string, print long"
    rows.mapInArrow(hashed, schema).write.parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def suspects(prints: DataFrame, bits: int, owners: int) -> DataFrame:
    """doc_id of the rows whose fingerprint some other row has too (and of few others).

    A portion sends each of its fingerprints once, with a bit for those that it has several times, so a text in a third
    of all rows is one entry for each portion.
    """
    owners = 1 << (max(1, owners) - 1).bit_length()  # a power of two: an owner is the top bits
    shift = np.uint64(bits - owners.bit_length() + 1)

    def send(key, rows):
        values, times = np.unique(rows["print"].to_numpy().astype(np.uint64), return_counts=True)
        owner = (values >> shift).astype(np.int64)
        cuts = np.searchsorted(owner, np.arange(owners + 1))
        some = np.flatnonzero(np.diff(cuts))
        lists = [encode_sorted(values[cuts[o] : cuts[o + 1]] - (np.uint64(o) << shift), int(shift)) for o in some]
        again = [np.packbits(times[cuts[o] : cuts[o + 1]] > 1).tobytes() for o in some]
        return pa.table({
            "part": pa.array([key[0].as_py()] * len(some), pa.int64()), "owner": pa.array(some, pa.int32()),
            "list": pa.array(lists, pa.binary()), "again": pa.array(again, pa.binary()),
        })

    def reply(key, lists):
        got = [decode_sorted(x.as_py()) for x in lists["list"]]
        values, counts = np.unique(np.concatenate(got), return_counts=True)
        flags = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(g)).astype(bool) for x, g in zip(lists["again"], got)]
        twice = np.union1d(values[counts > 1], np.concatenate([g[f] for g, f in zip(got, flags)]))
        bitmaps = [np.packbits(np.isin(g, twice, assume_unique=False)).tobytes() for g in got]
        return pa.table([lists["part"].combine_chunks(), lists["owner"].combine_chunks(), pa.array(bitmaps, pa.binary())], schema=_REPLIES)

    def mark(key, rows, replies):
        values, which = np.unique(rows["print"].to_numpy().astype(np.uint64), return_inverse=True)
        cuts = np.searchsorted((values >> shift).astype(np.int64), np.arange(owners + 1))
        hit = np.zeros(len(values), bool)
        for o, bitmap in zip(replies["owner"].to_pylist(), replies["bitmap"].to_pylist()):
            own = slice(cuts[o], cuts[o + 1])
            hit[own] = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=cuts[o + 1] - cuts[o]).astype(bool)
        return rows.select(["doc_id", "print"]).filter(pa.array(hit[which]))

    sent = prints.select("part", "print").groupBy("part").applyInArrow(send, _LISTS)
    replies = sent.groupBy("owner").applyInArrow(reply, "part long, owner int, bitmap binary")
    return (
        prints.select("part", "doc_id", "print").groupBy("part")
        .cogroup(replies.groupBy("part")).applyInArrow(mark, "doc_id long, print long")
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    small_batches(spark)
    n = docs.count()
    bits = min(60, max(16, n.bit_length() + SPARE_BITS))
    prints = fingerprints(docs, bits)
    # an owner gets about two million fingerprints of some 12 bits at most
    found = suspects(prints, bits, max(shuffle_partitions(spark), n // 2_000_000))
    path = scratch_path(spark, "dedup-suspects")
    found.write.parquet(path)
    found = spark.read.schema("doc_id long, print long").parquet(path)
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    texts = rows_with_ids(texts, found.where("doc_id IS NOT NULL"))
    nulls = docs.where("doc_id IS NULL").select(F.lit(None).cast("long").alias("doc_id"), "text")
    texts = texts.unionByName(nulls).select("doc_id", ascii_lower(F.col("text")).alias("body"))
    # byte verification: the text itself is the key of the groups
    groups = texts.groupBy("body").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.where("group_size > 1").select(
        F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"
    )
    # rows of a group share their digest; a suspect that no other text equals is in no group
    return (
        prints.select("doc_id", "text_sha256").join(groups, "text_sha256", "left")
        .select(
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            "text_sha256",
        )
    )


#: Changed groups (an id and a digest) that are broadcast: some 20 MB.
BROADCAST_GROUPS = 200_000


def _packed(docs: DataFrame) -> DataFrame:
    """row (all columns, whatever their names), doc_id, digest."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.sha2(ascii_lower(F.col("text")), 256).alias("digest"))


def _named_by(rows: DataFrame, named: DataFrame):
    return rows["doc_id"].eqNullSafe(named["of_id"]) & (rows["digest"] == named["of_text"])


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    gone = exact_groups(docs).where("NOT kept").select(
        F.col("doc_id").alias("of_id"), F.col("text_sha256").alias("of_text")
    ).distinct()
    rows, gone = _packed(docs), stored(gone, "dedup-gone")
    return rows_without(rows, gone, _named_by(rows, gone), BROADCAST_GROUPS).select("row.*")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``: as ``drop_exact_copies``, and of rows that
    share the largest doc_id one, the one with the smallest hash of its columns."""
    changed = stored(
        exact_groups(docs).where("group_size > 1").groupBy(F.col("doc_id").alias("of_id"), F.col("text_sha256").alias("of_text"))
        .agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("NOT kept OR n > 1"),
        "dedup-changed",
    )
    rows = _packed(docs)
    others = rows_without(rows, changed.select("of_id", "of_text"), _named_by(rows, changed), BROADCAST_GROUPS).select("row.*")
    repeated = changed.where("kept").select("of_id", "of_text")
    if repeated.isEmpty():
        return others
    hashed = [F.col("row").getField(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    met = rows.withColumn("h", F.xxhash64(*hashed)).join(repeated, _named_by(rows, repeated))
    # each task keeps one row of a group before the shuffle
    return others.unionByName(met.groupBy("of_id", "of_text").agg(F.min_by("row", "h").alias("row")).select("row.*"))
