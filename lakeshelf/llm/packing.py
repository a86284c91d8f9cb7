"""Packing documents into batches by length buckets with the least padding.

Documents longer than ``longest`` are cut into pieces of that many tokens (all are kept). The histogram of
piece lengths over all documents, at most ``longest`` numbers, decides: dynamic programming finds the upper bounds of
``buckets`` buckets for which padding every piece to its bucket's bound wastes fewest tokens. In a bucket, batches
are formed of as many pieces as fit ``budget`` padded tokens, in a seeded order.

Places in a bucket are counted in ranges of that order first and inside each range after, so that a bucket with
a third of all pieces is never numbered in one task.

Defined results: null and empty texts are one piece of no tokens and go to the smallest bucket; equal lengths share a bucket;
rows that repeat a doc_id are packed each. Where fewer lengths occur than ``buckets``, each has its own bucket; of equally good
bounds the smaller ones are taken. An empty table gives an empty result. Further columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshelf.llm.common import stored

LONGEST, BUCKETS, BUDGET = 4096, 16, 65_536
SEED = 5
RANGE_ROWS = 20_000


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Ascending upper bounds, at most ``buckets`` of them, with the least total padding.

    ``cost[j]``: least padding of the first j lengths with the buckets so far. Adding a bucket over lengths i..j-1
    costs bound * pieces - tokens there.
    """
    order = np.argsort(lengths)
    lengths, counts = lengths[order].astype(np.float64), counts[order].astype(np.float64)
    n = len(lengths)
    if not n:
        return []
    pieces, tokens = np.r_[0.0, np.cumsum(counts)], np.r_[0.0, np.cumsum(counts * lengths)]
    cost = np.r_[0.0, np.full(n, np.inf)]
    choice = []
    for _ in range(min(buckets, n)):
        new, came = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        for j in range(1, n + 1):
            options = cost[:j] + lengths[j - 1] * (pieces[j] - pieces[:j]) - (tokens[j] - tokens[:j])
            came[j] = int(np.argmin(options))
            new[j] = options[came[j]]
        cost = new
        choice.append(came)
    bounds, j = [], n
    for came in reversed(choice):
        if j:
            bounds.append(int(lengths[j - 1]))
            j = int(came[j])
    return bounds[::-1]


def pieces(docs: DataFrame, tokens: Column, longest: int = LONGEST) -> DataFrame:
    """doc_id, piece, start, n_tokens: the documents cut to at most ``longest`` tokens."""
    sized = docs.select("doc_id", F.coalesce(tokens, F.lit(0)).cast("long").alias("total"))
    last = F.greatest(F.ceil(F.col("total") / longest) - 1, F.lit(0)).cast("long")
    return sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "doc_id", "piece", (F.col("piece") * longest).alias("start"),
        F.least(F.col("total") - F.col("piece") * longest, F.lit(longest)).alias("n_tokens"),
    )


def pack(docs: DataFrame, tokens: Column, longest: int = LONGEST, buckets: int = BUCKETS, budget: int = BUDGET, seed: int = SEED) -> DataFrame:
    """A row per piece: doc_id, piece, start, n_tokens, bucket_length, batch, slot.

    ``batch`` numbers the batches of all buckets, ``slot`` the places in a batch from 0.
    """
    cut = pieces(docs, tokens, longest).withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "piece"))
    cut = stored(cut, "pack-pieces")
    histogram = cut.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # longest + 1 rows at most
    lengths, counts = (np.array([r[k] for r in histogram], np.int64) for k in (0, 1))
    bounds = best_bounds(lengths, counts, buckets)
    # a length's bucket is the first bound that is not below it
    bucket = F.lit(bounds[-1] if bounds else 0)
    for bound in reversed(bounds[:-1]):
        bucket = F.when(F.col("n_tokens") <= bound, bound).otherwise(bucket)
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))))
    shift = 64 - max(1, (int(counts.sum()) // RANGE_ROWS).bit_length())
    placed = cut.withColumn("bucket_length", bucket.cast("long")).withColumn("range", F.shiftrightunsigned("h", shift))
    ranges = placed.groupBy("bucket_length", "range").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("bucket_length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
    # the first batch of each bucket: over one row per bucket
    batches = ranges.groupBy("bucket_length").agg(F.sum("n").alias("n")).withColumn("batches", F.ceil(F.col("n") / capacity))
    earlier = Window.orderBy("bucket_length").rowsBetween(Window.unboundedPreceding, -1)
    batches = batches.select("bucket_length", F.coalesce(F.sum("batches").over(earlier), F.lit(0)).alias("first_batch"))
    offsets = ranges.join(batches, "bucket_length").select("bucket_length", "range", "before", "first_batch")
    inside = Window.partitionBy("bucket_length", "range").orderBy("h", "doc_id", "piece", "n_tokens")
    numbered = placed.withColumn("place", F.row_number().over(inside) - 1).join(offsets, ["bucket_length", "range"])
    place = F.col("before") + F.col("place")
    return numbered.select(
        "doc_id", "piece", "start", "n_tokens", "bucket_length",
        (F.col("first_batch") + F.floor(place / capacity)).cast("long").alias("batch"),
        (place % capacity).cast("long").alias("slot"),
    )
