"""I-Match fingerprints of documents over randomised lexicons.

A text's terms are its distinct words in lower case. Of these, the ones whose inverse document frequency lies in a
band stay: a term must occur in at least 1 of RAREST documents (and in two) and in at most 1 of MOST_FREQUENT. Document
frequencies are counted over all documents. The terms that stay are sorted and hashed as one (the classical
fingerprint), and again within SUBSETS random lexicons.

A random lexicon comes in nested sizes: half of all terms, a quarter, and so on. For each of them the
smallest that still holds a term of the text is taken, so that texts of all lengths are judged on one or two
terms per lexicon; the hash covers those terms and the size. The likeness of two fingerprints
is the share of lexicons in which they agree; it comes near the share of common terms.

Defined results: a text with fewer than LEAST_TERMS terms in the band is judged on all its terms; a text
without words on its characters, if any. Null counts as empty; two empty texts have likeness 1, an empty and another 0. Equal texts have
equal fingerprints. Order is by doc_id, null first, then by text; rows that repeat a doc_id are all there. The only row
of a table is its own next. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeshelf.llm.common import batch, mixed, shuffle_partitions, small_batches, stored, texts_of

#: The band: a term of the lexicon is in at least 1 of RAREST documents, and in at most 1 of MOST_FREQUENT. The
#: lexicon has at most RAREST times the mean number of terms of a document, whatever the number of documents.
RAREST, MOST_FREQUENT = 2000, 10
LEAST_TERMS = 4
SUBSETS = 16
_SEEDS = mixed(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_WORD = re.compile(r"[^\W_]+")
_WINDOW = 1_000_000


def terms(text: str) -> np.ndarray:
    """Sorted hashes of the distinct words of a text; of a text without words, the hash of its characters."""
    found = set(_WORD.findall(text.lower())) or ({text} if text else set())
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)))


def lexicon(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the terms in the band, from document frequencies over all documents."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("term", pa.int64()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            return batch(schema, found.view(np.int64), counts)

        for b in batches:
            for text in texts_of(b.column(0)):
                held.append(terms(text))
                size += len(held[-1])
                if size > _WINDOW:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    n = docs.count()
    frequency = docs.select("text").mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))
    inside = frequency.where((F.col("docs") >= max(2, n / RAREST)) & (F.col("docs") <= n / MOST_FREQUENT)).select("term")
    return np.sort(inside.toArrow()["term"].to_numpy().astype(np.int64).view(np.uint64))


def fingerprint(text: str, band: np.ndarray) -> np.ndarray:
    """The hash over the band, then one of each random lexicon (32 bits each); zeros for an empty text."""
    t = terms(text)
    if not len(t):
        return np.zeros(SUBSETS + 1, np.uint32)
    at = np.searchsorted(band, t)
    at[at == len(band)] = 0
    kept = t[band[at] == t] if len(band) else t[:0]
    if len(kept) < LEAST_TERMS:
        kept = t
    ranks = mixed(kept[None, :] ^ _SEEDS[:, None])
    size = np.frexp(ranks.astype(np.float64))[1]  # the nested lexicons that hold a term: the smaller, the fewer
    least = size.min(axis=1, keepdims=True)
    inside = np.where(size == least, mixed(ranks), np.uint64(0)).sum(axis=1, dtype=np.uint64)
    hashes = mixed(inside + least[:, 0].astype(np.uint64)) >> np.uint64(32)
    whole = xxhash.xxh3_64_intdigest(kept.tobytes()) >> 32
    return np.r_[np.uint32(whole), hashes.astype(np.uint32)]


def packed(prints: np.ndarray) -> bytes:
    return prints.astype(">u4").tobytes()


def shown(prints: np.ndarray) -> str:
    return packed(prints).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the random lexicons that agree."""
    if not a.any() or not b.any():
        return float(not a.any() and not b.any())
    return float((a[1:] == b[1:]).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first half as many characters of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = pa.schema([
    ("part", pa.int32()), ("edge", pa.string()), ("doc_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()),
    ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_OUT_SQL = (
    "part int, edge string, doc_id long, text string, n_chars long, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
_HEX = ["edited_sha256", "fingerprint", "edited_fingerprint"]  # bytes while they are stored, text in the result
RESULT = ["doc_id", "n_chars", *_HEX, "near_edited", "near_next"]


def _compared(doc_id, text: str, own: np.ndarray, following: str, its: np.ndarray, band: np.ndarray) -> tuple:
    changed = edited(text, following)
    prints = fingerprint(changed, band)
    return (
        doc_id, None, len(text), hashlib.sha256(changed.encode()).digest(), packed(own), packed(prints),
        likeness(own, prints), likeness(own, its),
    )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """RESULT of every row of ``docs`` (doc_id, text), each compared with the next in order of doc_id.

    Texts are shuffled once, by ranges of doc_id. The last row of each range meets the first of the next in a second
    step over two rows per range.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = spark.sparkContext.broadcast(lexicon(docs))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, part, last = shared.value, TaskContext.get().partitionId(), None
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                own = fingerprint(text, band)
                if last is None:
                    rows.append((part, "first", doc_id, text, *[None] * 6))
                else:
                    rows.append((part, None, *_compared(*last, text, own, band)))
                last = (doc_id, text, own)
            if rows:
                yield batch(_OUT, *zip(*rows))
        if last is not None:
            yield batch(_OUT, [part], ["last"], [last[0]], [last[1]], *[[None]] * 6)

    parts = max(shuffle_partitions(spark), docs.count() // 20_000)
    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    walked = stored(ordered.mapInArrow(walk, _OUT_SQL), "imatch")
    firsts = walked.where("edge = 'first'").select("part", F.col("text").alias("next_text"))
    # which range follows which: one row per range
    names = firsts.select("part").withColumn("after", F.lead("part").over(Window.orderBy("part")))
    names = names.withColumn("after", F.coalesce("after", F.min("part").over(Window.partitionBy())))
    lasts = walked.where("edge = 'last'").select("part", "doc_id", "text")
    met = lasts.join(names, "part").join(firsts.withColumnRenamed("part", "after"), "after").select("doc_id", "text", "next_text")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = shared.value
        for b in batches:
            rows = [
                (None, None, *_compared(i, t, fingerprint(t, band), u, fingerprint(u, band), band))
                for i, t, u in zip(b.column(0).to_pylist(), texts_of(b.column(1)), texts_of(b.column(2)))
            ]
            if rows:
                yield batch(_OUT, *zip(*rows))

    found = walked.where("edge IS NULL").select(*RESULT).unionByName(met.mapInArrow(meet, _OUT_SQL).select(*RESULT))
    return found.withColumns({c: F.lower(F.hex(c)) for c in _HEX})
