"""Near duplicates among embeddings by product quantisation: inverted lists of residual codes, then exact cosines.

1. Equal vectors become one class each (partial aggregates, so a hot vector costs no more).
2. From a bounded sample, coarse centroids and, of the residuals, a codebook for each subspace are learned.
   Centroids nearer to each other than half the linking distance are merged: a dense group is one list, not many to visit.
3. Every class is entered in the list of its nearest centroid as codes of its residual, one byte a subspace, and visits the
   lists whose centroid is hardly farther (squared distance up to ``margin`` more). The margin is learned too: partners
   made at exactly the least cosine must be met in PROBE_SHARE of the cases, from either side.
4. In a list, a visitor's squared distance to every entry is the sum of table entries looked up by code (asymmetric
   distance). An entry's quantisation error is stored, so by the triangle inequality no pair of the list is lost:
   distance(visitor, code) <= distance(least cosine) + error holds for every linked pair.
5. Pairs that pass are compared by their exact cosine in double precision. Links are counted in the task; of the
   links only a star per group goes on to the component search, never all pairs.

A list goes to tasks in blocks of at most BLOCK_ROWS entries and visitors, so a hot list (a third of all vectors near one another) is many
tasks of bounded memory; the number of its comparisons still is the square of its distinct vectors, as exact link counts
ask for. A pair whose members visit each other's lists is counted in one of them only.

Defined results. Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Vectors of
different lengths don't link. Rows are vectors of their own, also where they repeat a vec_id; a component's id is the smallest vec_id
that isn't null (null if there is none), kept is vec_id <=> component_id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.llm.common import batch, small_batches, stored
from lakeshelf.llm.components import components

LEAST_COSINE = 0.9

#: What is learned from: so many classes at most, and so many numbers in all (32 MB), whatever the input.
SAMPLE_ROWS, SAMPLE_VALUES = 16_384, 1 << 22

#: Subspaces (fewer for short vectors), codes of each.
SUBSPACES, CODES = 16, 256

#: Lists: LISTS_SCALE x the root of the classes, at least SAMPLES_A_LIST sampled classes each.
LISTS_SCALE, SAMPLES_A_LIST = 4, 32

#: One in HELD_OUT sampled classes is kept from the learning of the lists, for the trials of the margin.
PROBE_SHARE, PROBE_TRIALS, HELD_OUT = 0.99, 8000, 8

#: Entries or visitors of a list in one task.
BLOCK_ROWS = 4096
#: Visitors compared at once: tables and distances of a few MB.
VISITORS_AT_ONCE = 256

_ITERATIONS = 8


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that very large and small numbers are safe."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


# ---------------------------------------------------------------- learning


def centres(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres; ones that lose all points stay where they are."""
    found = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(_ITERATIONS):
        nearest = closest(points, found)
        order = np.argsort(nearest, kind="stable")
        some, starts = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(points[order], starts, axis=0)
        found[some] = sums / np.diff(np.r_[starts, len(points)])[:, None]
    return found


def apart(found: np.ndarray, least: float) -> np.ndarray:
    """The centres without those nearer than ``least`` to one before them."""
    kept: list[int] = []
    for k, c in enumerate(found):
        if not kept or (((found[kept] - c) ** 2).sum(1) >= least * least).all():
            kept.append(k)
    return found[kept]


def closest(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.argmin((to * to).sum(1) - 2 * points @ to.T, axis=1)


@dataclass
class Quantiser:
    """Coarse centroids, codebooks of the residuals and the margin of the probes, for vectors of one length."""

    coarse: np.ndarray  # lists x length
    books: np.ndarray  # subspaces x codes x part of the length
    margin: float

    @staticmethod
    def trivial(length: int) -> Quantiser:
        """One list, one code that says nothing: all pairs pass to the exact comparison. For lengths not in the sample."""
        return Quantiser(np.zeros((1, length)), np.zeros((1, 1, length)), 0.0)

    @staticmethod
    def fit(sample: np.ndarray, classes: int, least_cosine: float) -> Quantiser:
        """From unit vectors; ``classes`` is how many there are in all."""
        rng, (rows, length) = np.random.default_rng(7), sample.shape
        lists = max(1, min(round(LISTS_SCALE * classes**0.5), rows // SAMPLES_A_LIST))
        held = np.arange(rows) % HELD_OUT == 0 if rows >= HELD_OUT else np.ones(rows, bool)
        trials, sample = sample[held], sample[~held] if rows >= HELD_OUT else sample
        rows = len(sample)
        coarse = apart(centres(sample, min(lists, rows), rng), (2 - 2 * least_cosine) ** 0.5 / 2)
        parts = min(SUBSPACES, length)
        made = Quantiser(coarse, np.zeros((parts, 1, -(-length // parts))), 0.0)
        residuals = made.split(sample - coarse[closest(sample, coarse)])
        made.books = np.stack([centres(residuals[:, m], min(CODES, rows), rng) for m in range(parts)])
        made.margin = made._margin(trials, least_cosine, rng)
        return made

    def _margin(self, sample: np.ndarray, least_cosine: float, rng: np.random.Generator) -> float:
        """Enough that vectors, which the lists weren't learned from, and partners at the least cosine meet in PROBE_SHARE of the trials."""
        if len(self.coarse) == 1 or sample.shape[1] == 1:
            return 0.0
        a = sample[rng.choice(len(sample), PROBE_TRIALS)]
        aside = rng.normal(size=a.shape)
        aside -= (aside * a).sum(1, keepdims=True) * a
        b = least_cosine * a + (1 - least_cosine**2) ** 0.5 * aside / np.linalg.norm(aside, axis=1, keepdims=True)

        def more(visitor: np.ndarray, entry: np.ndarray) -> np.ndarray:
            far = (self.coarse * self.coarse).sum(1) - 2 * visitor @ self.coarse.T
            return far[np.arange(len(visitor)), closest(entry, self.coarse)] - far.min(1)

        return float(np.quantile(np.minimum(more(a, b), more(b, a)), PROBE_SHARE, method="higher"))

    def split(self, residuals: np.ndarray) -> np.ndarray:
        """rows x subspaces x part of the length, with zeros where the length doesn't divide."""
        parts, _, width = self.books.shape
        return np.pad(residuals, ((0, 0), (0, parts * width - residuals.shape[1]))).reshape(len(residuals), parts, width)

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Own list (the nearest), lists to visit besides, codes, and each vector's distance from what its codes stand for."""
        far = (self.coarse * self.coarse).sum(1) - 2 * vectors @ self.coarse.T
        own = far.argmin(1)
        near = far <= far.min(1)[:, None] + self.margin
        near[np.arange(len(own)), own] = False
        visits = [np.flatnonzero(row).astype(np.int32) for row in near]
        rest = self.split(vectors - self.coarse[own])
        codes = np.stack([closest(rest[:, m], book) for m, book in enumerate(self.books)], axis=1)
        left = rest - self.books[np.arange(len(self.books)), codes]
        return own, visits, codes.astype(np.uint8), np.sqrt((left * left).sum((1, 2)))

    def distances(self, visitors: np.ndarray, codes: np.ndarray, of_list: int) -> np.ndarray:
        """Visitors x entries: from each visitor to what the entries' codes stand for, by table lookup."""
        rest = self.split(visitors - self.coarse[of_list])
        squares = np.zeros((len(visitors), len(codes)))
        for m, book in enumerate(self.books):
            table = (rest[:, m] ** 2).sum(1)[:, None] - 2 * rest[:, m] @ book.T + (book * book).sum(1)
            squares += table[:, codes[:, m]]
        return np.sqrt(np.maximum(squares, 0))


def learned(classes: DataFrame, least_cosine: float) -> dict[int, Quantiser]:
    """A quantiser for each vector length found in the sample."""
    longest, rows = classes.agg(F.max(F.size("embedding")), F.count(F.lit(1))).first()
    if not rows:
        return {}
    most = max(64, min(SAMPLE_ROWS, SAMPLE_VALUES // longest))
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(most).select("embedding").toArrow().column(0)  # bounded
    by_length: dict[int, list] = {}
    for v in sample.to_pylist():
        by_length.setdefault(len(v), []).append(v)
    share = rows / len(sample)
    return {n: Quantiser.fit(units(np.array(v)), round(len(v) * share), least_cosine) for n, v in by_length.items()}


# ---------------------------------------------------------------- on Spark


def usable_classes(vectors: DataFrame) -> DataFrame:
    """cid, embedding, copies, least: a row for each different usable vector, with its smallest vec_id; written once."""
    x = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    usable = vectors.where(F.forall("embedding", x) & F.exists("embedding", lambda v: v != 0))
    grouped = usable.groupBy("embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    return stored(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")


def encoded(classes: DataFrame, quantisers) -> DataFrame:
    """cid, copies, length, own, visits, codes, error, vector of every class; written once."""
    small_batches(classes.sparkSession, 4096)
    schema = pa.schema([
        ("cid", pa.int64()), ("copies", pa.int64()), ("length", pa.int32()), ("own", pa.int32()), ("visits", pa.list_(pa.int32())),
        ("codes", pa.binary()), ("error", pa.float64()), ("vector", pa.binary()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cids, copies, vectors = b.column(0), b.column(1), b.column(2)
            lengths = np.diff(vectors.offsets.to_numpy())
            values = vectors.values.to_numpy(zero_copy_only=False)
            starts = vectors.offsets.to_numpy()[:-1]
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                raw = values[starts[at][:, None] + np.arange(n)]
                quantiser = quantisers.value.get(int(n)) or Quantiser.trivial(int(n))
                own, visits, codes, errors = quantiser.encode(units(raw))
                yield batch(schema, cids.take(pa.array(at)), copies.take(pa.array(at)), [int(n)] * len(at), own, visits,
                            [c.tobytes() for c in codes], errors, [r.tobytes() for r in raw])

    made = classes.select("cid", "copies", "embedding").mapInArrow(
        encode, "cid long, copies long, length int, own int, visits array<int>, codes binary, error double, vector binary"
    )
    return stored(made, "vector-codes")


def dealt(codes: DataFrame) -> DataFrame:
    """Every entry and visitor for each task that it takes part in: length, list, first, second, kind, and its columns.

    A task compares a block of a list's entries with another one, or with a block of its visitors. What
    sets the blocks is a count per list, bounded by the number of lists learned.
    """
    each = lambda lists: F.explode(lists).alias("list")
    entered = codes.select("length", F.col("own").alias("list"), F.lit(1).alias("e"), F.lit(0).alias("v"))
    visited = codes.select("length", each("visits"), F.lit(0).alias("e"), F.lit(1).alias("v"))
    counts = entered.unionByName(visited).groupBy("length", "list").agg(F.sum("e").alias("entries"), F.sum("v").alias("visitors"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("int")
    lists = F.broadcast(counts.where("entries > 0").select("length", "list", blocks("entries").alias("e"), blocks("visitors").alias("v")))
    own_block = F.pmod(F.xxhash64("cid"), F.col("e")).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    held = codes.join(lists.withColumnRenamed("list", "own"), ["length", "own"]).withColumn("block", own_block)
    pairs = held.select("*", F.explode(upto("e")).alias("other"))
    among = pairs.select(
        "length", F.col("own").alias("list"), F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), F.lit(0).alias("kind"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), *_CARRIED, "codes", "error",
    )
    met = held.where("v > 0").select("*", F.explode(upto("v")).alias("other")).select(
        "length", F.col("own").alias("list"), F.col("block").alias("first"), F.col("other").alias("second"), F.lit(1).alias("kind"), F.lit(0).alias("side"), *_CARRIED, "codes", "error",
    )
    guests = codes.select("*", each("visits")).join(lists, ["length", "list"])
    guests = guests.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("v")).cast("int")).select("*", F.explode(upto("e")).alias("other"))
    visitors = guests.select(
        "length", "list", F.col("other").alias("first"), F.col("block").alias("second"), F.lit(1).alias("kind"), F.lit(1).alias("side"), "cid", "copies", "own",
        F.lit(None).cast("array<int>").alias("visits"), "vector", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"),
    )
    return among.unionByName(met).unionByName(visitors)


_CARRIED = ("cid", "copies", "own", "visits", "vector")
_FOUND = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])


def compared(pieces: DataFrame, quantisers, number: type, least_cosine: float) -> DataFrame:
    """cid, links, to: how many vectors a class links with in a task, and stars of the components found there; written once."""
    reach = np.sqrt(2 - 2 * least_cosine) + 1e-6  # distance of unit vectors at the least cosine, with room for rounding

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        rows = column.to_pylist()
        return np.frombuffer(b"".join(rows), number).reshape(len(rows), -1)

    def compare(key, rows):
        length, of_list, first, second, kind = (k.as_py() for k in key)
        quantiser = quantisers.value.get(length) or Quantiser.trivial(length)
        side = rows.column("side").to_numpy()
        entries = rows.filter(pa.array(side == 0))
        within = kind == 0 and first == second
        guests = entries if within else rows.filter(pa.array(side == 1))
        if not len(entries) or not len(guests):
            return _FOUND.empty_table()
        codes = np.frombuffer(b"".join(entries.column("codes").to_pylist()), np.uint8).reshape(len(entries), -1)
        bound = reach + entries.column("error").to_numpy()
        here, there = units(matrix(entries.column("vector"))), units(matrix(guests.column("vector")))
        ids, times = entries.column("cid").to_numpy(), entries.column("copies").to_numpy()
        guest_ids, guest_times, guest_own = (guests.column(c).to_numpy() for c in ("cid", "copies", "own"))
        visits = [set(v) for v in entries.column("visits").to_pylist()] if kind else None
        links, guest_links = np.zeros(len(ids), np.int64), np.zeros(len(guest_ids), np.int64)
        stars = []
        for at in range(0, len(guest_ids), VISITORS_AT_ONCE):
            some = slice(at, at + VISITORS_AT_ONCE)
            passed = quantiser.distances(there[some], codes, of_list) <= bound
            if within:
                passed &= guest_ids[some][:, None] < ids
            q, e = np.flatnonzero(passed.any(1)), np.flatnonzero(passed.any(0))
            if not len(q):
                continue
            linked = passed[np.ix_(q, e)] & (there[some][q] @ here[e].T >= least_cosine)
            if kind:  # a pair that meets in both members' lists counts in the list with the smaller number
                for x in np.flatnonzero(linked.any(1) & (guest_own[some][q] < of_list)):
                    own = int(guest_own[some][q][x])
                    linked[x] &= ~np.fromiter((own in visits[y] for y in e), bool, len(e))
            links[e] += linked.T.astype(np.int64) @ guest_times[some][q]
            guest_links[some][q] += linked.astype(np.int64) @ times[e]
            if linked.any():
                stars.append(_stars(linked, guest_ids[some][q], ids[e]))
        rows_ = [(ids[links > 0], links[links > 0]), (guest_ids[guest_links > 0], guest_links[guest_links > 0])]
        cids, sums = (np.concatenate([r[i] for r in rows_]) for i in range(2))
        edges = np.unique(np.concatenate(stars), axis=0) if stars else np.empty((0, 2), np.int64)
        nothing = pa.nulls(len(edges), pa.int64()), pa.nulls(len(cids), pa.int64())
        return pa.Table.from_batches([
            batch(_FOUND, pa.array(cids), pa.array(sums), nothing[1]), batch(_FOUND, pa.array(edges[:, 0]), nothing[0], pa.array(edges[:, 1]))
        ])

    found = pieces.groupBy("length", "list", "first", "second", "kind").applyInArrow(compare, "cid long, links long, to long")
    return stored(found, "vector-links")


def _stars(linked: np.ndarray, guests: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(cid, least cid it is linked to over any of these links), without itself."""
    far = np.iinfo(np.int64).max
    a, b = np.where(linked.any(1), guests, far), np.where(linked.any(0), entries, far)
    while True:
        # the least name next to each, on one side and then on the other, until nothing changes
        new_a = np.minimum(a, np.where(linked, b, far).min(1))
        new_b = np.minimum(b, np.where(linked, new_a[:, None], far).min(0))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    pairs = np.concatenate([np.stack([guests, a], 1)[a != far], np.stack([entries, b], 1)[b != far]])
    return pairs[pairs[:, 0] != pairs[:, 1]]


def near_duplicates(vectors: DataFrame, least_cosine: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    element = vectors.schema["embedding"].dataType.elementType
    if not isinstance(element, (T.FloatType, T.DoubleType)):
        vectors, element = vectors.withColumn("embedding", F.col("embedding").cast("array<double>")), T.DoubleType()
    vectors = vectors.select("vec_id", "embedding")
    classes = usable_classes(vectors)
    quantisers = spark.sparkContext.broadcast(learned(classes, least_cosine))
    number = np.float32 if isinstance(element, T.FloatType) else np.float64
    found = compared(dealt(encoded(classes, quantisers)), quantisers, number, least_cosine)
    links = found.where("links IS NOT NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.where("to IS NOT NULL").select(F.col("cid").alias("a"), F.col("to").alias("b")))
    named = classes.join(links, "cid", "left").join(groups, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    named = stored(
        named.select("cid", "comp", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-groups"
    )
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_class = classes.select("cid", "embedding").join(named, "cid").join(least, "comp")
    rows = vectors.join(of_class.select("embedding", "n_links", "component_id", F.lit(True).alias("usable")), "embedding", "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
