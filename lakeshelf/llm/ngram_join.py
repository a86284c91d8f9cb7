"""Near-duplicate join of documents: Jaccard likeness of their 5-word shingles, by signature trees.

A document is the set of its distinct shingles (64-bit hashes). Two link when
100 * |A and B| >= 75 * |A or B|.

1. Documents with equal sets form one class; a class has a 64-bit name, its number of shingles and a token
   bitmap of some two bits a shingle. All that follows is about classes.
2. Linked classes share a shingle among the first n - ceil(0.75 n) + 1 of each, in any order that all
   agree on. The order is that of the hashes, with frequent shingles last: those are counted over all
   documents first. So a class goes to few buckets, and common passages make none.
3. Each bucket's members are compared with its first member. The links found join most of what
   belongs together, since near copies meet in many buckets.
4. In buckets that still hold members of different components, a signature tree is built: nodes hold
   the OR of the bitmaps below them, the range of sizes and of components. Two trees (the bucket's with itself) are
   traversed together; a pair of nodes is pruned when the largest overlap that their bitmaps
   allow, or their sizes, rule out a link, or all below them is in one component. Pairs of documents
   that survive are verified.
5. Every candidate is verified with the full sets, so links are exact, and no pair above the threshold
   is lost: pairs left out are those already in one component.

Defined results: null and empty texts and texts without words have no shingles, are linked with nothing
and are their own component. A row with a null doc_id is linked like others, but never names a component: one that has no
doc_id at all is called null. Rows
that repeat a doc_id are each compared with their own text. Further columns are ignored. An empty table gives an empty result.

Memory: an owner of a range of shingles holds about OWNER_ROWS entries, and a tree holds the distinct classes of one
bucket and size class. Exact copies, however many, are one class and are counted before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.common import (
    batch, mixed, rows_with_ids, rows_without, shingle_hashes, shuffle_partitions, small_batches, stored, texts_of, unused,
)
from lakeshelf.llm.components import components

WIDTH, PERCENT = 5, 75
#: Entries (shingle, class) that an owner of a range of shingles gets, about.
OWNER_ROWS = 1_000_000
#: A shingle is frequent when 1 in so many documents of some window of documents has it; at most so many are kept.
FREQUENT_SHARE, FREQUENT_MOST = 512, 1 << 17
_WINDOW = 1_500_000


def _needed(n):
    """Least overlap of a set of n with any set it links to."""
    return -(-PERCENT * n // 100)


# ---------------------------------------------------------------- frequent shingles


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of frequent shingles, at most FREQUENT_MOST (1 MB), counted over all documents.

    They only set the order in which shingles are tried; results don't depend on them.
    """
    schema = pa.schema([("token", pa.int64()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(8, len(held) // FREQUENT_SHARE)
            return batch(schema, tokens[often].view(np.int64), counts[often])

        for b in batches:
            for text in texts_of(b.column(0)):
                held.append(shingle_hashes(text, WIDTH))
                size += len(held[-1])
                if size > _WINDOW:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counted = docs.select("text").mapInArrow(count, "token long, docs long").groupBy("token").agg(F.sum("docs").alias("docs"))
    top = counted.orderBy(F.desc("docs"), "token").limit(FREQUENT_MOST).select("token").toArrow()
    return np.sort(top["token"].to_numpy().astype(np.int64).view(np.uint64))


# ---------------------------------------------------------------- classes and buckets


def _bitmap(shingles: np.ndarray) -> bytes:
    """Bits at the low ends of the hashes: a power of two of them, 256 at least; two to four per shingle up to
    1024 of them, one to two beyond."""
    four, two = (1 << ((k * len(shingles)).bit_length() - 1) for k in (4, 2))
    size = max(256, min(four, 1024), two)
    bits = np.zeros(size, np.uint8)
    bits[(shingles & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _names(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set: that of its class, and one to check it with."""
    a = mixed(shingles.sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles)))
    b = np.bitwise_xor.reduce(mixed(shingles + np.uint64(len(shingles))))
    return int(a.view(np.int64)[0]), int(np.uint64(b).view(np.int64))


_SETS = "doc_id long, cid long, name long, n long, bits binary, owner int, block binary"


def _signed(docs: DataFrame, frequent: np.ndarray, owners: int) -> DataFrame:
    """A row per document (doc_id, cid, name, n, bits) and a row per block of first shingles (owner, block)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    down = np.uint64(64 - owners.bit_length() + 1)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("cid", pa.int64()), ("name", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()),
        ("owner", pa.int32()), ("block", pa.binary()),
    ])

    def blocks(tokens: list, cids: list, sizes: list) -> pa.RecordBatch:
        t, lengths = np.concatenate(tokens), [len(x) for x in tokens]
        c, n = np.repeat(np.array(cids, np.int64), lengths), np.repeat(np.array(sizes, np.int32), lengths)
        at = (t >> down).astype(np.int64) if owners > 1 else np.zeros(len(t), np.int64)
        order = np.argsort(at, kind="stable")  # a class's shingles stay together: its name then takes little room
        t, c, n, at = t[order], c[order], n[order], at[order]
        cuts = np.searchsorted(at, np.arange(owners + 1))
        some = np.flatnonzero(np.diff(cuts))
        data = [b"".join(x[cuts[o] : cuts[o + 1]].tobytes() for x in (t, c, n)) for o in some]
        nothing = [pa.nulls(len(some), f.type) for f in schema][:5]
        return pa.RecordBatch.from_arrays([*nothing, pa.array(some, pa.int32()), pa.array(data, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        tokens, cids, sizes, seen, size = [], [], [], set(), 0
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                v = shingle_hashes(text, WIDTH)
                if not len(v):
                    rows.append((doc_id, None, None, 0, None))
                    continue
                cid, name = _names(v)
                rows.append((doc_id, cid, name, len(v), _bitmap(v)))
                if cid in seen:
                    continue
                seen.add(cid)
                if len(hot):
                    at = np.searchsorted(hot, v)
                    at[at == len(hot)] = 0
                    often = hot[at] == v
                    if often.any():
                        v = np.concatenate([v[~often], v[often]])
                first = v[: len(v) - _needed(len(v)) + 1]
                tokens.append(first)
                cids.append(cid)
                sizes.append(len(v))
                size += len(first)
            if rows:
                n = len(rows)
                yield batch(schema, *zip(*rows), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()))
            if size > _WINDOW // 2:
                yield blocks(tokens, cids, sizes)
                tokens, cids, sizes, seen, size = [], [], [], set(), 0
        if tokens:
            yield blocks(tokens, cids, sizes)

    return stored(docs.select("doc_id", "text").mapInArrow(run, _SETS), "ngram-sets")


_BUCKETS = "bucket long, cid long, n int, members int, shared long"


def _buckets(signed: DataFrame) -> DataFrame:
    """bucket, cid, n, members, shared: the classes that share a first shingle; buckets with the same members are one.

    A bucket is named by a hash of its members; ``shared`` counts the shingles behind it. Sizes of classes and buckets go along, so
    nothing is joined to find them.
    """
    schema = pa.schema([
        ("bucket", pa.int64()), ("cid", pa.int64()), ("n", pa.int32()), ("members", pa.int32()), ("shared", pa.int64()),
    ])

    def meet(key, blocks):
        parts = []
        for x in blocks["block"]:
            data = x.as_py()
            k = len(data) // 20
            parts.append((np.frombuffer(data, np.uint64, k), np.frombuffer(data, np.uint64, k, 8 * k), np.frombuffer(data, np.int32, k, 16 * k)))
        tokens, cids, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
        del parts
        order = np.argsort(tokens, kind="stable")
        tokens, cids, n = tokens[order], cids[order], n[order]
        starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        lengths = np.diff(np.r_[starts, len(tokens)])
        many = np.repeat(lengths > 1, lengths)
        tokens, cids, n = tokens[many], cids[many], n[many]
        if not len(tokens):
            return schema.empty_table()
        order = np.lexsort((cids, tokens))
        tokens, cids, n = tokens[order], cids[order], n[order]
        new = np.r_[True, (tokens[1:] != tokens[:-1]) | (cids[1:] != cids[:-1])]  # classes met in several windows
        tokens, cids, n = tokens[new], cids[new], n[new]
        starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        lengths = np.diff(np.r_[starts, len(tokens)])
        names = mixed(np.add.reduceat(mixed(cids), starts) + lengths.astype(np.uint64))
        _, first, times = np.unique(names, return_index=True, return_counts=True)
        shared = np.zeros(len(starts), np.int64)
        shared[first] = times
        shared[lengths < 2] = 0
        rows = np.repeat(shared > 0, lengths)
        names, members, shared = (np.repeat(x, lengths)[rows] for x in (names, lengths, shared))
        return pa.table([names.view(np.int64), cids[rows].view(np.int64), n[rows], members.astype(np.int32), shared], schema=schema)

    blocks = signed.where("owner IS NOT NULL").select("owner", "block")
    met = blocks.groupBy("owner").applyInArrow(meet, _BUCKETS)
    return stored(met.groupBy("bucket", "cid", "n", "members").agg(F.sum("shared").alias("shared")), "ngram-buckets")


def _stars(buckets: DataFrame) -> DataFrame:
    """bucket, cid, n, members, pivot, pivot_n: every member of a bucket with the one to compare it with first.

    That is the member of which the largest part is shared with most others: in a group of edited copies, the text that they
    were made from, which is more like each of them than they are like each other. It is weighed over all buckets, so
    that those of one group agree on it.
    """
    weight = buckets.groupBy("cid", "n").agg(F.sum(F.col("shared") * F.col("members")).alias("met"))
    weight = weight.select(F.col("cid").alias("pivot"), F.col("n").alias("pivot_n"), (F.col("met") / F.col("n")).alias("weight"))
    weighed = buckets.select("bucket", F.col("cid").alias("pivot")).join(weight, "pivot")
    pivots = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "pivot", "pivot_n")).alias("best"))
    stars = buckets.join(pivots, "bucket").select("bucket", "cid", "n", "members", "best.pivot", "best.pivot_n")
    return stored(stars.where("cid <> pivot"), "ngram-stars")


# ---------------------------------------------------------------- verification


def _count_bits(rows: np.ndarray) -> np.ndarray:
    return np.bitwise_count(rows).sum(axis=-1, dtype=np.int64)


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap (words of 64 bits) brought to fewer bits: a hash's low end stays its place."""
    return bits if len(bits) == width else np.bitwise_or.reduce(bits.reshape(-1, width), axis=0)


def _may_link(n_a: int, n_b: int, a: bytes, b: bytes) -> bool:
    """Whether the bitmaps allow the overlap that a link needs."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    width = min(len(x), len(y))
    x, y = _folded(x, width), _folded(y, width)
    most = min(n_a - int(_count_bits(x & ~y)), n_b - int(_count_bits(y & ~x)))
    return (100 + PERCENT) * most >= PERCENT * (n_a + n_b)


def _short(shingles: np.ndarray) -> bytes:
    """The distinct low ends of the hashes, 16 bits each (32 of large sets), after a byte that says which."""
    if len(shingles) < 4096:
        return b"2" + np.unique(shingles.astype(np.uint16)).tobytes()
    return b"4" + np.unique(shingles.astype(np.uint32)).tobytes()


def _may_link_short(n_a: int, n_b: int, a: bytes, b: bytes) -> bool:
    """Whether the low ends allow the overlap that a link needs."""
    x, y = (np.frombuffer(s, np.uint16 if s[:1] == b"2" else np.uint32, offset=1) for s in (a, b))
    if x.dtype != y.dtype:
        x, y = np.unique(x.astype(np.uint16)), np.unique(y.astype(np.uint16))
    both = len(np.intersect1d(x, y, assume_unique=True))
    most = min(n_a - (len(x) - both), n_b - (len(y) - both))
    return (100 + PERCENT) * most >= PERCENT * (n_a + n_b)


def _sizes_fit(n_a="n_a", n_b="n_b"):
    return F.expr(f"100 * least({n_a}, {n_b}) >= {PERCENT} * greatest({n_a}, {n_b})")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that link; with them come their sizes n_a and n_b."""
    bits = {k: classes.select(F.col("cid").alias(k), F.col("bits").alias(f"bits_{k}")) for k in "ab"}
    near = pairs.where(_sizes_fit()).join(bits["a"], "a").join(bits["b"], "b")

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [_may_link(*row) for row in zip(*(b.column(i).to_pylist() for i in range(2, 6)))]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    likely = stored(
        near.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(screen, "a long, b long"), "ngram-candidates"
    )
    wanted = likely.select(F.col("a").alias("cid")).union(likely.select("b")).distinct()
    chosen = classes.join(wanted, "cid").select("cid", F.col("rep").alias("doc_id"))
    _FULL = "cid long, n long, short binary, set binary"
    sets_schema = pa.schema([("cid", pa.int64()), ("n", pa.int64()), ("short", pa.binary()), ("set", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [v for v in (shingle_hashes(t, WIDTH) for t in texts_of(b.column(1))) if len(v)]
            yield batch(
                sets_schema, [_names(v)[0] for v in found], map(len, found), [_short(v) for v in found],
                [v.tobytes() for v in found],
            )

    named = rows_with_ids(docs.select("doc_id", "text"), chosen.where("doc_id IS NOT NULL").select("doc_id")).select("doc_id", "text")
    full = named.mapInArrow(sets, _FULL)
    nameless = chosen.where("doc_id IS NULL").select("cid")
    if not nameless.isEmpty():  # no doc_id to fetch them by: all rows without one are looked through
        unnamed = docs.where("doc_id IS NULL").select("doc_id", "text").mapInArrow(sets, _FULL)
        full = full.unionByName(unnamed.join(nameless, "cid", "left_semi"))
    full = full.dropDuplicates(["cid"])
    full = stored(full, "ngram-full")

    def screen_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [_may_link_short(*row) for row in zip(*(b.column(i).to_pylist() for i in range(2, 6)))]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # a quarter of the bytes rules out nearly all that the full sets would
    ends = {
        k: full.select(F.col("cid").alias(k), F.col("n").alias(f"n_{k}"), F.col("short").alias(f"short_{k}")) for k in "ab"
    }
    shorts = likely.join(ends["b"], "b").join(ends["a"], "a")
    likely = stored(
        shorts.select("a", "b", "n_a", "n_b", "short_a", "short_b").mapInArrow(screen_short, "a long, b long"), "ngram-likely"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_sets = (
        likely.join(full.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b")
        .join(full.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a")
    )
    return with_sets.select("a", "b", "set_a", "set_b").mapInArrow(verify, "a long, b long")


# ---------------------------------------------------------------- signature trees

_LEAF, _FAN = 8, 8
#: So many of its buckets a class carries along, to tell which pairs were met before.
FIRST_BUCKETS = 4


class _Level:
    """The nodes of one level of a tree: OR of bitmaps, sizes, components, and bits that several shingles share."""

    def __init__(self, bits, low, high, slack, comp_low, comp_high):
        self.bits, self.low, self.high, self.slack = bits, low, high, slack
        self.comp_low, self.comp_high = comp_low, comp_high

    def __len__(self):
        return len(self.low)

    def above(self, fan: int) -> "_Level":
        at = np.arange(0, len(self), fan)
        return _Level(
            np.bitwise_or.reduceat(self.bits, at, axis=0), np.minimum.reduceat(self.low, at), np.maximum.reduceat(self.high, at),
            np.maximum.reduceat(self.slack, at), np.minimum.reduceat(self.comp_low, at), np.maximum.reduceat(self.comp_high, at),
        )

    def promising(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of nodes may have a link between different components below them."""
        fit = (100 * self.high[j] >= PERCENT * self.low[i]) & (100 * self.high[i] >= PERCENT * self.low[j])
        one = (self.comp_low[i] == self.comp_high[i]) & (self.comp_low[j] == self.comp_high[j]) & (self.comp_low[i] == self.comp_low[j])
        fit &= ~one
        k = np.flatnonzero(fit)
        # of a set below the first node, at most its shared bits and those common with the other node overlap
        most = np.minimum(self.slack[i[k]], self.slack[j[k]]) + _count_bits(self.bits[i[k]] & self.bits[j[k]])
        fit[k] = (100 + PERCENT) * most >= PERCENT * (self.low[i[k]] + self.low[j[k]])
        return fit


def tree_pairs(
    n: np.ndarray, comp: np.ndarray, bits: list[bytes], home: np.ndarray, place: int = 0, first: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places that may link: in different components, at least one of them at home here.

    ``first`` has a row for each member with the places, in the order of all buckets, of the buckets it is in
    first; a pair that meets in one of them before this bucket (at ``place``) is left to that one.
    """
    words = [np.frombuffer(x, np.uint64) for x in bits]
    width = min(map(len, words))
    order = np.lexsort((n, comp))
    rows = np.stack([_folded(words[k], width) for k in order])
    n, comp, home = n[order], comp[order], home[order]
    levels = [_Level(rows, n, n, n - _count_bits(rows), comp, comp)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].above(_LEAF if len(levels) == 1 else _FAN))
    i = j = np.zeros(1, np.int64)
    for depth in range(len(levels) - 2, -1, -1):
        below, fan = levels[depth], _LEAF if depth == 0 else _FAN
        found_i, found_j = [], []
        for part in range(0, len(i), 4096):  # so many pairs of nodes are opened at once
            ii = (i[part : part + 4096, None] * fan + np.arange(fan)).repeat(fan, axis=1).ravel()
            jj = np.tile(j[part : part + 4096, None] * fan + np.arange(fan), (1, fan)).ravel()
            ok = (ii < len(below)) & (jj < len(below)) & ((ii < jj) if depth == 0 else (ii <= jj))
            ii, jj = ii[ok], jj[ok]
            ok = below.promising(ii, jj)
            ii, jj = ii[ok], jj[ok]
            if depth == 0:
                ok = home[ii] | home[jj]
                ii, jj = ii[ok], jj[ok]
                a, b = rows[ii], rows[jj]
                most = np.minimum(n[ii] - _count_bits(a & ~b), n[jj] - _count_bits(b & ~a))
                ok = (100 + PERCENT) * most >= PERCENT * (n[ii] + n[jj])
                ii, jj = order[ii[ok]], order[jj[ok]]
                if first is not None and len(ii):
                    x, y = first[ii][:, :, None], first[jj][:, None, :]
                    ok = ~((x == y) & (x >= 0) & (x < place)).any(axis=(1, 2))
                    ii, jj = ii[ok], jj[ok]
                yield ii, jj
            else:
                found_i.append(ii)
                found_j.append(jj)
        if depth:
            i, j = np.concatenate(found_i), np.concatenate(found_j)
            if not len(i):
                return


def _tree_candidates(members: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: pairs of classes of different components in a bucket that the tree lets through.

    ``members`` (bucket, cid, n, members, comp). A bucket is split by size first: a class is at home in its size class
    and a guest in the next larger one, since linked sizes differ by a third at most; parts with one component, or
    without a class at home, need no tree. Buckets are ordered by size, the largest first, and a pair that meets in
    several is looked at in the first of them, as far as the FIRST_BUCKETS first buckets of both tell.
    """
    most, low = (1 << 20) - 1, (1 << 43) - 1
    place = F.shiftleft((F.lit(most) - F.least("members", F.lit(most))).cast("long"), 43).bitwiseOR(F.col("bucket").bitwiseAND(F.lit(low)))
    placed = members.withColumn("place", place)
    first = placed.groupBy("cid").agg(F.slice(F.array_sort(F.collect_list("place")), 1, FIRST_BUCKETS).alias("first"))
    grade = F.floor(F.log("n") / F.lit(float(np.log(100 / PERCENT)))).cast("int")
    homes = placed.select("bucket", "place", "cid", "n", "comp", grade.alias("grade"))
    both = F.array(
        F.struct(F.col("grade").alias("at"), F.lit(True).alias("home")), F.struct((F.col("grade") + 1).alias("at"), F.lit(False).alias("home"))
    )
    spread = stored(homes.withColumn("g", F.explode(both)).select("bucket", "place", "cid", "n", "comp", "g.at", "g.home"), "ngram-grades")
    parts = spread.groupBy("bucket", "at").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max("home").alias("lived_in"))
    parts = parts.where("lived_in AND x <> y").select("bucket", "at")
    rows = (
        spread.join(parts, ["bucket", "at"]).join(first, "cid").join(classes.select("cid", "bits"), "cid")
        .select("place", F.when(F.col("home"), F.col("at")).otherwise(-F.col("at")).alias("at"), "cid", "comp", "n", "bits", "first")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64())])

    def pairs_of(group: pa.Table) -> Iterator[pa.RecordBatch]:
        home, comp = group["at"].to_numpy() >= 0, group["comp"].to_numpy()  # a guest's part has a minus
        if group.num_rows < 2 or not home.any() or (comp == comp[0]).all():
            return
        cid = group["cid"].to_numpy()
        first = np.full((group.num_rows, FIRST_BUCKETS), -1, np.int64)
        for row, places in zip(first, group["first"].to_pylist()):
            row[: len(places)] = places
        n = group["n"].to_numpy().astype(np.int64)
        for i, j in tree_pairs(n, comp, group["bits"].to_pylist(), home, group["place"][0].as_py(), first):
            if len(i):
                i, j = np.where(cid[i] < cid[j], i, j), np.where(cid[i] < cid[j], j, i)
                yield batch(schema, cid[i], cid[j], n[i], n[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs met in several buckets of a task are given once, as far as half a million of them are held."""
        held, size = [], 0
        for b in found_in(batches):
            held.append(np.stack([c.to_numpy() for c in b.columns], axis=1))
            size += b.num_rows
            if size > 500_000:
                once = np.unique(np.concatenate(held), axis=0)
                held, size = [once], len(once)
                if size > 250_000:
                    yield batch(schema, *once.T)
                    held, size = [], 0
        if held:
            once = np.unique(np.concatenate(held), axis=0)
            yield batch(schema, *once.T)

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b] if held is None else [*held.to_batches(), b])
            if not t.num_rows:
                continue
            place, at = t["place"].to_numpy(), np.abs(t["at"].to_numpy())
            cuts = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (at[1:] != at[:-1])])
            for s, e in zip(cuts[:-1], cuts[1:]):
                if e - s > 1:
                    yield from pairs_of(t.slice(s, e - s))
            held = t.slice(cuts[-1])
        if held is not None:
            yield from pairs_of(held)

    part = [F.col("place"), F.abs("at")]
    by_group = rows.repartition(shuffle_partitions(rows.sparkSession), *part).sortWithinPartitions(*part)
    return by_group.mapInArrow(run, "a long, b long, n_a long, n_b long").distinct()


# ---------------------------------------------------------------- the join


def linked_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, cid, n), classes (cid, n, rep, bits) and components (cid, comp)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    owners = 1 << max(0, (docs.count() * 130 // OWNER_ROWS)).bit_length()
    owners = max(owners, 1 << (shuffle_partitions(spark) - 1).bit_length())
    signed = _signed(docs, frequent_shingles(docs), owners)
    rows = signed.where("owner IS NULL")
    one_name = F.when(F.min("name") == F.max("name"), F.min("doc_id")).otherwise(
        F.raise_error(F.lit("two sets of shingles have one 64-bit name")).cast("long")
    )
    classes = stored(
        rows.where("n > 0").groupBy("cid").agg(F.first("n").alias("n"), one_name.alias("rep"), F.first("bits").alias("bits")),
        "ngram-classes",
    )
    buckets = _buckets(signed)
    stars = _stars(buckets)
    pairs = stars.select(F.col("pivot").alias("a"), F.col("cid").alias("b"), F.col("pivot_n").alias("n_a"), F.col("n").alias("n_b"))
    links = stored(_verified(docs, classes, pairs.where(_sizes_fit()).distinct()), "ngram-links")
    comps = stored(components(links), "ngram-components")
    # pairs with the pivot are done: of the other members, those of buckets with several components remain
    open_members = stars.where("members > 2").join(comps, "cid", "left").select(
        "bucket", "cid", "n", "members", F.coalesce("comp", "cid").alias("comp")
    )
    mixed_buckets = open_members.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    members = stored(open_members.join(mixed_buckets.select("bucket"), "bucket"), "ngram-open")
    more = stored(_verified(docs, classes, _tree_candidates(members, classes)), "ngram-links")
    if not more.isEmpty():
        known = comps.select(F.col("cid").alias("a"), F.col("comp").alias("b"))  # what is joined stays so
        comps = stored(components(known.unionByName(more)), "ngram-components")
    return rows.select("doc_id", "cid", "n"), classes, comps


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    rows, classes, comps = linked_classes(docs)
    named = comps.join(classes.select("cid", "rep"), "cid")
    least = named.groupBy("comp").agg(F.min("rep").alias("least"))
    of_class = (
        classes.select("cid", "rep").join(named.select("cid", "comp"), "cid", "left").join(least, "comp", "left")
        .select("cid", F.coalesce("least", "rep").alias("least"))
    )
    return rows.join(of_class, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The document of each component that names it (its smallest doc_id), with the columns of ``docs``.

    Rows without a doc_id stay. Rows that repeat a doc_id stay or go together; they go if none of them names its component.
    """
    named = near_duplicates(docs).groupBy("doc_id").agg(F.max(F.col("component_id") == F.col("doc_id")).alias("named"))
    gone_id = unused("gone_id", docs.columns)
    gone = stored(named.where("NOT named").select(F.col("doc_id").alias(gone_id)), "ngram-gone")
    return rows_without(docs, gone, docs["doc_id"] == gone[gone_id])
