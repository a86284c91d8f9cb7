"""Filter interaction audit: what each filter removes, in every order, from a contingency tensor per part.

The documents are read once: their failures (a flag per filter) and their outcomes are counted per part into
a table of at most 2^k x outcomes cells, which is all that the orders need. The counts of a part are reshaped
to a 2x2x..x2 tensor (one axis a filter: passes, fails) and contracted with ``einsum``: on each axis a step
selects pass, fail or all, so that documents kept, removed, redundant and failed by one filter alone are sums
over a box of the tensor, for all orders and steps at once.

Defined results. Null text counts as empty, null source as the part ''. A null doc_id has no label and is
neither identical to a smaller doc_id nor a smaller one. Rows that repeat a doc_id are rows of their own and
don't make each other identical to a smaller one. A doc_id with several label rows has an outcome if any of
its rows has it. An empty table gives no parts and so no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.common import batch, small_batches, stored

LETTERS = ("A", "B", "C", "D", "E")
OUTCOMES = ("good", "toxic")
SPACE, SPACES = r"[\x20\x09-\x0D]+", " \t\n\x0b\f\r"

#: What a step selects on an axis of (passes, fails).
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

#: A text with more than one in so many rows is joined apart: there are at most as many of them.
HOT_SHARE = 1000

#: Parts contracted at once: 600 result rows each for five filters.
PARTS_AT_ONCE = 64


def text_flags(docs: DataFrame) -> DataFrame:
    """part, doc_id, digest and the failures A to D of every row, written once: texts are read one time."""
    trimmed = docs.select(
        F.coalesce("source", F.lit("")).alias("part"), "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("bare", F.btrim("text", F.lit(SPACES)))
    words = trimmed.withColumn("words", F.split("bare", SPACE))
    sized = words.select(
        "part", "doc_id", "text",
        F.when(F.col("bare") == "", 0).otherwise(F.size("words")).alias("size"),
        F.when(F.col("bare") == "", 0).otherwise(F.size(F.array_distinct("words"))).alias("distinct"),
    )
    return stored(
        sized.select(
            "part", "doc_id", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("digest"),
            (F.col("size") < 200).alias("A"),
            (100 * F.col("distinct") < 50 * F.col("size")).alias("B"),
            (100 * F.regexp_count("text", F.lit("[A-Z]")) > 2 * F.char_length("text")).alias("C"),
            F.col("text").rlike("[#$%&*|]").alias("D"),
        ),
        "audit-flags",
    )


def with_copies(flags: DataFrame, letter: str = "E") -> DataFrame:
    """Add the failure of rows whose text a smaller doc_id has.

    The smallest doc_id of a text is found with partial aggregates. Only texts of several rows are joined
    back; those with over a thousandth of all rows (at most a thousand texts) by broadcast, so no task gets more of one text.
    """
    named = flags.where("doc_id IS NOT NULL")
    groups = stored(
        named.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("times")).where("times > 1"),
        "audit-texts",
    )
    often = groups.where(F.col("times") * HOT_SHARE > named.count()).select("digest", "least")
    often = F.broadcast(often)  # at most HOT_SHARE rows
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).alias(letter)
    columns = [c for c in flags.columns if c != "digest"]
    hot = named.join(often, "digest").select(*columns, later)
    rest = named.join(often, "digest", "left_anti").join(groups.select("digest", "least"), "digest", "left").select(*columns, later)
    return hot.unionByName(rest).unionByName(flags.where("doc_id IS NULL").select(*columns, F.lit(False).alias(letter)))


def with_outcomes(flagged: DataFrame, labels: DataFrame, letters: Sequence[str] = LETTERS) -> DataFrame:
    """Counts n of rows by part, failures and outcomes; rows that repeat a doc_id are counted before they meet the labels."""
    counted = flagged.groupBy("doc_id", "part", *letters).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    named = counted.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    nameless = counted.where("doc_id IS NULL").withColumns({o: F.lit(False) for o in OUTCOMES})
    return (
        named.unionByName(nameless).withColumns({o: F.coalesce(F.col(o), F.lit(False)) for o in OUTCOMES})
        .groupBy("part", *letters, *OUTCOMES).agg(F.sum("n").alias("n"))
    )


class Contraction:
    """The selections of every order and step, applied to tensors of counts."""

    def __init__(self, letters: Sequence[str]):
        self.letters, k = letters, len(letters)
        self.orders = list(permutations(range(k)))
        self.own = np.array([f for order in self.orders for f in order])
        select = {what: np.empty((len(self.own), k, 2), np.int64) for what in ("kept", "removed", "failed", "alone")}
        row = 0
        for order in self.orders:
            for step, own in enumerate(order):
                for axis in range(k):
                    before = order.index(axis) < step
                    mine = axis == own
                    select["kept"][row, axis] = PASS if before or mine else ALL
                    select["removed"][row, axis] = FAIL if mine else PASS if before else ALL
                    select["failed"][row, axis] = FAIL if mine else ALL
                    select["alone"][row, axis] = FAIL if mine else PASS
                row += 1
        self.select = select
        axes = "abcdefghij"[:k]
        self.spec = f"z{axes}," + ",".join(f"s{a}" for a in axes) + "->zs"
        self.names = ["".join(letters[f] for f in order) for order in self.orders for _ in order]
        self.steps = [s + 1 for _ in self.orders for s in range(k)]

    def sums(self, counts: np.ndarray, what: str) -> np.ndarray:
        """(parts, orders x steps) from (parts, 2, 2, ..)."""
        return np.einsum(self.spec, counts, *(self.select[what][:, axis] for axis in range(len(self.letters))))

    def __call__(self, counts: np.ndarray, outcomes: Sequence[np.ndarray]) -> list[np.ndarray]:
        """kept, removed, redundant, unique_fails, lost by each outcome, shapley."""
        removed = self.sums(counts, "removed")
        shapley = np.zeros_like(removed)
        for f in range(len(self.letters)):
            at = self.own == f
            shapley[:, at] = removed[:, at].sum(axis=1, keepdims=True)
        return [
            self.sums(counts, "kept"), removed, self.sums(counts, "failed") - removed, self.sums(counts, "alone"),
            *(self.sums(o, "removed") for o in outcomes), shapley,
        ]


def interactions(counts: DataFrame, letters: Sequence[str] = LETTERS) -> DataFrame:
    """A row for each part, order of the filters and step, from ``with_outcomes``' counts.

    A part comes together as a list of at most 2^k x 4 cells; parts are dealt over tasks.
    """
    letters, k = tuple(letters), len(letters)
    small_batches(counts.sparkSession)
    cell = sum((F.col(x).cast("int") * 2 ** (k - 1 - i) for i, x in enumerate(letters)), F.lit(0))
    parts = counts.groupBy("part").agg(
        F.collect_list(F.struct(cell.alias("cell"), *OUTCOMES, "n")).alias("cells")  # bounded: distinct flags only
    )
    columns = ["kept", "removed", "redundant", "unique_fails", *(f"{o}_lost" for o in OUTCOMES), "shapley"]
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] + [(c, pa.int64()) for c in columns])

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Contraction(letters)
        for b in batches:
            for at in range(0, b.num_rows, PARTS_AT_ONCE):
                some = b.slice(at, PARTS_AT_ONCE)
                names = some.column(0).to_pylist()
                tensors = np.zeros((1 + len(OUTCOMES), len(names), 2**k), np.int64)
                for z, cells in enumerate(some.column(1).to_pylist()):
                    for c in cells:
                        tensors[0, z, c["cell"]] += c["n"]
                        for o, outcome in enumerate(OUTCOMES):
                            tensors[1 + o, z, c["cell"]] += c["n"] if c[outcome] else 0
                tensors = tensors.reshape(1 + len(OUTCOMES), len(names), *[2] * k)
                found = made(tensors[0], tensors[1:])
                rows = len(made.names)
                yield batch(schema, [n for n in names for _ in range(rows)], made.names * len(names), made.steps * len(names),
                            *(f.reshape(-1) for f in found))

    spark_type = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in columns)
    return parts.mapInArrow(contract, spark_type)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return interactions(with_outcomes(with_copies(text_flags(docs)), labels))
