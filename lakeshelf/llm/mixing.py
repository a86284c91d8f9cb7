"""Mixing sources to target weights by capped water-filling, with DataFrame operations only.

A target is what a source should give to the mix. Sources share the total in proportion to their
weights; a source never gives more than ``max_epochs`` times its size, and what it can't give is shared
by the others in proportion to their weights, until no source is above its cap. The fixed point of that
redistribution is found in one go: with sources in ascending order of cap / weight, the capped ones
come first, and the level of the rest is what is left over the weights that are left.

A document is then taken as a whole, ``whole`` times each, and once more for the first documents of its
source in a seeded order, until the fractional part of the target is reached, to the nearest document.
That order is a hash of the seed and doc_id; the last document of it is found with sums over ranges of
the hash first and inside one range after, so that a source with a third of all rows is never sorted in
one task. What decides is one row per source (``whole``, ``cut``), so no text is shuffled.

Defined results: a null text has size 0; null sources are one source, ordered last; documents without
words are taken 0 words (they count as taken like others in ``mix``); rows with the same doc_id and source
share their hash and so their fate; a mix without words has targets 0; an empty table gives an empty
result. Columns of the input keep their names; those added here are chosen not to clash in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshelf.llm.common import stored

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 20
#: Documents in a range of hashes, about; only sets how work is split.
RANGE_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space, counted by their starts."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def seeded(doc_id: Column, seed: int) -> Column:
    """60 bits of a hash of the seed and doc_id (null: empty)."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size and the seeded hash of every row, written once: texts are read one time."""
    return stored(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), seeded(F.col("doc_id"), seed).alias("h")
        ),
        "mix-sizes",
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, n_rows, target.

    The windows run over rows of sources, never of documents.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    everything = Window.partitionBy()
    level_order = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = level_order.rowsBetween(Window.unboundedPreceding, -1)
    weighed = per_source.withColumn("weight", weight).withColumn("cap", max_epochs * F.col("source_size"))
    levels = (
        weighed.withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("place", F.row_number().over(level_order))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("spent")) / F.col("left"))
        # the level holds from the first source on that can give its share
        .withColumn("final", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything))
    )
    share = F.col("final.level") * F.col("weight")
    target = F.when(share <= F.col("cap"), share).otherwise(F.col("cap").cast("double"))
    return levels.select("source", "source_size", "n_rows", F.coalesce(target, F.lit(0.0)).alias("target"))


HASH_BITS = 60


def decisions(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: source, source_size, target, whole, cut.

    Every document is taken ``whole`` times, those with a hash up to ``cut`` (if any) once more.
    """
    n = sizes.count()
    shift = HASH_BITS - max(1, (n // RANGE_ROWS).bit_length())
    epochs = F.try_divide(F.col("target"), F.col("source_size"))
    plan = targets.select(
        "source", "source_size", "target",
        F.coalesce(F.floor(epochs), F.lit(0)).cast("long").alias("whole"),
    ).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    # words per hash: rows with one doc_id go together
    spots = sizes.groupBy("source", F.shiftright("h", shift).alias("range"), "h").agg(F.sum("size").alias("words"))
    spots = stored(spots, "mix-spots")
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = spots.groupBy("source", "range").agg(F.sum("words").alias("range_words"))
    started = sums.withColumn("before", F.coalesce(F.sum("range_words").over(along), F.lit(0)))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    reached = (
        started.alias("s").join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
        .where((F.col("before") < F.col("extra")) & (F.col("before") + F.col("range_words") >= F.col("extra")))
        .select(F.col("s.source").alias("source"), "range", "before", "extra")
    )
    inside = Window.partitionBy("source").orderBy("h")
    r, k = reached, spots.withColumnRenamed("source", "of").withColumnRenamed("range", "at")
    # the documents of one range of each source; a range holds about RANGE_ROWS documents
    walked = (
        k.join(r, k["of"].eqNullSafe(r["source"]) & (k["at"] == r["range"]))
        .withColumn("end", F.col("before") + F.sum("words").over(inside))
        # the document that passes the mark is taken if that comes nearer to it
        .where(F.col("end") - F.col("words") / 2 <= F.col("extra"))
        .groupBy("source").agg(F.max("h").alias("cut"))
    )
    # where even the first document of the range is too much, the ones before the range are taken
    floors = reached.select("source", (F.shiftleft("range", shift) - 1).alias("floor_cut"))
    cuts = floors.join(walked, same(floors, walked), "left").select(
        floors["source"].alias("source"), F.coalesce(walked["cut"], F.col("floor_cut")).alias("cut")
    )
    return plan.join(cuts, same(plan, cuts), "left").select(
        plan["source"].alias("source"), "source_size", "target", "whole", "cut"
    )


def taken_times(h: Column) -> Column:
    return F.col("whole") + F.when(h <= F.col("cut"), 1).otherwise(0)


def plan_mix(docs: DataFrame, weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, times."""
    sizes = sized(docs, seed)
    chosen = stored(decisions(sizes, source_targets(sizes, weights, max_epochs)), "mix-plan")
    return sizes.join(chosen.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of"))).select(
        "doc_id", "source", "size", "source_size", "target", taken_times(F.col("h")).cast("long").alias("times")
    )


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED) -> DataFrame:
    """The mixed rows, with the columns of ``docs``; a row that is taken twice is there twice."""
    sizes = sized(docs, seed)
    chosen = stored(decisions(sizes, source_targets(sizes, weights, max_epochs)), "mix-plan")
    plan = chosen.select(F.col("source").alias("of"), "whole", "cut")
    rows = docs.select(F.struct("*").alias("row"), "source", seeded(F.col("doc_id"), seed).alias("h"))  # whatever its columns are called
    copies = F.array_repeat(F.lit(1), (F.col("whole") + F.when(F.col("h") <= F.col("cut"), 1).otherwise(0)).cast("int"))
    return rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).select("row", F.explode(copies).alias("copy")).select("row.*")
