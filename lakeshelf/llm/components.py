"""Connected components of a table of links, on Spark (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.common import stored


def _to_least(edges: DataFrame) -> DataFrame:
    """u, v, m: every edge with the least node next to u (u itself included); counted before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    met = _to_least(edges)
    return met.select("u", F.col("m").alias("v")).unionByName(
        met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def components(links: DataFrame) -> DataFrame:
    """cid, comp of every node of ``links`` (a, b; long): comp is the least node of its component.

    Each step halves long chains, as the steps of the published algorithm do; no node's neighbours are
    ever gathered. An empty table gives an empty result.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges = stored(_small_star(_large_star(edges)).distinct(), "links")
    return edges.select(F.col("u").alias("cid"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("cid"), F.col("v").alias("comp")).distinct()
    )
