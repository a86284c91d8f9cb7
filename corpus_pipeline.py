"""A corpus pipeline in five stages: language ID, exact dedup, near-duplicate join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to the shared
folder and reads back as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm import exact_dedup, language_id, mixing, ngram_join, packing
from lakeshelf.llm.common import stored
from lakeshelf.llm.registry import query


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a known language; learned from the labelled rows among them."""
    return language_id.keep_known(docs, language_id.fit(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, with the largest doc_id, of each group of equal texts."""
    return exact_dedup.keep_one_of_each(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near copies."""
    return ngram_join.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their targets."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut and batch the documents (tokens: words): doc_id, piece, start, n_tokens, bucket_length, batch, slot."""
    return packing.pack(docs, mixing.word_count(F.col("text")))


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: The first and third stage can't be written in SQL; tests compare all with brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
