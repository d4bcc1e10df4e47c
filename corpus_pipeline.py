"""A corpus pipeline of five operators, from raw documents to packed batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import mixing, packing, quality, shingles, substrings
from clickloom.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on ``labels``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ratings = labels.select(
        "doc_id", quality.graded(F.col("quality"), F.col("toxic")).alias("grade")
    )
    model = quality.trained(docs, ratings)
    return quality.graded_documents(docs, model).filter("_kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return shingles.deduplicated(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur earlier in the corpus."""
    return substrings.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, once for each time its words are taken."""
    return mixing.mixed_documents(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: bucket, batch and place."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_batches),
]

#: The classifier is learned and the mix is drawn by hashes: no SQL for the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
