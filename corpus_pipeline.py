"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
documents that contain benchmark items go, sources are mixed to their target weights, and the
result is shuffled into shards.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before has kept; all but
the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontamination, mixing, sharding, simhash, toxicity
from feedloom.llm.common import ship
from feedloom.llm.queries import mix_weight
from feedloom.sources.files import delete_folder, shared_folder

SHARDS = 24


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the classifier learnt from the labels."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(
        docs.select("doc_id", "text"), labels.select("doc_id", F.col("toxic").alias("label")),
        ~toxicity.held_out("doc_id"))
    return docs.where(toxicity.toxicity(F.col("text"), model) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by 3 bits or fewer."""
    ship(spark)
    return simhash.keep_one(docs, length=3, bits=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 0.8 of the shingles of every benchmark item."""
    ship(spark)
    return decontamination.decontaminate(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship(spark)
    return mixing.mixed_rows(docs, mix_weight, share=1.5, cap=2, seed=8)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with ``shard`` and ``slot``."""
    ship(spark)
    return sharding.shuffle_into_shards(docs, SHARDS, seed=2)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The classifier, the fingerprints and the draws have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each result is written as Parquet into a new folder next to the
    checkpoints, which all executors can reach, and read again. A stage's folder goes when the next one
    is written; the last one is the caller's to keep."""
    folder, before = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}", None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return docs
