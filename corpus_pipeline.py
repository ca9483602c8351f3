"""From raw documents to shards of a training mix: five stages, each a Parquet table for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, group_matrix, mixing, packing, quality
from tidemark.session import write_through

SHARDS = 8


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of 5-word shingles."""
    return group_matrix.keep_one(docs, n=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, up to a fifth of its words edited."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights; documents are repeated or cut as drawn."""
    return mixing.mixed_documents(docs, shards=SHARDS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a slot for every document of the mix."""
    return packing.pack_shards(docs, SHARDS)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: SQL can state neither trained trees nor hashed draws; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_through(docs, name.replace(" ", "-"))
    return docs
