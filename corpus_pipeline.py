"""The corpus pipeline: every stage is one of the operators of ``shroud.llm``.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps; each result is written as
Parquet in the shared folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shroud.llm import decontaminate, langid, mixing, queries, sharding, simhash
from shroud.llm.common import table
from shroud.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.drop_rejected(docs, langid.train(docs, queries.bucket_of("doc_id", 4) != 2))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def reshard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with size, shard and slot in their shard."""
    return sharding.reshard(spark, docs, queries.old_shard(), queries.SHARDS)[0]


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_to_weights", mix_to_weights),
    ("reshard", reshard),
]

#: Hashed n-gram models, XXH64 fingerprints and the flow are not SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
