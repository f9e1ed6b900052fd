"""A corpus pipeline over documents: rules, near copies, leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import common, decontamination, jaccard, mixing, quality, sharding, sql


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or whose host is rejected."""
    common.ready(spark)
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 over five-word shingles, keep the smallest doc_id."""
    common.ready(spark)
    return jaccard.keep_one(docs, 5, 80)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    common.ready(spark)
    return decontamination.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Choose 80 percent of the words to the target weights, no document twice."""
    common.ready(spark)
    return mixing.mixed(docs, percent=80, max_epochs=1).select("row.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add each document's shard, 0 to 7, by rendezvous hashing of its doc_id."""
    common.ready(spark)
    return sharding.assign(docs, [1.0] * sharding.SHARDS)


STAGES = [("quality rules", quality_rules), ("near copies", near_copies), ("leaks", leaks), ("mixture", mixture), ("shards", shards)]
#: Brute force for small tables: all pairs that share a shingle, all windows.
ORACLE_SQL = sql.PIPELINE


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = common.fresh_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    name, last = STAGES[-1]
    return last(spark, docs, sf_dir)
