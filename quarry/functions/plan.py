"""How inputs are dealt to tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, if its files are so small that they would be one task's; else as its files are.

    For rows whose work is much dearer than moving them. What is moved is one split at most, by size; a large input is
    never shuffled.
    """
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(spark.sparkContext.defaultParallelism) if size <= split else df
