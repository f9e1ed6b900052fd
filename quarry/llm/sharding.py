"""Sharding by weighted rendezvous hashing of stable record keys.

Each (key, shard) pair has a uniform number u from a digest; a record goes to the shard with the largest
weight / -ln(u). A new shard only takes records, because the other shards' scores stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from quarry.llm import common as C

SHARDS = 8
ROWS_PER_BUCKET = 100_000


def score(key: Column, shard: int, weight: float) -> Column:
    digest = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"#{shard}"))), 1, 13), 16, 10).cast("long")
    return F.lit(float(weight)) / -F.ln((digest + F.lit(0.5)) / F.lit(float(1 << 52)))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of a key (null: as the text "null"); the lower shard wins a tie, shards without weight get nothing."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    live = [F.struct(score(key, i, w).alias("s"), F.lit(-i).alias("i")) for i, w in enumerate(weights) if w > 0]
    return (-(F.greatest(*live) if len(live) > 1 else live[0])["i"]).cast("int")


def assign(docs: DataFrame, weights: list[float], key: str = "doc_id") -> DataFrame:
    """docs with a column shard; rows with equal keys share a shard. No shuffle.

    A null key is a key of its own; texts do not matter; an empty table gives no rows. A column shard of docs is
    replaced, in its place; all others may have any names.
    """
    return docs.withColumn("shard", rendezvous(F.col(f"`{key}`"), weights))


def slots(rows: DataFrame, order: list[str], buckets: int) -> DataFrame:
    """rows with slot, 0, 1, 2, ... within each shard by the order given, without a task that holds a whole shard.

    Rows are dealt out by range; counts by (range, shard) give each part's first slot, and row numbers within
    a part follow. Rows that are alike in all order columns take slots in any order.
    """
    dealt = C.materialise(rows.repartitionByRange(buckets, *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("shard", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inner = F.row_number().over(W.partitionBy("shard", "_part").orderBy(*order))
    numbered = dealt.withColumn("_nth", inner)
    return numbered.join(base, ["shard", "_part"]).withColumn("slot", (F.col("_base") + F.col("_nth") - 1).cast("long")).drop("_part", "_nth", "_base")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 of equal weight by the law `key`, and the shard with a ninth added.

    Null texts count as empty; a null doc_id is a key of its own; repeated doc_ids share a shard and take
    neighbouring slots by checksum and size.
    """
    docs = C.table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    sharded = narrow.withColumns({"shard": rendezvous(F.col("doc_id"), [1.0] * SHARDS), "grown_shard": rendezvous(F.col("doc_id"), [1.0] * (SHARDS + 1))})
    buckets = max(8, narrow.count() // ROWS_PER_BUCKET)
    out = slots(sharded, ["doc_id", "text_crc32", "size"], buckets)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

