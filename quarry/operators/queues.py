"""Fair queues: interleaving, rotation, quotas, lanes and grids as ranks.

Ranks are by group. Where a group may be large, a limit on the result keeps only the first rows of each group
before anything is sorted as a whole; a limit of up to 1,000 Spark applies in each task before rows meet (WindowGroupLimit),
so a hot group is not one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def interleave(rows: DataFrame, group: Column, member: str, limit: int | None = None) -> DataFrame:
    """position: the first members of all groups, then the second ones, ..., groups and members in order."""
    ranked = rows.withColumn("_g", group).withColumn("_r", F.row_number().over(W.partitionBy("_g").orderBy(member)))
    ranked = ranked.where(F.col("_r") <= limit) if limit else ranked
    ordered = ranked.withColumn("position", F.row_number().over(W.orderBy("_r", "_g")) - 1).drop("_g", "_r")
    return ordered.where(F.col("position") < limit) if limit else ordered


def tier_round_robin(rows: DataFrame, tier: str, key: str, cursors: dict[int, int] | None = None, limit: int | None = None) -> DataFrame:
    """position: round robin over tiers; within a tier the keys after its cursor come first."""
    cursor = F.coalesce(*[F.when(F.col(tier) == t, F.lit(c)) for t, c in (cursors or {}).items()], F.lit(0))
    ranked = rows.where(F.col(tier).isNotNull()).withColumn("_r", F.row_number().over(W.partitionBy(tier).orderBy(F.col(key) <= cursor, key)))
    ranked = ranked.where(F.col("_r") <= limit) if limit else ranked
    ordered = ranked.withColumn("position", F.row_number().over(W.orderBy("_r", tier)) - 1).drop("_r")
    return ordered.where(F.col("position") < limit) if limit else ordered


def rotating_slice(rows: DataFrame, key: str, cursor, n: int) -> DataFrame:
    """The n rows after the cursor, going on from the start."""
    return rows.orderBy(F.col(key) <= F.lit(cursor), key).limit(n)


def two_pool_quota(rows: DataFrame, pool: str, key: str, pools: list[str], limit: int, cursors: dict[str, int] | None = None) -> DataFrame:
    """Up to limit rows: an equal share of each pool that has any (the first ones get the remainder), then what is left to the first pools with more."""
    cursors = cursors or {}
    n = {r[pool]: min(r["n"], limit) for r in rows.groupBy(pool).agg(F.count(F.lit(1)).alias("n")).collect() if r[pool] in pools}
    active = [p for p in pools if n.get(p)]
    quota = {p: min(n[p], limit // len(active) + (i < limit % len(active))) for i, p in enumerate(active)}
    left = limit - sum(quota.values())
    for p in active:
        more = min(left, n[p] - quota[p])
        quota[p], left = quota[p] + more, left - more
    at = lambda d, other: F.coalesce(*[F.when(F.col(pool) == p, F.lit(d.get(p, other))) for p in pools], F.lit(other))
    rank = F.row_number().over(W.partitionBy(pool).orderBy(F.col(key) <= at(cursors, 0), key))
    return rows.where(F.col(pool).isin(*pools)).withColumn("_r", rank).where(F.col("_r") <= at(quota, 0)).drop("_r")


def next_lane(lanes: DataFrame, index: str, done: str, next_index: int, n: int) -> DataFrame:
    """The next incomplete lane from next_index on, around the end."""
    return lanes.where(~F.col(done)).orderBy(F.pmod(F.col(index) - next_index, F.lit(n))).limit(1)


def next_topic(topics: DataFrame, today: str, sweep_days: int = 30) -> DataFrame:
    """Heads that were not read today come first in catalog order, then deep lanes that are open or due again."""
    head = F.coalesce(F.col("head_read") < F.lit(today).cast("date"), F.lit(True))
    deep = ~F.coalesce("deep_done", F.lit(False)) | F.coalesce(F.date_add("deep_done_on", sweep_days) <= F.lit(today).cast("date"), F.lit(False))
    mode = F.when(head, "head").when(deep, "deep")
    return topics.withColumn("mode", mode).where("mode IS NOT NULL").orderBy(F.col("mode") == "deep", "position")


def year_grid(years: DataFrame, specs: DataFrame, done: DataFrame, year: str, spec: str, group: Column) -> DataFrame:
    """Years times specs without those done; newest year first, specs interleaved by group. Both sides are catalogs."""
    ranked = specs.withColumn("_g", group).withColumn("_r", F.row_number().over(W.partitionBy("_g").orderBy(spec)))
    grid = years.select(year).distinct().crossJoin(F.broadcast(ranked)).join(done, [year, spec], "left_anti")
    return grid.withColumn("position", F.row_number().over(W.orderBy(F.col(year).desc(), "_r", "_g")) - 1).drop("_g", "_r")


def keep_newest(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The n first rows by order: what a bounded queue keeps."""
    return rows.orderBy(*order).limit(n)


def due(rows: DataFrame, now: str, ok_days: int = 365, missing_days: int = 30, error_days: int = 1) -> DataFrame:
    """Rows to be read again: never read, another name or version than then, or past their time."""
    wait = F.when(F.col("last_status").isin(200, 304), ok_days).when(F.col("last_status") == 404, missing_days).otherwise(error_days)
    fresh = (F.col("name") == F.col("name_at_fetch")) & F.coalesce(F.col("same_version"), F.lit(False))
    late = F.col("read_at").isNull() | (F.col("read_at") + F.make_dt_interval(days=wait) <= F.lit(now).cast("timestamp"))
    return rows.where(~F.coalesce(fresh, F.lit(False)) | late)
