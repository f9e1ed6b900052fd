"""Mixing sources to target weights: budgets down a domain-language-source tree, then seeded token prefixes.

Native: DataFrame operations only. Whole numbers throughout, so budgets do not depend on the order of sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from quarry.llm import common as C

LEVELS = ["domain", "lang", "source"]
WEIGHTS = {"domain": {"d0": 5, "d1": 3, "d2": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {}}
SEED, BUDGET_PERCENT, MAX_EPOCHS = 20, 60, 2
#: About so many rows a bucket of the seeded order; with more than so many buckets, buckets grow instead.
BUCKET_ROWS, MAX_BUCKETS = 500, 4096
BROADCAST_LEAVES = 100_000
_BIG = "decimal(20,0)"
_SPACE = 1 << 52


def domain_of(source: Column) -> Column:
    """The domain of a source: d0 to d2 by the number that its name ends in, else "none"."""
    digits = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(digits != "", F.concat(F.lit("d"), F.pmod(digits.cast("int"), F.lit(3)))).otherwise(F.lit("none"))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    """A level's weight by label, 1 where it is not listed."""
    listed = weights.get(level) or {}
    out = F.lit(1)
    for label, weight in listed.items():
        out = F.when(F.col(level) == label, F.lit(int(weight))).otherwise(out)
    return out.cast("decimal(10,0)")


def fill(children: DataFrame, parent: list[str], label: str) -> DataFrame:
    """children with budget: their parent's budget "given" shared out by weight w, nobody over its cap.

    Children saturate in the order of cap / w. What a saturated child cannot take goes to its siblings by weight;
    only if all are saturated does the parent keep a shortage, which its own cap has told its siblings of before.
    """
    order = W.partitionBy(*parent).orderBy((F.col("cap") / F.col("w")), label)
    taken = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast(_BIG)
    weights = F.sum("w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)).cast("decimal(10,0)")
    some = children.where("w > 0").withColumns({"left": F.col("given").cast(_BIG) - taken, "rest": weights})
    some = some.withColumn("left", F.greatest(F.col("left"), F.lit(0)).cast(_BIG))
    open_ = F.col("cap").cast(_BIG) * F.col("rest") > F.col("left") * F.col("w")
    whole = W.partitionBy(*parent).orderBy((F.col("cap") / F.col("w")), label).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first = F.first(F.when(open_, F.struct("left", "rest")), ignorenulls=True).over(whole)
    some = some.withColumn("level", first)
    share = F.expr("(CAST(level.left AS decimal(20,0)) * w) div level.rest")
    return some.withColumn("budget", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), share)).cast("long")).drop("left", "rest", "level")


def budgets(leaves: DataFrame, total: int, weights: dict[str, dict[str, int]], max_epochs: int) -> DataFrame:
    """(levels..., tokens, budget) from (levels..., tokens): top down, with the subtrees' capacities known."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    given = None
    for depth, level in enumerate(LEVELS):
        path = LEVELS[: depth + 1]
        here = caps.groupBy(*path).agg(F.sum("cap").cast("long").alias("cap")).withColumn("w", _weight(level, weights))
        here = here.withColumn("given", F.lit(int(total)).cast("long")) if given is None else here.join(given, path[:-1])
        given = fill(here, path[:-1] or [F.lit(0)], level).select(*path, F.col("budget").alias("given"))
    return leaves.join(given, LEVELS).withColumnRenamed("given", "budget")


def _labelled(docs: DataFrame, key: str) -> DataFrame:
    """(row, leaf, key, n): all columns of docs as one, the leaf's labels, the key and the count of words."""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    leaf = F.struct(domain_of(none("source")).alias("domain"), none("lang").alias("lang"), none("source").alias("source"))
    return docs.select(C.row_of(docs), leaf.alias("leaf"), F.col(f"`{key}`").alias("key"), words(F.col("text")).alias("n"))


def order_key(seed: int, epoch: Column, key: Column) -> Column:
    """A document's place in an epoch, a number below 2**52."""
    text = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def mix(docs: DataFrame, weights: dict = WEIGHTS, percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """The rows of docs with _mix = (domain, lang, source, n_tokens, copies), for copies of at least 1.

    The budget is percent of all tokens (words). A leaf with budget b and t tokens has b div t whole epochs, and
    of the next epoch, in its seeded order, the documents whose running sum of tokens stays within the rest:
    no document is cut, the next one that does not fit ends the prefix. Documents without tokens cost nothing
    and are copied with the epochs whole or where the prefix reaches them. Rows with the same key in a leaf are
    chosen together or not at all. Null labels form the leaf "none"; an empty table gives no rows. A column _mix of
    docs is replaced; all others may have any names.
    """
    return mixed(docs.drop("_mix"), weights, percent, max_epochs, seed, key).select("row.*", F.col("mix").alias("_mix"))


def mixed(docs: DataFrame, weights: dict = WEIGHTS, percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """(row, mix): the rows that mix chooses, all their columns as one, and its struct."""
    named = _labelled(docs, key)
    narrow = C.materialise(named.select("leaf.*", "key", "n"))
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = C.materialise(leaves)
    total, rows, n_leaves = leaves.agg(F.sum("tokens"), F.sum("docs"), F.count(F.lit(1))).first()
    small = n_leaves <= BROADCAST_LEAVES
    share = budgets(leaves.drop("docs"), (total or 0) * percent // 100, weights, max_epochs)
    plan = share.withColumn("whole", F.expr("CASE WHEN tokens = 0 THEN 0 ELSE budget div tokens END"))
    plan = C.materialise(plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")))
    buckets = min(MAX_BUCKETS, max(1, (rows or 0) // BUCKET_ROWS))
    bucket = F.floor(F.col("h") / F.lit(_SPACE // buckets + 1)).cast("int")
    # where each leaf's prefix ends: the bucket by the buckets' sums, then the place in that bucket
    hint = (lambda d: F.broadcast(d)) if small else (lambda d: d)
    placed = narrow.join(hint(plan), LEVELS).withColumn("h", order_key(seed, F.col("whole"), F.col("key"))).withColumn("bucket", bucket)
    sums = placed.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(W.partitionBy(*LEVELS).orderBy("bucket"))
    ends = sums.withColumn("upto", upto).where("upto > rest").groupBy(*LEVELS).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("end"))
    ends = C.materialise(plan.join(ends, LEVELS, "left").select(*LEVELS, "whole", "rest", "end.bucket", "end.before"))
    last = placed.drop("rest", "whole").join(hint(ends.where("bucket is not null")), [*LEVELS, "bucket"])
    running = F.sum("n").over(W.partitionBy(*LEVELS).orderBy("h", "key")) + F.col("before")
    cuts = last.withColumn("upto", running).groupBy(*LEVELS).agg(F.min(F.when(F.col("upto") > F.col("rest"), F.struct("h", F.coalesce(F.col("key").cast("string"), F.lit("null")).alias("k")))).alias("cut"))
    final = C.materialise(ends.join(cuts, LEVELS, "left").select(F.struct(*LEVELS).alias("leaf"), F.struct("whole", "bucket", "cut").alias("p")))
    joined = named.withColumnRenamed("leaf", "own").join(hint(final), F.col("own") == F.col("leaf"))
    h = order_key(seed, F.col("p.whole"), F.col("key"))
    place = F.struct(h.alias("h"), F.coalesce(F.col("key").cast("string"), F.lit("null")).alias("k"))
    inside = F.col("p.bucket").isNull() | F.coalesce(place < F.col("p.cut"), F.lit(False))
    copies = (F.col("p.whole") + F.when(inside, 1).otherwise(0)).cast("int")
    out = joined.select("row", F.struct("leaf.*", F.col("n").alias("n_tokens"), copies.alias("copies")).alias("mix"))
    return out.where("mix.copies > 0")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """The mixture of all documents: (doc_id, domain, lang, source, n_tokens, copies); see mix.

    Null and empty texts cost nothing; null labels are "none"; repeated rows are chosen together; an empty table gives no rows.
    """
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs).select("doc_id", "_mix.*")


def _sql_level(name: str, parent: list[str], level: str, above: str | None, max_epochs: int) -> str:
    path = [*parent, level]
    cases = " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
    weight = f"CASE {cases} ELSE 1 END" if cases else "1"
    cols, over = ", ".join(path), f"PARTITION BY {', '.join(parent) or '1'} ORDER BY cap / w, {level}"
    given = f"SELECT c.*, {'g.budget' if above else 'b.total'} AS given FROM c{name} c" + (f" JOIN f{above} g USING ({', '.join(parent)})" if above else " CROSS JOIN total b")
    return f"""
c{name} AS (SELECT {cols}, sum(tokens) * {max_epochs} AS cap, {weight} AS w FROM leaves GROUP BY ALL),
g{name} AS ({given}),
o{name} AS (SELECT *, greatest(given - coalesce(sum(cap) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)::HUGEINT AS lft,
  sum(w) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS rst FROM g{name}),
l{name} AS (SELECT *, first_value(CASE WHEN cap * rst > lft * w THEN lft END IGNORE NULLS) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l, first_value(CASE WHEN cap * rst > lft * w THEN rst END IGNORE NULLS) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS r
  FROM o{name}),
f{name} AS (SELECT {cols}, (CASE WHEN l IS NULL THEN cap ELSE least(cap, (l * w) // r) END)::BIGINT AS budget FROM l{name}),"""


def sql(source: str, percent: int, max_epochs: int) -> str:
    """The mixture of a relation with the columns of documents as named sub-selects, the last of them mixed."""
    return f"""
d AS MATERIALIZED (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
  CASE WHEN regexp_extract(coalesce(source, 'none'), '([0-9]{{1,9}})$', 1) <> '' THEN 'd' || (regexp_extract(source, '([0-9]{{1,9}})$', 1)::INT % 3) ELSE 'none' END AS domain,
  coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n FROM {source}),
leaves AS MATERIALIZED (SELECT domain, lang, source, sum(n)::BIGINT AS tokens FROM d GROUP BY ALL),
total AS (SELECT (sum(tokens) * {percent} // 100)::BIGINT AS total FROM leaves),
{_sql_level("1", [], "domain", None, max_epochs)}{_sql_level("2", ["domain"], "lang", "1", max_epochs)}{_sql_level("3", ["domain", "lang"], "source", "2", max_epochs)}
p AS (SELECT *, CASE WHEN tokens = 0 THEN 0 ELSE budget // tokens END AS whole FROM leaves JOIN f3 USING (domain, lang, source)),
r AS (SELECT d.*, whole, budget - whole * tokens AS rest,
  ('0x' || substr(md5('{SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS h FROM d JOIN p USING (domain, lang, source)),
s AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id) AS upto FROM r),
mixed AS (SELECT doc_id, domain, lang, source, n AS n_tokens, (whole + (upto <= rest)::INT)::INT AS copies FROM s WHERE whole + (upto <= rest)::INT > 0)"""


ORACLE_SQL = f"WITH {sql('documents', BUDGET_PERCENT, MAX_EPOCHS)} SELECT * FROM mixed"
