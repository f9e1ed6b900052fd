"""Benchmark decontamination: item-sized windows, SimHash, multi-index Hamming blocks, exact verification.

Native: DataFrame operations only.

A document leaks an item if one of its windows, as many words as the item has, has a weighted Jaccard similarity
of at least 0.8 with it over shingles of five words (lower case), each with the weight of its count. Such a window
holds shingles of at least 0.8 of the item's weight; so pairs of document and item that share less are left out
at once, without loss. Of the others, every window that holds enough shared shingles to reach the similarity gets a
64-bit SimHash fingerprint: c common shingles of n and m make c / (n + m - c), so a window with fewer than
0.8 / 1.8 (n + m) positions of shared shingles cannot pass, wherever it begins; all others are cut, aligned with
the item or not. The fingerprints are cut into blocks of eight bits. Two within a distance
of 23 have a block that differs in at most two bits, so an index of all such neighbours of the items' blocks finds
every one; pairs beyond that are dropped and the rest compared exactly. At a similarity of 0.8 the expected
distance is 10 with a standard deviation of 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarry.llm import common as C

SHINGLE, PERCENT, BLOCKS, BITS, NEAR = 5, 80, 8, 8, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
#: A side is broadcast up to so many rows (or members of its rows' arrays), a few tens of megabytes; beyond that Spark shuffles both.
BROADCAST_ROWS = 500_000
_MASKS = [m for m in range(1 << BITS) if bin(m).count("1") <= NEAR]


def _words(text: Column) -> Column:
    """The words of a text in lower case; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _shingles(words: Column) -> Column:
    """The hashes of all windows of SHINGLE words, in order; none for fewer words."""
    last = F.size(words) - SHINGLE
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(SHINGLE))))


def _fingerprint(hashes: Column) -> Column:
    """64-bit SimHash: bit b is set if more than half of the shingles, with repetitions, have it."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda s, h: s + F.getbit(h, b).cast("int"))
        return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(bit(b)))


def _starts() -> Column:
    """All first words of windows of len words, of a document of so many words, that hold enough of the positions ps.

    A window from s holds need of them if for some i the positions ps[i] to ps[i + need - 1] lie in s to s + len - SHINGLE.
    """
    least = PERCENT * (F.least("words", "len") - SHINGLE + 1 + F.col("weight"))
    need = F.ceil(least / (100 + PERCENT)).cast("int")
    top = F.greatest(F.col("words") - F.col("len"), F.lit(0))

    def reach(i: Column) -> Column:
        low = F.greatest(F.col("ps")[i + need - 1] - F.col("len") + SHINGLE, F.lit(0))
        high = F.least(F.col("ps")[i], top)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    room = F.size("ps") - need
    at = F.when(room >= 0, F.sequence(F.lit(0), room)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform(at, reach)))


def _small(df: DataFrame, members: str | None = None) -> DataFrame:
    """df, to be broadcast if it has few rows; where rows hold an array, few of its members in all."""
    n = F.sum(F.size(members) + 1) if members else F.count(F.lit(1))
    return F.broadcast(df) if (df.agg(n).first()[0] or 0) <= BROADCAST_ROWS else df


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, k, item_id, similarity, start) for each leaked item of each document, its best window's first word.

    k is a hash of the document's text. Null or empty texts and items of fewer than five words leak nothing;
    equal rows of docs give one row; items with a null id count; an empty table on either side gives no rows.
    """
    items = benchmark.select(F.col(item).alias("item_id"), _words(F.col(item_text)).alias("w")).withColumn("h", _shingles(F.col("w"))).where(F.size("h") > 0)
    items = items.select("item_id", F.size("w").alias("len"), "h").dropDuplicates().withColumn("fp", _fingerprint(F.col("h"))).withColumn("item", F.monotonically_increasing_id())
    items = C.materialise(items)
    known = items.select("item", "len", F.size("h").alias("weight"), F.posexplode("h").alias("at", "s"))
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("k", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    spread = texts.select("doc_id", "k", _words(F.col("text")).alias("w")).select("doc_id", "k", F.size("w").alias("words"), F.posexplode(_shingles(F.col("w"))).alias("pos", "s"))
    hits = C.materialise(spread.join(_small(known), "s").select("doc_id", "k", "words", "item", "len", "weight", "at", "pos").distinct())
    # the item's weight that the document's shingles cover: a count for each of the item's positions
    pairs = hits.groupBy("doc_id", "k", "words", "item", "len", "weight").agg(F.size(F.collect_set("at")).alias("covered"), F.sort_array(F.collect_set("pos")).alias("ps"))
    likely = pairs.where(F.col("covered") * 100 >= F.col("weight") * PERCENT)
    starts = likely.select("doc_id", "k", "len", F.explode(_starts()).alias("start")).distinct()
    wanted = C.materialise(starts.groupBy(F.col("doc_id").alias("_id"), F.col("k").alias("_k")).agg(F.collect_list(F.struct("start", "len")).alias("windows")))
    found = texts.join(_small(wanted, "windows"), (F.col("k") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "k", "windows", _words(F.col("text")).alias("w"))
    cut = found.dropDuplicates(["doc_id", "k"]).select("doc_id", "k", "w", F.explode("windows").alias("at"))
    cut = cut.select("doc_id", "k", "at.start", "at.len", _shingles(F.slice("w", F.col("at.start") + 1, F.col("at.len"))).alias("wh"))
    windows = C.materialise(cut.withColumn("wfp", _fingerprint(F.col("wh"))))
    # the index: every neighbour of each block of the items' fingerprints
    block = lambda fp, b: F.call_function("shiftrightunsigned", F.col(fp), b * BITS).bitwiseAND(F.lit((1 << BITS) - 1).cast("long"))
    each = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    index = items.select("item", "len", F.explode(each).alias("b"), "fp").select("item", "len", "b", F.explode(F.array(*[F.lit(m).cast("long") for m in _MASKS])).alias("m"), block("fp", F.col("b")).alias("v"))
    index = index.select("item", "len", "b", F.col("v").bitwiseXOR(F.col("m")).alias("v"))
    probes = windows.select("doc_id", "k", "start", "len", "wfp", F.size("wh").alias("n"), F.explode(each).alias("b")).withColumn("v", block("wfp", F.col("b")))
    near = probes.join(_small(index), ["b", "v", "len"]).join(_small(items.select("item", "fp", F.size("h").alias("m"))), "item")
    near = near.where((F.bit_count(F.col("fp").bitwiseXOR(F.col("wfp"))) <= RADIUS) & (100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m")))
    near = near.select("doc_id", "k", "start", "len", "item").distinct()
    # exact: sum of the smaller counts against sum of the larger ones
    side = windows.select(F.col("doc_id").alias("_id"), F.col("k").alias("_k"), F.col("start").alias("_s"), F.col("len").alias("_len"), "wh")
    both = near.join(side, near.doc_id.eqNullSafe(F.col("_id")) & (near.k == F.col("_k")) & (near.start == F.col("_s")) & (near.len == F.col("_len"))).join(_small(items.select("item", "item_id", "h"), "h"), "item")
    count = lambda a, x: F.size(F.filter(F.col(a), lambda y: y == x))
    common = F.aggregate(F.array_intersect("wh", "h"), F.lit(0), lambda s, x: s + F.least(count("wh", x), count("h", x)))
    both = both.withColumn("common", common).withColumn("union", F.size("wh") + F.size("h") - F.col("common"))
    good = both.where(100 * F.col("common") >= PERCENT * F.col("union")).select("doc_id", "k", "item_id", (F.col("common") / F.col("union")).alias("similarity"), "start")
    best = good.groupBy("doc_id", "k", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("b"))
    return best.select("doc_id", "k", "item_id", "b.similarity", (-F.col("b.s")).alias("start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that leak no item, with their own columns, whatever their names.

    Null and empty texts leak nothing and stay; equal rows stay or go together; an empty table on either side drops nothing.
    """
    gone = C.materialise(leaks(docs, benchmark).select(F.col("doc_id").alias("id"), F.col("k").alias("hash")).distinct())
    keyed = docs.select(C.row_of(docs), F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("k"))
    return keyed.join(_small(gone), (F.col("k") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_anti").select("row.*")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: (doc_id, item_id, similarity, start) of each leak; see leaks.

    Null and empty texts give no rows, nor do empty tables; repeated rows give one; a null doc_id or item_id is an id.
    """
    found = leaks(C.small(C.table(spark, sf_dir, "documents").select("doc_id", "text")), C.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start")
