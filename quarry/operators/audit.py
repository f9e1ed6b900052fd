"""Audit: seeded stratified sample, blinded roster, design-weighted precision and recall."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window as W, functions as F

from quarry.functions import text as X
from quarry.operators.registry import latest

STATUSES = ["exclude", "include", "review"]
LABELS = ["yes", "no", "uncertain"]


def deduplicate(rows: DataFrame) -> DataFrame:
    """The latest row of each id by the text of observed_at, then by canonical JSON."""
    return latest(rows.withColumn("_o", F.coalesce("observed_at", F.lit(""))), "github_id", ["_o", "canonical"]).drop("_o")


def strata(frame: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(selection_status, population, sample, probability, weight) of each stratum asked for."""
    want = F.coalesce(*[F.when(F.col("selection_status") == s, F.lit(n)) for s, n in sizes.items()])
    n = frame.groupBy("selection_status").agg(F.count(F.lit(1)).alias("population")).withColumn("sample", want).where("sample IS NOT NULL")
    return n.withColumns({"probability": F.try_divide("sample", "population"), "weight": F.try_divide("population", "sample")})


def sample(frame: DataFrame, seed: int, sizes: dict[str, int], challenge: list[int] = ()) -> DataFrame:
    """The scoring key: simple random samples without replacement within strata, one seeded generator for all.

    The driver draws positions only (as many as the sample asks for); rows are found by their place in the
    stratum, which is numbered within ranges of ids and the ranges' counts.
    """
    known = {r.selection_status: r.population for r in strata(frame, dict.fromkeys(STATUSES, 0)).collect()}
    rng, places = random.Random(seed), []
    for status in sorted(sizes):
        if status not in STATUSES or sizes[status] > known.get(status, 0):
            raise ValueError(f"cannot draw {sizes[status]} of {known.get(status, 0)} rows with status {status}")
        places += [(status, p) for p in rng.sample(range(known.get(status, 0)), sizes[status])]
    spark = frame.sparkSession
    dealt = frame.repartitionByRange("selection_status", "github_id").withColumn("_part", F.spark_partition_id())
    counts = dealt.groupBy("selection_status", "_part").agg(F.count(F.lit(1)).alias("n"))
    base = counts.withColumn("_base", F.coalesce(F.sum("n").over(W.partitionBy("selection_status").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    nth = F.row_number().over(W.partitionBy("selection_status", "_part").orderBy("github_id"))
    placed = dealt.withColumn("_n", nth).join(F.broadcast(base), ["selection_status", "_part"]).withColumn("_place", (F.col("_base") + F.col("_n") - 1).cast("long"))
    drawn = spark.createDataFrame(places, "selection_status string, _place long") if places else spark.createDataFrame([], "selection_status string, _place long")
    chosen = placed.join(F.broadcast(drawn), ["selection_status", "_place"]).join(F.broadcast(strata(frame, sizes)), "selection_status")
    out = ["github_id", "name", "url", "selection_status"]
    key = chosen.select(*out, F.lit("probability").alias("sample_kind"), "population", "sample", "probability", "weight")
    if challenge:
        asked = spark.createDataFrame([(int(c),) for c in sorted(set(challenge))], "github_id long")
        missing = asked.join(frame, "github_id", "left_anti").first()
        if missing:
            raise ValueError(f"challenge id {missing.github_id} is not in the frame")
        none = [F.lit(None).cast(t).alias(n) for n, t in (("population", "long"), ("sample", "int"), ("probability", "double"), ("weight", "double"))]
        key = key.unionByName(frame.join(F.broadcast(asked), "github_id").select(*out, F.lit("challenge").alias("sample_kind"), *none))
    return key.withColumns({"seed": F.lit(seed), "case_id": X.case_id(F.lit(seed), F.col("sample_kind"), F.col("github_id"))})


def roster(key: DataFrame) -> DataFrame:
    """What annotators see."""
    return key.select("case_id", "name", "url")


def annotation_problems(annotations: DataFrame) -> DataFrame:
    """(case_id, problem) by the schema's and the evidence policy's rules."""
    a = lambda i, f: F.col(f"annotator_{i}.{f}")
    known = lambda c: F.coalesce(c.isin(*LABELS), F.lit(False))
    proof = F.coalesce((F.size("evidence") > 0) & F.forall("evidence", lambda e: e["kind"].isin("repository", "paper") & X.evidence_url(e["url"]) & X.strip(e["locator"]).isNotNull()), F.lit(False))
    problem = F.coalesce(
        F.when(X.strip(F.col("case_id")).isNull(), "case_id"), *[F.when(~known(a(i, "label")) | X.strip(a(i, "rationale")).isNull(), f"annotator_{i}") for i in (1, 2)],
        F.when(~proof, "evidence"), F.when(~known(F.col("adjudicated_label")), "adjudicated_label"),
    )
    return annotations.select("case_id", problem.alias("problem")).where("problem IS NOT NULL")


def case_problems(annotations: DataFrame, key: DataFrame) -> DataFrame:
    """(case_id, problem): missing, unexpected and repeated cases."""
    n = lambda df, c: df.groupBy("case_id").agg(F.count(F.lit(1)).alias(c))
    both = n(annotations, "a").join(n(key, "k"), "case_id", "full_outer")
    problem = F.when(F.col("a").isNull(), "missing").when(F.col("k").isNull(), "unexpected").when((F.col("a") > 1) | (F.col("k") > 1), "repeated")
    return both.select("case_id", problem.alias("problem")).where("problem IS NOT NULL")


def score(annotations: DataFrame, key: DataFrame) -> DataFrame:
    """One row: counts, weighted true and false positives and negatives, precision and recall (null over zero)."""
    joined = key.join(annotations, "case_id")
    prob = F.col("sample_kind") == "probability"
    yes, included, usable = F.col("adjudicated_label") == "yes", F.col("selection_status") == "include", prob & (F.col("adjudicated_label") != "uncertain")
    total = lambda c: F.coalesce(F.sum(F.when(usable & c, F.col("weight"))), F.lit(0.0))
    differ = F.col("annotator_1.label") != F.col("annotator_2.label")
    sums = joined.agg(
        F.count_if(prob).alias("n"), F.count_if(prob & (F.col("adjudicated_label") == "uncertain")).alias("uncertain"), F.count_if(prob & differ).alias("disagreements"), F.count_if(~prob).alias("challenge_n"),
        total(included & yes).alias("tp"), total(included & ~yes).alias("fp"), total(~included & yes).alias("fn"),
    )
    return sums.withColumns({"precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "recall": F.try_divide("tp", F.col("tp") + F.col("fn"))})


def contingency(annotations: DataFrame, key: DataFrame) -> DataFrame:
    """(selection_status, adjudicated_label, n) of the challenge cases."""
    return key.where("sample_kind = 'challenge'").join(annotations, "case_id").groupBy("selection_status", "adjudicated_label").agg(F.count(F.lit(1)).alias("n"))
