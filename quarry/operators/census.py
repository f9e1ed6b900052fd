"""Census pages: enumerated rows, their looked-up nodes, the three-way decision, coverage, and what is tried again.

Rows are (since, github_id, core...), since being the page that a row was enumerated on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.operators import pages, registry, rules


def enrich(core: DataFrame, nodes: DataFrame) -> DataFrame:
    """core (github_id, ...) with the fields of its node over its own, and enrichment_status enriched or unresolved.

    nodes: (github_id, node), null or incomplete where the lookup failed; only the id joins, never a place.
    """
    found = pages.project_node(nodes.select("github_id", "node")).withColumnRenamed("html_url", "url").withColumnRenamed("stargazers_count", "stars")
    extra = [c for c in found.columns if c != "github_id"]
    status = F.when(F.col("hit").isNotNull(), "enriched").otherwise("unresolved")
    hits = found.select("github_id", F.lit(True).alias("hit")).distinct()
    return registry.overlay_enrichment(core, found.select("github_id", *extra)).join(hits, "github_id", "left").withColumn("enrichment_status", status).drop("hit")


def decide(rows: DataFrame) -> DataFrame:
    """rows with candidate_status and candidate_evidence; what is not enriched is unknown."""
    return rules.decision(rows, "enrichment_status")


def keep_candidates(rows: DataFrame) -> DataFrame:
    """What a page stores: candidates alone."""
    return rows.where("candidate_status = 'candidate'")


def page_coverage(rows: DataFrame, key: str = "since") -> DataFrame:
    """One row a page: what was enumerated, enriched and decided, and which ids are to be tried again."""
    n = lambda s: F.count_if(F.col("candidate_status") == s).alias(f"{s}_count")
    hit = F.col("enrichment_status") == "enriched"
    ids = lambda c, name: F.array_sort(F.collect_list(F.when(c, F.col("github_id")))).alias(name)
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("enumerated"), F.count_if(hit).alias("enriched"), n("candidate"), n("unknown"), n("not_candidate"), ids(~hit, "retry_ids"), ids(hit, "resolved_ids"))


def to_retry(rows: DataFrame) -> DataFrame:
    """(github_id, since, attempts) of the rows that were not enriched."""
    return rows.where("enrichment_status = 'unresolved'").select("github_id", "since", F.lit(1).alias("attempts"))


def late_coverage(coverage: DataFrame, late: DataFrame, parked: DataFrame | None = None, key: str = "since") -> DataFrame:
    """coverage after rows were resolved late (since, github_id, candidate_status); a row counts once, however often it comes.

    parked (since, github_id) are given up: they leave retry_ids and stay unresolved.
    """
    fresh = late.dropDuplicates(["github_id"]).join(coverage.select(key, "resolved_ids"), key).where(~F.array_contains("resolved_ids", F.col("github_id"))).drop("resolved_ids")
    n = lambda s: F.count_if(F.col("candidate_status") == s).alias(f"d_{s}")
    moved = fresh.groupBy(key).agg(F.array_sort(F.collect_list("github_id")).alias("done"), n("candidate"), n("unknown"), n("not_candidate"))
    gone = (parked if parked is not None else late.limit(0)).groupBy(key).agg(F.collect_set("github_id").alias("gone"))
    both = coverage.join(moved, key, "left").join(gone, key, "left")
    none = F.array().cast("array<bigint>")
    done, out = F.coalesce("done", none), F.coalesce("gone", none)
    d = lambda s: F.coalesce(f"d_{s}", F.lit(0))
    return both.select(
        key, "enumerated", (F.col("enriched") + F.size(done)).alias("enriched"), (F.col("candidate_count") + d("candidate")).alias("candidate_count"),
        (F.col("unknown_count") + d("unknown") - F.size(done)).alias("unknown_count"), (F.col("not_candidate_count") + d("not_candidate")).alias("not_candidate_count"),
        F.array_except(F.array_except("retry_ids", done), out).alias("retry_ids"), F.array_sort(F.array_union("resolved_ids", done)).alias("resolved_ids"),
    )


def topic_rows(rows: DataFrame, topic: str = "topic", head: str = "head") -> DataFrame:
    """Rows of topic pages, one an id and page, no forks: a head page's topic joins the row's topics; topic_names says where it was met."""
    tagged = F.when(F.col(head), F.array_sort(F.array_distinct(F.concat(F.coalesce("topics", F.array().cast("array<string>")), F.array(topic))))).otherwise(F.col("topics"))
    kept = rows.dropDuplicates(["page", "github_id"]).where(~F.coalesce("fork", F.lit(False)))
    out = rules.decision(kept.withColumn("topics", tagged).withColumns({"queryless": F.lit(True), "discovery_source": F.lit("topic"), "topic_names": F.array(topic)}))
    return out.drop(head)
