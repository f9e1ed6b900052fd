"""Links from papers to repositories: which papers need a second look, the queue of looks, and the sidecar of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarry.functions import text as X
from quarry.operators import registry

KEYS = ["paper_id", "normalized_repo"]
LINK = "paper_id string, paper_date string, github_url string, normalized_repo string, github_id long, link_status string, source_officiality string"


def links(papers: DataFrame, host: str = r"(?:www\.)?github\.com") -> DataFrame:
    """(LINK): unresolved links of papers (paper_id, paper_date, github_repo) whose address is a repository's."""
    rows = papers.withColumn("normalized_repo", X.strict_repository(F.col("github_repo"), host)).where("normalized_repo IS NOT NULL")
    return rows.select("paper_id", "paper_date", F.col("github_repo").alias("github_url"), "normalized_repo", F.lit(None).cast("long").alias("github_id"), F.lit("unresolved").alias("link_status"), F.lit("unverified").alias("source_officiality"))


def need_details(papers: DataFrame, queue: DataFrame, checked: DataFrame, today: Column, host: str = r"(?:www\.)?github\.com") -> DataFrame:
    """(paper_id, paper_date, attempts 0) of papers without a usable address that are neither queued nor were looked at today.

    checked: (paper_id, checked_on). A paper that was looked at on an earlier day is due again.
    """
    bare = papers.where(X.strict_repository(F.col("github_repo"), host).isNull())
    first = bare.groupBy("paper_id").agg(F.min("paper_date").alias("paper_date"))
    seen = checked.where(F.col("checked_on").cast("date") >= today.cast("date")).select("paper_id").union(queue.select("paper_id")).distinct()
    return first.join(seen, "paper_id", "left_anti").withColumn("attempts", F.lit(0))


def next_details(queue: DataFrame, after: tuple[str, str] | None, n: int) -> DataFrame:
    """The n papers after the cursor (paper_date, paper_id), going on from the start."""
    place = F.struct("paper_date", "paper_id")
    late = place <= F.struct(F.lit(after[0]).alias("paper_date"), F.lit(after[1]).alias("paper_id")) if after else F.lit(False)
    return queue.orderBy(late, "paper_date", "paper_id").limit(n)


def after_details(queue: DataFrame, answers: DataFrame, host: str = r"(?:www\.)?github\.com") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queue, links, checked ids) after answers (paper_id, ok, github_repo): a failed look counts up and stays in the queue."""
    both = queue.join(answers, "paper_id", "left")
    done = F.coalesce("ok", F.lit(False))
    left = both.where(~done).select("paper_id", "paper_date", (F.col("attempts") + F.when(F.col("ok").isNotNull(), 1).otherwise(0)).alias("attempts"))
    return left, links(both.where(done), host), both.where(done).select("paper_id")


def sidecar(old: DataFrame, new: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row a (paper, repository): the newest, with the ids that lookups found, in this run or an earlier one, over it.

    resolved: (paper_id, normalized_repo, github_id). A link that was resolved in the row that is replaced is unresolved
    again unless resolved has it, as the replacing row says.
    """
    rows = registry.upsert(old, new.dropDuplicates(KEYS), KEYS)
    found = resolved.select(*KEYS, F.col("github_id").alias("found")).dropDuplicates(KEYS)
    out = rows.join(found, KEYS, "left").withColumns({"github_id": F.coalesce("found", "github_id"), "link_status": F.when(F.col("found").isNotNull(), "resolved").otherwise(F.col("link_status"))})
    return out.drop("found")


def observed_papers(resolved: DataFrame) -> DataFrame:
    """(github_id, paper_ids): the sorted papers of every repository found."""
    return resolved.groupBy("github_id").agg(F.array_sort(F.collect_set("paper_id")).alias("paper_ids"))
