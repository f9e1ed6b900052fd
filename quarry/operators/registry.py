"""From observation log to registry: one latest row an id, with precedence, unions and evidence; views and archive.

One shuffle on the id carries partial aggregates only; the order of files and rows never matters. A hot id's
labels are made distinct before they meet (partial sets), so its history is not gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarry.functions import text as X
from quarry.operators import rules

LABELS = {"query_ids": "all_query_ids", "domains": "all_domains", "methods": "all_methods", "novelty_signals": "all_novelty_signals", "paper_ids": "paper_ids"}
#: The columns of a published view, in order; a fixed value.
VIEW = (
    "all_domains array<string>, all_methods array<string>, all_novelty_signals array<string>, all_query_ids array<string>, archived boolean, candidate_status string, "
    "candidate_rule_version string, candidate_eligible boolean, candidate_reason string, candidate_evidence array<string>, created_at string, description string, "
    "domains array<string>, evidence_signals array<string>, evidence_tier string, evidence_version string, first_observed_at string, fork boolean, forks bigint, github_id bigint, "
    "homepage string, language string, license string, methods array<string>, name string, novelty_signals array<string>, observation_count bigint, observed_at string, "
    "paper_ids array<string>, pushed_at string, query_ids array<string>, readme_blob_sha string, readme_checked_at string, readme_evidence_version string, readme_etag string, "
    "readme_sections array<string>, readme_signals array<string>, readme_status string, readme_observed_at string, readme_repository_name_at_fetch string, selection_reason string, "
    "selection_signals array<string>, selection_status string, selection_version string, stars bigint, topics array<string>, updated_at string, url string, extra_json string"
)


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that is greatest by the order columns."""
    best = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("r")
    return rows.groupBy(key).agg(best).select("r.*")


def latest_by_precedence(rows: DataFrame) -> DataFrame:
    """Search rows before queryless ones, then the latest instant, then the greatest canonical JSON."""
    return latest(rows, "github_id", ["rank", "stamp", "canonical"])


def first_seen(rows: DataFrame) -> DataFrame:
    return rows.groupBy("github_id").agg(F.min(F.struct("stamp", X.strip(F.col("observed_at")).alias("at"))).getField("at").alias("first_observed_at"), F.count(F.lit(1)).alias("observation_count"))


def label_unions(rows: DataFrame, fields: dict[str, str] = LABELS) -> DataFrame:
    """Sorted distinct labels of all rows of an id; methods as slugs."""

    def tagged(field: str) -> Column:
        shape = (lambda x: X.method_slug(X.strip(x))) if field == "methods" else X.strip
        return F.transform(F.coalesce(field, F.array().cast("array<string>")), lambda x: F.struct(F.lit(field).alias("f"), shape(x).alias("x")))

    each = [tagged(f) for f in fields]
    long = rows.select("github_id", F.explode_outer(F.concat(*each)).alias("l")).select("github_id", "l.f", "l.x").distinct()
    some = [F.array_sort(F.collect_set(F.when(F.col("f") == f, F.col("x")))).alias(out) for f, out in fields.items()]
    return long.groupBy("github_id").agg(*some)


def overlay_evidence(rows: DataFrame, evidence: DataFrame, key: str = "github_id") -> DataFrame:
    """rows with the latest README evidence; evidence of another name stays, as status stale_name."""
    best = latest(evidence, key, ["stamp", "canonical"])
    fields = ["readme_etag", "readme_blob_sha", "readme_evidence_version", "readme_signals", "readme_sections", "readme_checked_at"]
    side = best.select(F.col(key).alias("_k"), F.col("observed_at").alias("readme_observed_at"), F.col("repository_name_at_fetch").alias("readme_repository_name_at_fetch"), F.col("readme_status").alias("_s"), *fields)
    now = X.casefold(X.strip(F.coalesce(F.nullif("full_name", F.lit("")), "name")))
    then = X.casefold(X.strip(F.col("readme_repository_name_at_fetch")))
    status = F.when(now.isNotNull() & F.col("_s").isNotNull() & (now != F.coalesce(then, F.lit(""))), "stale_name").otherwise(F.col("_s"))
    return rows.join(side, rows[key] == side["_k"], "left").withColumn("readme_status", status).drop("_k", "_s")


def history(rows: DataFrame, fields: dict[str, str] = LABELS) -> DataFrame:
    """Each id's latest row with its first sight, its count and its labels over all rows, from one shuffle of partial aggregates.

    A row's labels are made a sorted set first, so that the sets of a hot id have as many members as there are different ones.
    """
    shape = lambda f: (lambda x: X.method_slug(X.strip(x))) if f == "methods" else X.strip
    own = {f"_{f}": X.sorted_set(F.transform(F.coalesce(f, F.array().cast("array<string>")), shape(f))) for f in fields}
    best = F.max_by(F.struct(*rows.columns), F.struct("rank", "stamp", "canonical")).alias("r")
    first = F.min(F.struct("stamp", X.strip(F.col("observed_at")).alias("at"))).getField("at").alias("first_observed_at")
    sets = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(f"_{f}")))).alias(out) for f, out in fields.items()]
    done = rows.withColumns(own).groupBy("github_id").agg(best, first, F.count(F.lit(1)).alias("observation_count"), *sets)
    kept = [c for c in rows.columns if c not in ("first_observed_at", "observation_count", *fields.values())]
    return done.select(*[F.col(f"r.{c}").alias(c) for c in kept], "first_observed_at", "observation_count", *fields.values())


def current_view(rows: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """The registry: latest rows, first sight, counts, unions, evidence and all rule results."""
    view = history(rows)
    if evidence is not None:
        view = overlay_evidence(view, evidence)
    return rules.candidate(rules.select(rules.relevance(view)))


def to_view(df: DataFrame) -> DataFrame:
    """The published columns, typed and in order; those that df lacks are null."""
    fields = [f.strip().rsplit(" ", 1) for f in VIEW.split(", ")]
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])


def views(view: DataFrame) -> dict[str, DataFrame]:
    """The filtered views; a missing value is not false."""
    return {"current": view.where(F.col("selection_status").eqNullSafe("include")), "candidates": view.where(F.col("candidate_eligible").eqNullSafe(True)), "repositories": view.where(F.col("fork").eqNullSafe(False))}


def selection_summary(view: DataFrame) -> DataFrame:
    """(kind, label, n): rows by status and by reason, in order."""
    each = view.select(F.explode(F.array(F.struct(F.lit("status").alias("kind"), F.col("selection_status").alias("label")), F.struct(F.lit("reason").alias("kind"), F.col("selection_reason").alias("label")))).alias("e"))
    return each.groupBy("e.kind", "e.label").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "label")


def invariants(view: DataFrame) -> list[str]:
    """What is wrong with a view: repeated ids, unknown statuses, included rows that are no candidates."""
    r = view.agg(
        (F.count(F.lit(1)) - F.count_distinct("github_id")).alias("repeated ids"), F.count_if(~F.coalesce(F.col("selection_status").isin("include", "review", "exclude"), F.lit(False))).alias("unknown status"),
        F.count_if((F.col("selection_status") == "include") & ~F.coalesce("candidate_eligible", F.lit(False))).alias("included but no candidate"),
    ).first()
    return [k for k, n in r.asDict().items() if n]


def fingerprint(files: DataFrame) -> Column | DataFrame:
    """(fingerprint,): the digest of the sorted list of (path, sha256)."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda f: F.concat(F.lit('{"path":"'), f["path"], F.lit('","sha256":"'), f["sha256"], F.lit('"}')))
    return files.agg(F.sha2(F.concat(F.lit("["), F.concat_ws(",", listed), F.lit("]")), 256).alias("fingerprint"))


def project_repository(api: DataFrame) -> DataFrame:
    """Observation columns from source responses: renamed, defaults filled, license by the first name it has."""
    license_ = F.coalesce(*[X.strip(F.col(f"license.{k}")) for k in ("spdx_id", "key", "name")])
    return api.select(
        F.col("id").alias("github_id"), X.strip(F.col("full_name")).alias("name"), X.strip(F.col("html_url")).alias("url"), *[X.strip(F.col(c)).alias(c) for c in ("description", "homepage", "language")],
        X.sorted_set(F.transform("topics", X.strip)).alias("topics"), license_.alias("license"), F.coalesce("stargazers_count", F.lit(0)).cast("long").alias("stars"), F.coalesce("forks_count", F.lit(0)).cast("long").alias("forks"),
        *[X.strip(F.col(c)).alias(c) for c in ("created_at", "pushed_at", "updated_at")], F.coalesce("archived", F.lit(False)).alias("archived"), F.coalesce("fork", F.lit(False)).alias("fork"), F.lit("candidate").alias("candidate_status"),
    )


def overlay_enrichment(base: DataFrame, enriched: DataFrame, key: str = "github_id") -> DataFrame:
    """base with every non-null field of enriched; topics are replaced even by none, a name renames."""
    side = enriched.select(F.col(key).alias("_k"), F.struct(*[c for c in enriched.columns if c != key]).alias("_e"))
    fields = [c for c in enriched.columns if c != key]
    joined = base.join(side, base[key] == side["_k"], "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_e.{c}"), F.col(c) if c in base.columns else F.lit(None)) for c in fields}).drop("_k", "_e")


# Archive links.


def conflicts(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur with different contents (column canonical)."""
    return rows.groupBy(key).agg(F.min("canonical").alias("a"), F.max("canonical").alias("b")).where("a != b").select(key)


def link_by_name(links: DataFrame, repositories: DataFrame, link_name: str = "normalized_repo_name", name: str = "name") -> DataFrame:
    """links with the github_id of the repository of that name (case folded); null where none or several have it."""
    by_name = repositories.groupBy(X.casefold(F.col(name)).alias("_n")).agg(F.min("github_id").alias("_lo"), F.max("github_id").alias("_hi"))
    sole = by_name.where("_lo = _hi").select("_n", F.col("_lo").alias("github_id"))
    return links.join(sole, X.casefold(F.col(link_name)) == F.col("_n"), "left").drop("_n")


def ambiguous_names(repositories: DataFrame, name: str = "name") -> DataFrame:
    return repositories.groupBy(X.casefold(F.col(name)).alias("name")).agg(F.count_distinct("github_id").alias("ids")).where("ids > 1")


# Set operations on pages and queues.


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new in place of those with the same keys."""
    return old.join(new, keys, "left_anti").unionByName(new, allowMissingColumns=True)


def pending(links: DataFrame, resolved: DataFrame, keys: list[str]) -> DataFrame:
    return links.join(resolved, keys, "left_anti")


def reconcile(catalog: DataFrame, saved: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, state): keep, new or retired."""
    both = catalog.select(*keys, F.lit(1).alias("_c")).distinct().join(saved.select(*keys, F.lit(1).alias("_s")).distinct(), keys, "full_outer")
    return both.select(*keys, F.when(F.col("_s").isNull(), "new").when(F.col("_c").isNull(), "retired").otherwise("keep").alias("state"))


def coverage_totals(pages: DataFrame) -> DataFrame:
    return pages.agg(*[F.sum(c).alias(c) for c in ("enumerated", "unknown_count", "not_candidate_count", "candidate_count")])


def decision_deltas(before: DataFrame, after: DataFrame, key: str = "github_id") -> DataFrame:
    """(status, delta): the change of each status's count as rows of before get new statuses."""
    b, a = before.select(key, F.col("status").alias("b")), after.select(key, F.col("status").alias("a"))
    moved = b.join(a, key).where("a != b").select(F.explode(F.array(F.struct(F.col("b").alias("status"), F.lit(-1).alias("d")), F.struct(F.col("a").alias("status"), F.lit(1).alias("d")))).alias("m"))
    return moved.groupBy("m.status").agg(F.sum("m.d").alias("delta"))


def first_wins(rows: DataFrame, key: str, seq: str, label: str) -> DataFrame:
    """The earliest row of each key, and all its labels in order of first sight as column labels."""
    first = rows.groupBy(key, label).agg(F.min(seq).alias("_s"))
    names = first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_s", label))), lambda x: x[label]).alias("labels"))
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.col(seq)).alias("r")).select("r.*").join(names, key)


def last_wins(rows: DataFrame, key: str, seq: str, names: str) -> DataFrame:
    """The last row of each key with the sorted union of an array column."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in (key, names)]), F.col(seq)).alias("r"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(names)))).alias(names)).select(key, "r.*", names)
