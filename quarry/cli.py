"""Commands: python -m quarry.cli COMMAND ... Errors of input exit with 2 and leave earlier outputs as they are.

Remote commands take --client module:function, which makes the client for the walk; state is a JSON file in any store.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession, functions as F

from quarry.functions import patterns as P
from quarry.operators import audit, census as census_ops, papers, queues, readings, registry, rules
from quarry.sources import catalogs, jsonl, paged
from quarry.streaming import ledger

SECTIONS = [*P.R_SECTIONS, "other"]
SIGNALS = sorted({
    *P.PROBABLE, "paper-reference", "ml-method-context", "course-cue", "reproduction-cue", "survey-cue", "model-training-artifact",
    "paper-code-relationship", "method-contribution", "official-implementation-claim", "dataset-only-cue",
})


def _view(spark: SparkSession, a):
    rows = jsonl.require(*jsonl.observations(spark, a.observations), a.quarantine)
    proof = jsonl.require(*jsonl.evidence(spark, a.evidence, a.evidence_versions, SIGNALS, SECTIONS), a.quarantine) if a.evidence else None
    return rows, registry.current_view(rows, proof)


def current_view(spark, a):
    _, view = _view(spark, a)
    registry.to_view(view).write.mode("overwrite").option("compression", "zstd").parquet(a.output)


def publish_current_view(spark, a):
    bad = jsonl.strict_violations(spark, a.observations).take(3)
    if bad:
        raise jsonl.InvalidInput("; ".join(f"{r.path}: {r.rule}" for r in bad))
    rows, view = _view(spark, a)
    versions = {"relevance": P.RELEVANCE_VERSION, "selection": P.SELECTION_VERSION, "candidate": P.CANDIDATE_VERSION}
    paths = [p for p in (a.observations, a.evidence) if p]
    print(json.dumps(ledger.publish_snapshot(spark, a.output, view, rows, jsonl.fingerprints(spark, paths), versions)))


def _walk(walk: str, fixed: dict | None = None):
    def command(spark, a):
        options = {"walk": walk, "client": a.client, "max_requests": str(a.max_requests), **dict(o.split("=", 1) for o in a.option), **(fixed or {})}
        if a.queries:
            options["specs"] = json.dumps([{"id": e["id"], "q": e["q"]} for e in catalogs.read_queries(a.queries)])
        if a.topics:
            options["topics"] = json.dumps(catalogs.read_topics(a.topics))
        saved = ledger.under_policy(ledger.load_state(spark, a.state), a.policy)
        rows, state = paged.walk(options, saved, a.max_requests)
        out = [(i, kind, key, ledger.canonical(payload)) for i, (kind, key, payload) in enumerate(rows)]
        path = f"{a.output}/{ledger.content_path(walk, saved, [r[3] for r in out])}"
        spark.createDataFrame(out, paged.SCHEMA).write.mode("overwrite").partitionBy("kind").parquet(path)  # before the state: a replay writes the same place
        ledger.save_state(spark, a.state, state | {"policy": a.policy})

    return command


def readme_enrich(spark, a):
    """The next rows of the reading queue, asked for conditionally once each, reduced to signals; texts are not kept.

    Every run writes its rows (record and state) below the output before its cursors; a replay writes the same place.
    """
    _, view = _view(spark, a)
    saved = ledger.load_state(spark, a.state) or {"cursors": {}, "run": 0}
    cursors, now = {int(k): v for k, v in saved["cursors"].items()}, F.current_timestamp()
    if saved["run"]:
        done = spark.read.parquet(*[f"{a.output}/run={i}" for i in range(saved["run"])])
        prior = registry.latest(done.where("state IS NOT NULL"), "github_id", ["stamp"]).select("github_id", "state.*")
    else:
        prior = spark.createDataFrame([], f"github_id long, {readings.STATE}")
    tiers = rules.queue_tier(readings.earlier_signals(view, prior), "earlier_signals").select("github_id", "name", "queue_tier")
    todo = queues.tier_round_robin(readings.to_read(tiers, prior, now), "queue_tier", "github_id", cursors, a.max_requests)
    todo = spark.createDataFrame(todo.collect(), todo.schema)  # at most max_requests rows
    answered = readings.records(todo, readings.ask(todo, a.client), prior, now)
    rows = answered.join(todo.select("github_id", "position"), "github_id").withColumn("stamp", F.unix_micros(now))
    path = f"{a.output}/run={saved['run']}"
    rows.write.mode("overwrite").parquet(path)  # the only time that the query runs, so each row is asked for once
    tops = {str(r.queue_tier): r.cursor for r in readings.tier_cursors(spark.read.parquet(path)).collect()}
    ledger.save_state(spark, a.state, {"cursors": saved["cursors"] | tops, "run": saved["run"] + 1})


def _asked(spark, rows, name, size=50):
    """rows (github_id, key), looked up in batches; (github_id, node), null where the lookup failed."""
    found = paged.lookup(rows, "key", name, size).withColumnRenamed("key", "k")
    node = "nameWithOwner string, url string, description string, topics array<string>, primaryLanguage string, stargazerCount long, isArchived boolean, isFork boolean"
    return rows.join(found, F.col("key").cast("string") == F.col("k"), "left").select("github_id", F.from_json("payload", node).alias("node"))


def census(spark, a):
    """Pages of the enumeration with their nodes and decisions: candidates, coverage, and rows to try again.

    Per run: what is to be tried again first, up to 100 a page asked for; then new pages. The state comes last.
    """
    saved = ledger.load_state(spark, a.state) or {"run": 0, "walk": None, "cursors": {}}
    root, run = a.output, saved["run"]
    core = "since long, github_id long, node_id string, full_name string, name string, description string"
    kind = f"{core}, attempts int, pool string"
    pool = spark.read.schema(kind).parquet(f"{root}/retry/run={run - 1}") if run else spark.createDataFrame([], kind)
    again = queues.two_pool_quota(pool, "pool", "github_id", ["retry", "failed"], 100 * a.max_requests, saved["cursors"])
    again = spark.createDataFrame(again.collect(), again.schema)  # at most 100 rows a request
    late = census_ops.decide(census_ops.enrich(again.select(*again.columns[:6]), _asked(spark, again.select("github_id", F.col("node_id").alias("key")), a.nodes)))
    rows, state = paged.walk({"walk": "enumerate", "client": a.client}, saved["walk"], a.max_requests)
    sinces, since = [], (saved["walk"] or {"since": 0})["since"]
    for k, key, p in rows:
        if k == "item":
            sinces.append((since, p["id"], p.get("node_id"), p.get("full_name"), p.get("name"), p.get("description")))
        elif k == "coverage":
            since = p["next_since"]
    fresh = spark.createDataFrame(sinces, core)
    new = census_ops.decide(census_ops.enrich(fresh, _asked(spark, fresh.select("github_id", F.col("node_id").alias("key")), a.nodes)))
    both = new.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    both.write.mode("overwrite").parquet(f"{root}/rows/run={run}")  # one lookup a row; all else reads this
    both = spark.read.parquet(f"{root}/rows/run={run}")
    census_ops.keep_candidates(both).write.mode("overwrite").parquet(f"{root}/pages/run={run}")
    pages = both.where("not late")
    census_ops.page_coverage(pages).write.mode("overwrite").parquet(f"{root}/coverage/run={run}")
    tried = both.select(F.col("github_id").alias("id"), (F.col("enrichment_status") == "enriched").alias("ok"))
    left = ledger.retry_pools(pool.select(F.col("github_id").alias("id"), "attempts"), tried)
    known = pool.select(*again.columns[:6]).unionByName(pages.join(fresh.select("github_id"), "github_id", "left_semi").select(*[F.col(c) for c in again.columns[:6]])).dropDuplicates(["github_id"])
    known.join(left.withColumnRenamed("id", "github_id"), "github_id").select(*[c.split(" ")[0] for c in kind.split(", ")]).write.mode("overwrite").parquet(f"{root}/retry/run={run}")
    tops = {r.pool: r.top for r in again.groupBy("pool").agg(F.max("github_id").alias("top")).collect()}
    ledger.save_state(spark, a.state, {"run": run + 1, "walk": state, "cursors": saved["cursors"] | tops})


def papers_daily(spark, a):
    """New pages of papers; then looks at papers without a usable address, then lookups of linked repositories; a sidecar of all links.

    Each run writes its tables below the output under its number, and its state last, so a replay writes the same places.
    At most max_requests pages, and max_details looks and lookups, each.
    """
    saved = ledger.load_state(spark, a.state) or {"run": 0, "walk": None, "details": None, "lookups": None}
    root, run, today = a.output, saved["run"], F.lit(a.today) if a.today else F.current_date()
    kinds = {"queue": "paper_id string, paper_date string, attempts int", "checked": "paper_id string, checked_on string", "links": papers.LINK}
    old = {k: spark.read.schema(v).parquet(f"{root}/{k}/run={run - 1}") if run else spark.createDataFrame([], v) for k, v in kinds.items()}
    options = {"walk": "papers", "client": a.client, **dict(o.split("=", 1) for o in a.option)}
    rows, state = paged.walk(options, saved["walk"], a.max_requests)
    met = [(str(p["paper"]["id"]), p["paper_date"], p["paper"].get("github_repo")) for kind, _, p in rows if kind == "item"]
    found = spark.createDataFrame(met, "paper_id string, paper_date string, github_repo string")
    queue = old["queue"].unionByName(papers.need_details(found, old["queue"], old["checked"], today))
    todo = spark.createDataFrame(papers.next_details(queue, saved["details"], a.max_details).collect(), queue.schema)
    looks = paged.lookup(todo, "paper_id", a.details, 1).select(F.col("key").alias("paper_id"), (F.col("status") != "error").alias("ok"), F.get_json_object("payload", "$.github_repo").alias("github_repo"))
    looks.write.mode("overwrite").parquet(f"{root}/looks/run={run}")  # one look a paper
    left, made, done = papers.after_details(queue, spark.read.parquet(f"{root}/looks/run={run}"))
    left.write.mode("overwrite").parquet(f"{root}/queue/run={run}")
    now = done.withColumn("checked_on", today.cast("string"))
    registry.upsert(old["checked"], now, ["paper_id"]).write.mode("overwrite").parquet(f"{root}/checked/run={run}")
    every = papers.sidecar(old["links"], papers.links(found).unionByName(made).join(old["links"].where("link_status = 'resolved'"), papers.KEYS, "left_anti"), spark.createDataFrame([], "paper_id string, normalized_repo string, github_id long"))
    every.write.mode("overwrite").parquet(f"{root}/unresolved/run={run}")
    every = spark.read.schema(papers.LINK).parquet(f"{root}/unresolved/run={run}")
    place = F.struct("paper_date", "paper_id", "normalized_repo")
    late = place <= F.struct(*[F.lit(x).alias(c) for x, c in zip(saved["lookups"], ("paper_date", "paper_id", "normalized_repo"), strict=True)]) if saved["lookups"] else F.lit(False)
    asked = every.where("link_status = 'unresolved'").orderBy(late, "paper_date", "paper_id", "normalized_repo").limit(a.max_details)
    asked = spark.createDataFrame(asked.collect(), every.schema)
    ids = paged.lookup(asked.select("normalized_repo").distinct(), "normalized_repo", a.nodes, 50).select(F.col("key").alias("normalized_repo"), F.get_json_object("payload", "$.id").cast("long").alias("github_id")).where("github_id IS NOT NULL")
    resolved = asked.drop("github_id").join(ids, "normalized_repo").select("paper_id", "normalized_repo", "github_id")
    resolved.write.mode("overwrite").parquet(f"{root}/resolved/run={run}")  # one lookup a repository
    resolved = spark.read.parquet(f"{root}/resolved/run={run}")
    papers.sidecar(every, every.limit(0), resolved).select(*[c.split(" ")[0] for c in papers.LINK.split(", ")]).write.mode("overwrite").parquet(f"{root}/links/run={run}")
    papers.observed_papers(resolved).write.mode("overwrite").parquet(f"{root}/papers/run={run}")
    last = lambda df, *keys: (lambda r: list(r) if r else None)(df.orderBy(*[F.col(k).desc() for k in keys]).select(*keys).first())
    turn = {"details": last(todo, "paper_date", "paper_id") or saved["details"], "lookups": last(asked, "paper_date", "paper_id", "normalized_repo") or saved["lookups"]}
    ledger.save_state(spark, a.state, {"run": run + 1, "walk": state, **turn}, 1 << 20)


def archive_import(spark, a):
    """Links of an archive matched to repositories by a name that only one of them has."""
    links = spark.read.parquet(a.archive).withColumn("normalized_repo_name", rules.X.loose_repository(F.col("repo_url"))).where("normalized_repo_name IS NOT NULL")
    rows = jsonl.require(*jsonl.observations(spark, a.observations), a.quarantine)
    registry.link_by_name(links, registry.latest(rows, "github_id", ["stamp", "canonical"])).write.mode("overwrite").parquet(a.output)


def audit_sample(spark, a):
    sizes = dict((k, int(v)) for k, v in (s.split("=") for s in a.size))
    key = audit.sample(spark.read.parquet(a.frame), a.seed, sizes, a.challenge)
    key.write.mode("error").parquet(f"{a.output}/key")
    audit.roster(spark.read.parquet(f"{a.output}/key")).write.mode("error").parquet(f"{a.output}/roster")


def audit_score(spark, a):
    annotations, key = spark.read.json(a.annotations), spark.read.parquet(a.key)
    bad = audit.annotation_problems(annotations).union(audit.case_problems(annotations, key)).take(3)
    if bad:
        raise jsonl.InvalidInput("; ".join(f"{r.case_id}: {r.problem}" for r in bad))
    print(json.dumps(audit.score(annotations, key).first().asDict()))


COMMANDS = {
    "current-view": current_view, "publish-current-view": publish_current_view, "readme-enrich": readme_enrich, "archive-import": archive_import, "audit-sample": audit_sample, "audit-score": audit_score,
    "run": _walk("search", {"fair": "true"}), "sample": _walk("search", {"once": "true"}), "backfill": _walk("search"), "backfill-fair": _walk("search", {"fair": "true", "field": "created"}),
    "historical-sample": _walk("history"), "census": census, "census-daily": census, "topic-breadth-daily": _walk("topics"), "papers-daily": papers_daily,
}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarry")
    p.add_argument("command", choices=sorted(COMMANDS))
    for name in ("observations", "evidence", "quarantine", "output", "client", "nodes", "details", "today", "state", "queries", "topics", "archive", "frame", "annotations", "key"):
        p.add_argument(f"--{name}")
    p.add_argument("--evidence-versions", nargs="*", default=P.README_VERSIONS)
    p.add_argument("--option", action="append", default=[], help="name=value, handed to the walk")
    p.add_argument("--policy", type=int, default=1, help="version of the queries' rules; another one starts walks anew")
    p.add_argument("--max-details", type=int, default=200)
    p.add_argument("--max-requests", type=int, default=100)
    p.add_argument("--size", action="append", default=[], help="status=rows")
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--challenge", type=int, nargs="*", default=[])
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        COMMANDS[a.command](spark, a)
    except (ValueError, OSError, ledger.Conflict, paged.RetryLater) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
