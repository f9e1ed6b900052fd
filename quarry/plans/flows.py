"""Queries of the sources, flows and remaining operators over the test tables, each with SQL that gives the same rows."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.functions import patterns as P, text as X
from quarry.operators import archives, audit, census, papers, queues, readings, registry, rules
from quarry.plans.catalog import join, picked, picked_sql, query, table
from quarry.sources import jsonl, paged
from quarry.streaming import bundles, ledger

DAY = "2024-01-10"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all machines share; on one machine, where none is set, a temporary one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quarry-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


# JSON Lines.


@query("""SELECT event_id, user_id + 1 AS github_id, epoch_us(ts::TIMESTAMP) AS stamp, (CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END)::INT AS rank,
 '{"a":{"n":' || event_id || '},"z":[1,"x"]}' AS extra_json FROM events""")
def observation_files(spark, sf_dir):
    """Events written as observation lines and read again through the strict source."""
    e = table(spark, sf_dir, "events")
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    line = F.concat(
        F.lit('{"z":[1,"x"],"github_id":'), (F.col("user_id") + 1).cast("string"), F.lit(',"queryless":'), (F.col("event_id") % 4 == 0).cast("string"), F.lit(',"name":"o/r","observed_at":"'), at,
        F.lit('","a":{"n":'), F.col("event_id").cast("string"), F.lit("}}"),
    )
    path = scratch(spark, "lines")
    e.select(line.alias("value")).write.option("lineSep", "\n").text(path)
    rows = jsonl.require(*jsonl.observations(spark, path))
    return rows.select(F.get_json_object("extra_json", "$.a.n").cast("long").alias("event_id"), "github_id", "stamp", "rank", "extra_json")


@query("SELECT event_id % 5 AS broken, count(*) AS n FROM events WHERE event_id % 5 > 0 GROUP BY 1")
def observation_violations(spark, sf_dir):
    """Lines that break a rule, by rule."""
    kinds = ['{"github_id":1,"observed_at":"2024-01-01T00:00:00Z"}', "not json", '{"github_id":true,"observed_at":"2024-01-01T00:00:00Z"}', '{"github_id":1,"observed_at":"never"}', '{"github_id":1,"observed_at":"2024-01-01T00:00:00Z","paper_ids":null}']
    rules_ = ["", "not-an-object", "github_id", "observed_at", "paper_ids"]
    path = scratch(spark, "bad-lines")
    table(spark, sf_dir, "events").select(picked(kinds, F.col("event_id")).alias("value")).write.option("lineSep", "\n").text(path)
    _, bad = jsonl.observations(spark, path)
    number = F.coalesce(*[F.when(F.col("rule") == r, F.lit(i).cast("long")) for i, r in enumerate(rules_)])
    return bad.groupBy(number.alias("broken")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT user_id + 1 AS github_id FROM events WHERE event_id % 3 = 0")
def recovered_ids(spark, sf_dir):
    """Ids in earlier outputs, past lines that do not parse."""
    one = (F.col("user_id") + 1).cast("string")
    value = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"github_id":'), one, F.lit("}"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"github_id":"'), one, F.lit('"}'))).otherwise("{")
    path = scratch(spark, "outputs")
    table(spark, sf_dir, "events").select(value.alias("value")).write.option("lineSep", "\n").text(path)
    return jsonl.recover_ids(spark, path)


@query("SELECT c_custkey AS line, (CASE c_custkey % 3 WHEN 0 THEN 'same' WHEN 1 THEN 'other' ELSE 'none' END) AS form FROM customer")
def canonical_lines(spark, sf_dir):
    """Whether a line is in its canonical form."""
    key = F.col("c_custkey").cast("string")
    text = F.concat(F.when(F.col("c_custkey") % 3 == 0, F.lit('{"a":')).when(F.col("c_custkey") % 3 == 1, F.lit('{ "a": ')).otherwise(F.lit("[")), key, F.lit("}"))
    done = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("line"), text.alias("t")).withColumn("c", jsonl.canonical_json("t"))
    return done.select("line", F.when(F.col("c").isNull(), "none").when(F.col("c") == F.col("t"), "same").otherwise("other").alias("form"))


@query("""SELECT 'f' || c_custkey AS path, CASE WHEN c_custkey % 4 = 0 THEN 'not-listed' WHEN c_custkey % 4 = 1 THEN 'missing' ELSE 'row-count' END AS problem FROM customer WHERE c_custkey % 4 < 3""")
def file_audit(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("f"), F.col("c_custkey").cast("string")).alias("path"))
    found = c.where("c_custkey % 4 <> 1").select("path", F.lit(3).alias("rows"))
    return jsonl.audit_files(found, c.where("c_custkey % 4 <> 0").select("path", F.when(F.col("c_custkey") % 4 == 2, 2).otherwise(3).alias("rows")))


_PATHS = ["data/observations/a/b.jsonl", "data/observations/.jsonl", "data/readme-evidence/2024/01/02/x.jsonl", "data/readme-evidence/24/01/02/x.jsonl", "data/observations/a.json", "x/data/observations/a.jsonl"]


@query(f"""WITH p AS (SELECT event_id, {picked_sql(_PATHS, "event_id")} AS path FROM events) SELECT event_id, path FROM p
WHERE regexp_full_match(path, 'data/observations/.+[.]jsonl') OR regexp_full_match(path, 'data/readme-evidence/[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}/[^/]+[.]jsonl')""")
def input_paths(spark, sf_dir):
    files = table(spark, sf_dir, "events").select("event_id", picked(_PATHS, F.col("event_id")).alias("path"))
    return bundles.inputs(files, f"(?:{bundles.OBSERVATIONS})|(?:{bundles.EVIDENCE})")


# Projections.


@query("""SELECT c_custkey AS github_id, trim(c_name) AS name, c_custkey % 11 AS stars, 0::BIGINT AS forks, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'other' END AS license, 'a|b' AS topics, false AS archived, 'candidate' AS candidate_status FROM customer""")
def projected_items(spark, sf_dir):
    """Search items as observations: renamed, stripped, defaults filled, the license by the first name that it has."""
    none = F.lit(None).cast("string")
    license_ = F.struct(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("  ").alias("spdx_id"), none.alias("key"), F.lit("other").alias("name"))
    api = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit(" "), "c_name", F.lit("\n")).alias("full_name"), none.alias("html_url"), *[none.alias(c) for c in ("description", "homepage", "language", "created_at", "pushed_at", "updated_at")],
        F.array(F.lit("b"), F.lit(" a"), F.lit("b"), F.lit("")).alias("topics"), license_.alias("license"), (F.col("c_custkey") % 11).alias("stargazers_count"), F.lit(None).cast("long").alias("forks_count"), F.lit(None).cast("boolean").alias("archived"), F.lit(None).cast("boolean").alias("fork"),
    )
    return registry.project_repository(api).select("github_id", "name", "stars", "forks", "license", join("topics").alias("topics"), "archived", "candidate_status")


_ROWS = {"links": '{"paper_url":"u","arxiv_id":"old","is_official":true,"repo_url":"https://github.com/A/b"}', "typed": '{"paper_url":5,"paper_arxiv_id":"new","arxiv_id":"old","is_official":"yes","repo_url":"https://github.com/c/d.git"}', "null": '{"paper_arxiv_id":null,"arxiv_id":"old","repo_url":"http://www.github.com/e/f/tree/x"}', "none": '{"repo_url":"ftp://nowhere"}'}
_PROVENANCE = {c: c.removeprefix("source_") for c in archives.SOURCE}


def _archive(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("source_row_offset"), F.parse_json(picked(list(_ROWS.values()), F.col("event_id"))).alias("v"))
    return archives.link_records(rows, _PROVENANCE, "credit")


@query(f"""SELECT event_id AS source_row_offset, {picked_sql(["a/b", "c/d", "e/f", ""], "event_id")} AS normalized_repo_name, CASE event_id % 4 WHEN 0 THEN 'u' END AS paper_url, CASE event_id % 4 WHEN 1 THEN 'new' ELSE 'old' END AS paper_arxiv_id,
 CASE event_id % 4 WHEN 0 THEN true END AS is_official, 'dataset' AS source_dataset FROM events WHERE event_id % 4 < 3""")
def archive_links(spark, sf_dir):
    """Archive rows as typed assertions with their provenance; only repositories' addresses stay."""
    return _archive(spark, sf_dir).select("source_row_offset", X.casefold(F.col("normalized_repo_name")).alias("normalized_repo_name"), "paper_url", "paper_arxiv_id", "is_official", "source_dataset")


@query("SELECT event_id AS source_row_offset FROM events WHERE event_id % 4 < 3 AND (event_id % 5 = 0 OR event_id % 7 = 0)")
def archive_foreign(spark, sf_dir):
    """Links of another source, or that credit nobody."""
    n = F.col("source_row_offset")
    rows = _archive(spark, sf_dir).withColumns({"source_license": F.when(n % 5 == 0, "other").otherwise(F.col("source_license")), "source_attribution": F.when(n % 7 == 0, " ").otherwise("credit")})
    return archives.foreign(rows, _PROVENANCE).select("source_row_offset")


@query(f"""WITH l AS (SELECT event_id AS source_row_offset, {picked_sql(["a/b", "c/d", "e/f", ""], "event_id")} AS name FROM events WHERE event_id % 4 < 3)
SELECT source_row_offset, CASE name WHEN 'a/b' THEN 1 WHEN 'e/f' THEN 3 END::BIGINT AS github_id FROM l""")
def archive_pair(spark, sf_dir):
    """The snapshot's links: one an offset, joined to the repository whose present name is the only such."""
    own = [F.lit(v).alias(k) for k, v in _PROVENANCE.items()]
    seen = spark.createDataFrame([(1, "old/name", 1, "a"), (1, "A/b", 2, "b"), (2, "c/d", 1, "c"), (5, "C/D", 1, "d"), (3, "e/f", 1, "e")], "github_id long, name string, stamp long, canonical string")
    links = _archive(spark, sf_dir)
    _, joined = archives.pair(links.unionByName(links.where("source_row_offset % 10 = 0")), seen.select("*", *own, F.lit("credit").alias("source_attribution")), _PROVENANCE)
    return joined.select("source_row_offset", "github_id")


# Readings.


def _prior(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_custkey % 5 > 0")
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    version = F.when(k % 3 == 0, "an older one").otherwise(P.README_VERSION)
    return c.select(
        k.alias("github_id"), F.when(k % 7 == 0, "renamed").otherwise(F.col("c_name")).alias("repository_name_at_fetch"), F.lit("mark").alias("readme_etag"), F.lit("blob").alias("readme_blob_sha"), version.alias("readme_evidence_version"),
        F.array(F.lit("survey-cue"), F.lit("course-cue")).alias("readme_signals"), F.array(F.lit("method")).alias("readme_sections"), none.alias("readme_checked_at"),
        F.when(k % 2 == 0, "2024-01-09T00:00:00Z").otherwise("2024-02-01T00:00:00Z").alias("due_at"), F.when(k % 11 == 0, 404).alias("last_status"), F.when(k % 6 == 0, P.README_VERSION).alias("tried_version"),
    )


@query(f"""SELECT c_custkey AS github_id, CASE WHEN c_custkey % 5 > 0 AND c_custkey % 7 > 0 AND c_custkey % 3 > 0 THEN 'mark' END AS sent_etag FROM customer
WHERE NOT (c_custkey % 5 > 0 AND c_custkey % 7 > 0 AND (c_custkey % 3 > 0 OR c_custkey % 6 = 0) AND c_custkey % 2 = 1)""")
def readmes_to_read(spark, sf_dir):
    """What is due, and the mark to send with the request."""
    queue = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("github_id"), F.col("c_name").alias("name"))
    return readings.to_read(queue, _prior(spark, sf_dir), F.lit(DAY).cast("timestamp")).select("github_id", "sent_etag")


@query("""SELECT c_custkey AS github_id, CASE WHEN c_custkey % 5 > 0 AND c_custkey % 7 > 0 AND c_custkey % 3 > 0 AND c_custkey % 11 > 0 THEN 'survey-cue,course-cue' END AS signals FROM customer""")
def earlier_signals(spark, sf_dir):
    view = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("github_id"), F.col("c_name").alias("name"))
    return readings.earlier_signals(view, _prior(spark, sf_dir)).select("github_id", F.when(F.col("earlier_signals").isNotNull(), F.array_join("earlier_signals", ",")).alias("signals"))


_TEXT = b"We propose a transformer in a paper, with code."
_BODY = '{"type":"file","size":47,"encoding":"base64","sha":"abc","content":"V2UgcHJvcG9zZSBhIHRyYW5zZm9ybWVyIGluIGEg\\ncGFwZXIsIHdpdGggY29kZS4="}'
_OUTCOMES = ["ok", "unchanged", "missing", "error", "error", "limited"]


def _answers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    n = F.col("c_custkey") % 6
    todo = c.select(F.col("c_custkey").alias("github_id"), F.col("c_name").alias("name"), (F.col("c_custkey") % 6).cast("int").alias("queue_tier"), F.lit("sent").alias("sent_etag"), F.col("c_custkey").alias("position"))
    status = F.when(n == 1, 304).when(n == 2, 404).when(n == 3, 500).when(n == 5, 429).otherwise(200)
    body = F.when(n == 0, _BODY).when(n == 4, _BODY.replace("47", "48"))
    return todo, c.select(F.col("c_custkey").alias("github_id"), status.cast("int").alias("http_status"), F.when(n == 0, "new").alias("etag"), body.alias("body"))


@query(f"SELECT c_custkey AS github_id, {picked_sql(_OUTCOMES, 'c_custkey')} AS outcome, CASE c_custkey % 6 WHEN 0 THEN '{_TEXT.decode()}' END AS text FROM customer")
def readme_answers(spark, sf_dir):
    """Answers checked by status, type, size, encoding and contents."""
    return readings.checked(_answers(spark, sf_dir)[1]).select("github_id", "outcome", "text")


_OWN = "method-contribution,ml-method-context,paper-code-relationship,paper-reference"


@query(f"""WITH x AS (SELECT c_custkey AS k, c_custkey % 6 AS n, c_custkey % 5 > 0 AS had, {picked_sql(_OUTCOMES, "c_custkey")} AS outcome FROM customer WHERE c_custkey % 6 < 5)
SELECT k AS github_id, outcome, CASE WHEN n < 3 THEN '2024-01-10T00:00:00.000000Z' END AS observed_at, CASE n WHEN 0 THEN 'new' WHEN 1 THEN 'sent' END AS etag,
 CASE n WHEN 0 THEN 'abc' WHEN 1 THEN CASE WHEN had THEN 'blob' END END AS blob, CASE n WHEN 1 THEN CASE WHEN had THEN 'course-cue,survey-cue' ELSE '' END WHEN 2 THEN '' END AS signals,
 substr((DATE '{DAY}' + (CASE WHEN n < 2 THEN 365 WHEN n = 2 THEN 30 ELSE 1 END)::INT)::VARCHAR, 1, 10) AS due FROM x""")
def readme_records(spark, sf_dir):
    """Compact records of the answers, and when each row is due again. Signals of fresh texts have a query of their own."""
    todo, answers = _answers(spark, sf_dir)
    done = readings.records(todo, answers, _prior(spark, sf_dir), F.lit(DAY).cast("timestamp"))
    fresh = F.col("outcome") == "ok"
    return done.select("github_id", "outcome", "record.observed_at", F.col("record.readme_etag").alias("etag"), F.col("record.readme_blob_sha").alias("blob"), F.when(~fresh, F.array_join("record.readme_signals", ",")).alias("signals"), F.substring("state.due_at", 1, 10).alias("due"))


@query("SELECT (c_custkey % 6)::INT AS queue_tier, max(c_custkey) AS cursor FROM customer WHERE c_custkey % 6 < 5 GROUP BY 1")
def readme_cursors(spark, sf_dir):
    todo, answers = _answers(spark, sf_dir)
    done = readings.records(todo, answers, _prior(spark, sf_dir), F.lit(DAY).cast("timestamp"))
    return readings.tier_cursors(done.join(todo.select("github_id", "position"), "github_id"))


@query("""WITH x AS (SELECT event_id AS e FROM events) SELECT e AS event_id, CASE WHEN e % 13 = 0 THEN NULL WHEN e % 11 = 0 THEN NULL WHEN e % 2 = 0 THEN 0 WHEN e % 3 = 0 THEN 1 WHEN e % 5 = 0 THEN 2 WHEN e % 7 = 0 THEN 5 END::INT AS queue_tier FROM x""")
def queue_tiers(spark, sf_dir):
    """Tiers of the reading queue: forks and decisive negatives out, then papers with code, included rows, targets, mere context."""
    n = F.col("event_id")
    none = F.array().cast("array<string>")
    signals = F.when(n % 11 == 0, F.array(F.lit("tutorial-cue"))).otherwise(none)
    signals = F.concat(signals, F.when(n % 2 == 0, F.array(F.lit("paper-and-code-cue"))).otherwise(none), F.when(n % 5 == 0, F.array(F.lit("ml-method-cue"))).otherwise(none))
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("own/r"), n.cast("string")).alias("name"), F.lit(None).cast("string").alias("description"), (n % 13 == 0).alias("fork"), signals.alias("selection_signals"),
        F.when(n % 11 == 0, "tutorial-repository").otherwise("none").alias("selection_reason"), F.when(n % 3 == 0, "include").otherwise("review").alias("selection_status"), F.when(n % 7 == 0, F.array(F.lit("gan"))).otherwise(none).alias("methods"),
    )
    return rules.queue_tier(rows).select("event_id", "queue_tier")


# Census, topics, papers.

_DESCRIPTIONS = ["deep learning for images", "a cooking blog about soups", "x"]
_DECIDED = "CASE WHEN c_custkey % 4 = 0 THEN 'unknown' WHEN c_custkey % 3 = 0 THEN 'candidate' WHEN c_custkey % 3 = 1 THEN 'not_candidate' ELSE 'unknown' END"


def _census(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    core = c.select(F.floor(k / 100).cast("long").alias("since"), k.alias("github_id"), none.alias("full_name"), none.alias("name"), F.lit("an earlier text").alias("description"))
    node = F.struct(
        F.when(k % 4 != 0, "o/r").alias("nameWithOwner"), F.lit("u").alias("url"), picked(_DESCRIPTIONS, k).alias("description"), F.array().cast("array<string>").alias("topics"), none.alias("primaryLanguage"),
        F.lit(1).cast("long").alias("stargazerCount"), F.lit(False).alias("isArchived"), F.lit(False).alias("isFork"),
    )
    return census.decide(census.enrich(core, c.select(k.alias("github_id"), node.alias("node"))))


@query(f"SELECT c_custkey AS github_id, CASE WHEN c_custkey % 4 = 0 THEN 'unresolved' ELSE 'enriched' END AS enrichment_status, {_DECIDED} AS candidate_status FROM customer")
def census_decisions(spark, sf_dir):
    """Enumerated rows with their nodes by id; what has no complete node is unknown."""
    return _census(spark, sf_dir).select("github_id", "enrichment_status", "candidate_status")


@query(f"SELECT c_custkey AS github_id, {picked_sql(_DESCRIPTIONS, 'c_custkey')} AS description FROM customer WHERE {_DECIDED} = 'candidate'")
def census_candidates(spark, sf_dir):
    return census.keep_candidates(_census(spark, sf_dir)).select("github_id", "description")


@query(f"""SELECT c_custkey // 100 AS since, count(*) AS enumerated, count(*) FILTER (c_custkey % 4 > 0) AS enriched, count(*) FILTER ({_DECIDED} = 'candidate') AS candidate_count, count(*) FILTER ({_DECIDED} = 'unknown') AS unknown_count,
 count(*) FILTER ({_DECIDED} = 'not_candidate') AS not_candidate_count, coalesce(string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) FILTER (c_custkey % 4 = 0), '') AS retry_ids FROM customer GROUP BY 1""")
def census_coverage(spark, sf_dir):
    return census.page_coverage(_census(spark, sf_dir)).drop("resolved_ids").withColumn("retry_ids", F.array_join("retry_ids", ","))


@query(f"""SELECT c_custkey // 100 AS since, count(*) FILTER (c_custkey % 4 > 0 OR c_custkey % 8 = 0) AS enriched, count(*) FILTER ({_DECIDED} = 'candidate' OR c_custkey % 8 = 0) AS candidate_count,
 count(*) FILTER ({_DECIDED} = 'unknown' AND c_custkey % 8 > 0) AS unknown_count, coalesce(string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) FILTER (c_custkey % 8 = 4 AND c_custkey % 12 > 0), '') AS retry_ids FROM customer GROUP BY 1""")
def census_late_rows(spark, sf_dir):
    """Coverage after later lookups: resolved rows move from unknown, once; parked ones are not tried again."""
    rows = _census(spark, sf_dir)
    late = rows.where("github_id % 8 = 0").select("since", "github_id", F.lit("candidate").alias("candidate_status"))
    parked = rows.where("github_id % 8 = 4 and github_id % 12 = 0").select("since", "github_id")
    out = census.late_coverage(census.page_coverage(rows), late.unionAll(late), parked)
    return out.select("since", "enriched", "candidate_count", "unknown_count", F.array_join("retry_ids", ",").alias("retry_ids"))


@query("""SELECT DISTINCT s_suppkey % 50 AS github_id, (s_suppkey % 3)::INT AS page, CASE WHEN s_suppkey % 3 = 0 THEN 'own|topic' ELSE 'own' END AS topics, 'topic' AS topic_names FROM supplier WHERE (s_suppkey % 50) % 7 > 0""")
def topic_pages(spark, sf_dir):
    """Rows of topic pages: one an id and page, forks out, the head's topic among the row's."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    rows = s.select((k % 50).alias("github_id"), (k % 3).cast("int").alias("page"), F.lit("o/r").alias("full_name"), F.array(F.lit("own")).alias("topics"), ((k % 50) % 7 == 0).alias("fork"), F.lit("topic").alias("topic"), (k % 3 == 0).alias("head"))
    return census.topic_rows(rows).select("github_id", "page", join("topics").alias("topics"), join("topic_names").alias("topic_names"))


_REPOS = ["https://github.com/a/b", None, "nowhere"]


def _papers(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    repo = F.when(k % 3 == 0, F.lit(_REPOS[0])).when(k % 3 == 2, F.lit(_REPOS[2]))
    return table(spark, sf_dir, "orders").select((k % 1000).cast("string").alias("paper_id"), F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd").alias("paper_date"), repo.alias("github_repo"))


_DETAILS = """d AS (SELECT (o_orderkey % 1000)::VARCHAR AS paper_id, min(strftime(o_orderdate::TIMESTAMP, '%Y-%m-%d')) AS paper_date FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1)"""


@query(f"""WITH {_DETAILS} SELECT paper_id, paper_date, 0 AS attempts FROM d WHERE NOT paper_id::INT % 5 = 0 AND NOT paper_id::INT % 7 = 0""")
def papers_to_look_at(spark, sf_dir):
    """Papers without a usable address that are neither queued nor were looked at today."""
    ids = spark.range(1000)
    text = F.col("id").cast("string").alias("paper_id")
    checked = ids.where("id % 7 = 0 or id % 11 = 0").select(text, F.when(F.col("id") % 7 == 0, DAY).otherwise("2024-01-09").alias("checked_on"))
    queue = ids.where("id % 5 = 0").select(text, F.lit(DAY).alias("paper_date"), F.lit(1).alias("attempts"))
    return papers.need_details(_papers(spark, sf_dir), queue, checked, F.lit(DAY))


@query(f"""WITH {_DETAILS} SELECT paper_id, paper_date FROM d ORDER BY (paper_date, paper_id) <= ('1995-06-01', '500'), paper_date, paper_id LIMIT 40""")
def paper_detail_slice(spark, sf_dir):
    queue = papers.need_details(_papers(spark, sf_dir), spark.createDataFrame([], "paper_id string"), spark.createDataFrame([], "paper_id string, checked_on string"), F.lit(DAY))
    return papers.next_details(queue, ("1995-06-01", "500"), 40).select("paper_id", "paper_date")


@query("""WITH c AS (SELECT c_custkey AS k FROM customer) SELECT k::VARCHAR AS paper_id, CASE WHEN k % 3 = 0 THEN k WHEN k % 2 = 1 THEN -1 END AS github_id, CASE WHEN k % 3 = 0 OR k % 2 = 1 THEN 'resolved' ELSE 'unresolved' END AS link_status FROM c""")
def paper_sidecar(spark, sf_dir):
    """Links replaced by newer ones, with what lookups found over either."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("paper_id"), F.lit("a/b").alias("normalized_repo"), F.col("c_custkey").alias("k"))
    old = c.where("k % 4 > 0").select("paper_id", "normalized_repo", F.lit(-1).cast("long").alias("github_id"), F.lit("resolved").alias("link_status"))
    new = c.where("k % 2 = 0").select("paper_id", "normalized_repo", F.lit(None).cast("long").alias("github_id"), F.lit("unresolved").alias("link_status"))
    return papers.sidecar(old, new, c.where("k % 3 = 0").select("paper_id", "normalized_repo", F.col("k").alias("github_id"))).select("paper_id", "github_id", "link_status")


@query("""SELECT s_suppkey AS id, (CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey % 6 END + CASE WHEN s_suppkey % 3 = 1 THEN 1 ELSE 0 END)::INT AS attempts,
 CASE WHEN (CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey % 6 END + CASE WHEN s_suppkey % 3 = 1 THEN 1 ELSE 0 END) >= 5 THEN 'failed' ELSE 'retry' END AS pool FROM supplier WHERE s_suppkey % 3 > 0""")
def retry_pools(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 6).cast("int").alias("attempts"))
    tried = s.where("id % 3 < 2").select("id", (F.col("id") % 3 == 0).alias("ok"))
    return ledger.retry_pools(s.where("id % 3 > 0 or id % 2 = 0"), tried)


@query("""SELECT n_name, CASE WHEN n_nationkey % 3 > 0 THEN 'head' ELSE 'deep' END AS mode FROM nation WHERE n_nationkey % 3 > 0 OR n_nationkey % 4 < 3""")
def next_topics(spark, sf_dir):
    """Heads not read today, then deep lanes that are open or whose sweep is thirty days old."""
    n = F.col("n_nationkey")
    day = F.lit(DAY).cast("date")
    rows = table(spark, sf_dir, "nation").select("n_name", n.alias("position"), F.when(n % 3 == 0, day).when(n % 3 == 1, F.date_sub(day, 1)).alias("head_read"), (n % 4 > 1).alias("deep_done"), F.when(n % 4 == 2, F.date_sub(day, 30)).when(n % 4 == 3, F.date_sub(day, 29)).alias("deep_done_on"))
    return queues.next_topic(rows, DAY).select("n_name", "mode")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 90")
def kept_newest(spark, sf_dir):
    return queues.keep_newest(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate").desc(), F.col("o_orderkey")], 90).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 UNION SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0")
def admitted_page(spark, sf_dir):
    """A queue takes a page's new keys when all of them fit."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    out, taken = ledger.admit(c.where("c_custkey % 3 = 0"), c.where("c_custkey % 5 = 0").unionAll(c.where("c_custkey % 5 = 0")), ["c_custkey"], 10**9)
    assert taken and not ledger.admit(c, c.limit(0).union(spark.range(1)), ["c_custkey"], 0)[1]
    return out


# Functions and the rest.


@query("""SELECT c_custkey, c_name AS strip, lower(c_mktsegment) || 'ss' AS fold, 3 * (c_custkey % 5)::BIGINT AS decoded, '2024-01-02 23:59:59' AS day_end FROM customer""")
def text_functions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    day = X.end_of_day(F.lit("2024-01-02"))
    content = F.repeat(F.lit("AAAA"), (F.col("c_custkey") % 5).cast("int"))
    return c.select("c_custkey", X.strip(F.concat(F.lit("\t  "), "c_name", F.lit(" \n"))).alias("strip"), X.casefold(F.concat("c_mktsegment", F.lit("ß"))).alias("fold"), X.decoded_size(content).cast("long").alias("decoded"), day.cast("string").alias("day_end"))


@query("""WITH c AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) SELECT user_id AS github_id, event_id FROM c WHERE r = 1""")
def audit_frame(spark, sf_dir):
    """The frame of an audit: the latest row of each id by the text of its time, then by canonical JSON."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("github_id"), "event_id", F.lit(None).cast("string").alias("observed_at"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("canonical"))
    return audit.deduplicate(rows).select("github_id", "event_id")


_NOTES = [("yes", "why", "paper", "https://example.net/x", "p"), ("maybe", "why", "paper", "https://example.net/x", "p"), ("yes", " ", "paper", "https://example.net/x", "p"), ("yes", "why", "blog", "https://example.net/x", "p"), ("yes", "why", "paper", "ftp://x", "p"), ("yes", "why", "repository", "https://example.net/x", None)]


@query("SELECT 'c' || doc_id AS case_id, CASE WHEN doc_id % 6 IN (1, 2) THEN 'annotator_1' ELSE 'evidence' END AS problem FROM documents WHERE doc_id % 6 > 0")
def annotation_problems(spark, sf_dir):
    dim = spark.createDataFrame([(i, *r) for i, r in enumerate(_NOTES)], "i long, label string, rationale string, kind string, url string, locator string")
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("case_id"), F.pmod("doc_id", F.lit(len(_NOTES))).alias("i")).join(F.broadcast(dim), "i")
    note = F.struct("label", "rationale")
    rows = d.select("case_id", note.alias("annotator_1"), F.struct(F.lit("no").alias("label"), F.lit("why").alias("rationale")).alias("annotator_2"), F.array(F.struct("kind", "url", "locator")).alias("evidence"), F.lit("yes").alias("adjudicated_label"))
    return audit.annotation_problems(rows)


@query("""SELECT problem FROM (SELECT 'repeated ids' AS problem, count(*) > count(DISTINCT user_id) AS bad FROM events UNION ALL SELECT 'unknown status', count(*) FILTER (event_type = 'error') > 0 FROM events UNION ALL SELECT 'included but no candidate', false) WHERE bad""")
def view_invariants(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "odd").otherwise("review")
    wrong = registry.invariants(table(spark, sf_dir, "events").select(F.col("user_id").alias("github_id"), status.alias("selection_status"), F.lit(False).alias("candidate_eligible")))
    return spark.createDataFrame([(w,) for w in wrong], "problem string")


@query("SELECT c_custkey AS github_id, c_name AS name, 'x' AS all_domains, c_custkey % 3 AS stars FROM customer")
def typed_view_files(spark, sf_dir):
    """The view's columns, typed and in order, written and read again."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("github_id"), F.col("c_name").alias("name"), F.array(F.lit("x")).alias("all_domains"), (F.col("c_custkey") % 3).cast("int").alias("stars"))
    path = scratch(spark, "view")
    registry.to_view(rows).write.option("compression", "zstd").parquet(path)
    out = spark.read.parquet(path)
    assert len(out.columns) == 49
    return out.select("github_id", "name", join("all_domains").alias("all_domains"), "stars")


class Catalog:
    """A remote service with ids 1 to 1,000, in pages of 100."""

    def __init__(self, options):
        self.last = 1000

    def page(self, since):
        return [{"id": i} for i in range(since + 1, min(since + 100, self.last) + 1)], None

    def papers(self, day, page, limit):
        n = 2 * limit + 1
        return [{"id": f"{day}/{i}", "github_repo": "https://github.com/a/b" if i % 2 else None} for i in range(page * limit, min((page + 1) * limit, n))]


def answer_even():
    return lambda keys: [None if int(k) % 2 else {"id": int(k)} for k in keys]


@query("SELECT i AS id FROM range(1, 1001) r(i)")
def enumerated_ids(spark, sf_dir):
    """A walk over a service in order of ids, within its budget of requests."""
    spark.dataSource.register(paged.PagedSource)
    rows = spark.read.format("paged").options(walk="enumerate", client="quarry.plans.flows:Catalog", max_requests="20").load()
    return rows.where("kind = 'item'").select(F.col("key").cast("long").alias("id"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 1 THEN 'missing' ELSE 'ok' END AS status, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS found FROM supplier")
def batched_lookups(spark, sf_dir):
    """Lookups in batches, answers aligned to keys."""
    out = paged.lookup(table(spark, sf_dir, "supplier"), "s_suppkey", "quarry.plans.flows:answer_even", 50)
    return out.select(F.col("key").cast("long").alias("s_suppkey"), "status", F.get_json_object("payload", "$.id").cast("long").alias("found"))


@query("""SELECT 'runs/papers-' || i || '.manifest.json' AS path FROM range(3) r(i) UNION ALL SELECT 'coverage/papers-' || i || '.json' FROM range(3) r(i) UNION ALL SELECT 'state/papers.json' UNION ALL SELECT 'data/observations/2024/01/10/papers-1.jsonl'""")
def published_runs(spark, sf_dir):
    """Three runs published one after the other, and the files of the last revision."""
    root, base = scratch(spark, "runs"), None
    for i in range(3):
        base = bundles.publish_run(spark, root, base, "papers", str(i), DAY, {"run": i}, {"pages": i}, ['{"github_id":1}'] if i == 1 else [])["snapshot"]
    return bundles.listing(spark, root).select("path")
