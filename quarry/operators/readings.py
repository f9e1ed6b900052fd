"""Readings of README files: conditional requests, checked answers, compact records, and when each row is due again.

The texts pass through one query and are never stored: what is written are signals, sections and the answer's marks.
"""

from __future__ import annotations

import importlib

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quarry.functions import patterns as P, text as X
from quarry.operators import registry, rules

#: The most bytes of a file, and days until a row is due again after an answer, a missing file and an error.
MAX_BYTES, OK_DAYS, MISSING_DAYS, ERROR_DAYS = 1_000_000, 365, 30, 1
STATE = "repository_name_at_fetch string, readme_etag string, readme_blob_sha string, readme_evidence_version string, readme_signals array<string>, readme_sections array<string>, readme_checked_at string, due_at string, last_status int, tried_version string"
ANSWER = "github_id long, http_status int, etag string, body string"


def earlier_signals(view: DataFrame, prior: DataFrame) -> DataFrame:
    """view with earlier_signals: those of a reading under the same name and version that did not end in a missing file."""
    side = prior.select(F.col("github_id").alias("k"), F.struct("repository_name_at_fetch", "readme_evidence_version", "readme_signals", "last_status").alias("p"))
    same = (F.col("p.repository_name_at_fetch") == F.coalesce(F.nullif("full_name", F.lit("")), "name") if "full_name" in view.columns else F.col("p.repository_name_at_fetch") == F.col("name"))
    kept = F.when(same & (F.col("p.readme_evidence_version") == P.README_VERSION) & ~F.coalesce(F.col("p.last_status") == 404, F.lit(False)), F.col("p.readme_signals"))
    return view.join(side, F.col("github_id") == F.col("k"), "left").withColumn("earlier_signals", kept).drop("k", "p")


def to_read(queue: DataFrame, prior: DataFrame, now: Column) -> DataFrame:
    """The rows of queue (github_id, name, ...) that are due, with sent_etag: the mark of a reading of this name and version.

    A row waits for its time only if it was read, or tried, under the same name and version.
    """
    side = prior.select(F.col("github_id").alias("k"), F.struct("repository_name_at_fetch", "readme_evidence_version", "tried_version", "due_at", "readme_etag").alias("p"))
    both = queue.join(side, F.col("github_id") == F.col("k"), "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    same, current = yes(F.col("p.repository_name_at_fetch") == F.col("name")), yes(F.col("p.readme_evidence_version") == P.README_VERSION)
    tried = yes(F.col("p.tried_version") == P.README_VERSION)
    waits = same & (current | tried) & yes(F.col("p.due_at").cast("timestamp") > now)
    return both.where(~waits).withColumn("sent_etag", F.when(same & current, F.col("p.readme_etag"))).drop("k", "p")


def ask(todo: DataFrame, client: str) -> DataFrame:
    """One conditional request for each row of todo (github_id, name, sent_etag, position), in order; the answers.

    client, "module:function", makes a callable (name, etag) -> (status, etag, body). After a 403 or 429 nothing more is
    asked, and that row has no answer but its status. One token's requests are paced, so they run in one task.
    """

    def work(frames):
        import pandas as pd

        module, _, name = client.partition(":")
        get, open_ = getattr(importlib.import_module(module), name)(), True
        for f in frames:
            out = []
            for i, n, etag in zip(f["github_id"], f["name"], f["sent_etag"], strict=True):
                if not open_:
                    break
                status, mark, body = get(n, etag)
                open_ = status not in (403, 429)
                out.append((i, status, mark, body))
            yield pd.DataFrame(out, columns=["github_id", "http_status", "etag", "body"])

    one = todo.select("github_id", "name", "sent_etag", "position").coalesce(1).sortWithinPartitions("position")
    return one.mapInPandas(work, ANSWER)


def checked(answers: DataFrame) -> DataFrame:
    """answers with outcome (ok, unchanged, missing, limited, error), text and blob_sha; a body that breaks a rule is an error."""
    rows = answers.withColumn("v", F.try_parse_json("body"))
    of = lambda k: F.try_variant_get("v", f"$.{k}", "variant")
    kind = lambda k: F.coalesce(F.schema_of_variant(of(k)), F.lit(""))
    string = lambda k: F.when(kind(k) == "STRING", F.try_variant_get("v", f"$.{k}", "string"))
    size = F.when(kind("size") == "BIGINT", F.try_variant_get("v", "$.size", "bigint"))
    packed = F.regexp_replace(string("content"), r"[\r\n]", "")
    strict = packed.rlike(r"\A(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\z")
    rows = rows.withColumns({"size": size, "sha": string("sha"), "raw": F.when(strict & (string("encoding") == "base64"), F.unbase64(packed))})
    text = F.try_validate_utf8(F.col("raw").cast("string"))
    good = (F.octet_length("body") <= 2 * MAX_BYTES) & (string("type") == "file") & F.col("size").between(0, MAX_BYTES) & F.length("sha").between(1, 128) & (F.length("raw") == F.col("size")) & text.isNotNull()
    s = F.col("http_status")
    outcome = F.when(s.isin(403, 429), "limited").when(s == 304, "unchanged").when(s == 404, "missing").when((s == 200) & F.coalesce(good, F.lit(False)), "ok").otherwise("error")
    return rows.select("github_id", "http_status", "etag", outcome.alias("outcome"), text.alias("text"), "sha").withColumns({"text": F.when(F.col("outcome") == "ok", F.col("text")), "blob_sha": F.when(F.col("outcome") == "ok", F.col("sha"))}).drop("sha")


def records(todo: DataFrame, answers: DataFrame, prior: DataFrame, now: Column) -> DataFrame:
    """(github_id, queue_tier, outcome, record, state) of every answered row but the one that was limited.

    record: the ten evidence fields, null for errors. A file that is unchanged keeps what was read, a missing one has
    nothing to say; state, what the next run knows of the row, keeps earlier evidence in either case.
    """
    read = rules.readme_evidence(checked(answers).where("outcome <> 'limited'"))
    was = prior.select(F.col("github_id").alias("k"), F.struct(*[c.strip().split(" ")[0] for c in STATE.split(", ")]).alias("p"))
    rows = read.join(todo.select(F.col("github_id").alias("q"), "name", "queue_tier", "sent_etag"), F.col("github_id") == F.col("q")).join(was, F.col("github_id") == F.col("k"), "left")
    ok, same = F.col("outcome") == "ok", F.col("outcome") == "unchanged"
    none = F.array().cast("array<string>")
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    pick = lambda own, c, other: F.when(ok, own).when(same, F.col(f"p.{c}")).otherwise(other)
    etag = F.when(same, F.coalesce("etag", "sent_etag")).otherwise(F.col("etag"))
    version = F.lit(P.README_VERSION)
    record = F.struct(
        "github_id", F.col("name").alias("repository_name_at_fetch"), stamp.alias("observed_at"), F.col("outcome").alias("readme_status"), etag.alias("readme_etag"),
        F.when(same, F.col("p.readme_blob_sha")).otherwise(F.col("blob_sha")).alias("readme_blob_sha"), F.when(same, F.coalesce("p.readme_evidence_version", version)).otherwise(version).alias("readme_evidence_version"),
        X.sorted_set(F.coalesce(pick(F.col("readme_signals"), "readme_signals", none), none)).alias("readme_signals"), X.sorted_set(F.coalesce(pick(F.col("readme_sections"), "readme_sections", none), none)).alias("readme_sections"),
        stamp.alias("readme_checked_at"),
    )
    days = F.when(ok | same, OK_DAYS).when(F.col("outcome") == "missing", MISSING_DAYS).otherwise(ERROR_DAYS)
    due = F.date_format(now + F.make_dt_interval(days=days), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    kept = lambda own, c: F.when(ok, own).otherwise(F.col(f"p.{c}")).alias(c)
    error = F.col("outcome") == "error"
    state = F.struct(
        F.col("name").alias("repository_name_at_fetch"), F.when(ok | same, etag).otherwise(F.col("p.readme_etag")).alias("readme_etag"), kept(F.col("blob_sha"), "readme_blob_sha"), kept(version, "readme_evidence_version"),
        kept(F.col("readme_signals"), "readme_signals"), kept(F.col("readme_sections"), "readme_sections"), F.when(error, F.col("p.readme_checked_at")).otherwise(stamp).alias("readme_checked_at"), due.alias("due_at"),
        F.when(ok, F.lit(None).cast("int")).when(F.col("outcome") == "missing", 404).otherwise(F.col("p.last_status")).alias("last_status"), F.when(ok | same, F.col("p.tried_version")).otherwise(version).alias("tried_version"),
    )
    return rows.select("github_id", "queue_tier", "outcome", F.when(~error, record).alias("record"), state.alias("state"))


def next_states(prior: DataFrame, done: DataFrame) -> DataFrame:
    """What is known of every row after done, the result of records."""
    return registry.upsert(prior, done.select("github_id", "state.*"), ["github_id"])


def tier_cursors(done: DataFrame) -> DataFrame:
    """(queue_tier, cursor): the id of each tier's last answered row in the order of the queue."""
    last = F.row_number().over(W.partitionBy("queue_tier").orderBy(F.col("position").desc()))
    return done.withColumn("r", last).where("r = 1").select("queue_tier", F.col("github_id").alias("cursor"))
