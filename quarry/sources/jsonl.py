"""JSON Lines sources: fail-closed validation, canonical JSON, file audits.

Lines are split at \\n only. A bad line never disappears: it goes to a violations frame (path, line, rule), and
``require`` raises if there is any.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quarry.functions import text as X

#: JSON types of the observation fields that rules read; every other key goes to extra_json.
STRINGS = ["name", "full_name", "url", "description", "homepage", "language", "license", "created_at", "pushed_at", "updated_at", "candidate_status", "observed_at"]
LABELS = ["query_ids", "domains", "methods", "novelty_signals", "paper_ids"]
FLAGS = ["archived", "fork", "queryless"]
COUNTS = ["stars", "forks"]
EVIDENCE = ["github_id", "repository_name_at_fetch", "observed_at", "readme_status", "readme_etag", "readme_blob_sha", "readme_evidence_version", "readme_signals", "readme_sections", "readme_checked_at"]


class InvalidInput(ValueError):
    """Input rows that break a rule; nothing was written."""


@F.pandas_udf(T.StringType())
def canonical_json(lines: pd.Series) -> pd.Series:
    """Sorted keys, no spaces, UTF-8, no NaN; null for what is not a JSON object. Arrow batches, for exact numbers."""

    def one(line):
        try:
            value = json.loads(line)
            return json.dumps(value, ensure_ascii=False, allow_nan=False, sort_keys=True, separators=(",", ":")) if isinstance(value, dict) else None
        except (TypeError, ValueError):
            return None

    return lines.map(one)


def _without(known: list[str]):
    """Of canonical JSON objects, the canonical JSON of all keys but the known ones; null where none is left."""

    @F.pandas_udf(T.StringType())
    def extra(lines: pd.Series) -> pd.Series:
        drop = frozenset(known)

        def one(line):
            if line is None:
                return None
            left = {k: v for k, v in json.loads(line).items() if k not in drop}
            return json.dumps(left, ensure_ascii=False, sort_keys=True, separators=(",", ":")) if left else None

        return lines.map(one)

    return extra


def recover_ids(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(github_id,) of earlier outputs, each once; lines that do not parse or have no positive id are passed over."""
    v = F.try_parse_json("value")
    kind = F.schema_of_variant(F.try_variant_get(v, "$.github_id", "variant"))
    found = lines(spark, paths).select(F.when(kind == "BIGINT", F.try_variant_get(v, "$.github_id", "bigint")).alias("github_id"))
    return found.where("github_id > 0").distinct()


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line, value): every line with its file and number, from 0 in each file's split order."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def strict_violations(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, rule) of files that are not strict: not UTF-8, a carriage return, no final line feed, a blank line; the first that holds.

    Files are read by lines, so a large one is many tasks'. Lines and their line feeds are as many bytes as the file,
    or one more where the last line feed is missing.
    """
    same = lambda c: F.regexp_replace(c, r"^file:/+", "file:/")
    text = F.col("value")
    seen = lines(spark, paths).groupBy(same("path").alias("path")).agg(
        F.sum(F.octet_length(text) + 1).alias("bytes"), F.count_if(~F.is_valid_utf8(text)).alias("bad"), F.count_if(F.contains(text, F.lit("\r"))).alias("returns"), F.count_if(X.strip(text).isNull()).alias("blank")
    )
    files = spark.read.format("binaryFile").load(paths).select(same("path").alias("path"), F.col("length").alias("size"))  # contents are not read
    rule = F.when(F.col("bad") > 0, "utf8").when(F.col("returns") > 0, "carriage-return").when(F.col("bytes") > F.col("size"), "no-final-line-feed").when(F.col("blank") > 0, "blank-line")
    return seen.join(files, "path").select("path", rule.alias("rule")).where("rule IS NOT NULL")


def fingerprints(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, sha256) of each file."""
    return spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"))


def _kind(key: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("v", f"$.{key}", "variant"))


def _absent(key: str) -> Column:
    return F.try_variant_get("v", f"$.{key}", "variant").isNull()


def _typed(key: str, *kinds: str) -> Column:
    """Whether a key is absent or null or of one of the JSON types."""
    k = _kind(key)
    return _absent(key) | k.isin("VOID", *kinds)


def observations(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, violations) of observation files. Blank lines are skipped; rows are typed strictly (true is no number).

    rows: github_id, typed fields, extra_json, canonical, stamp (UTC microseconds), rank (1 search, 0 queryless).
    """
    raw = lines(spark, paths).where(X.strip(F.col("value")).isNotNull()).withColumn("canonical", canonical_json("value"))
    parsed = raw.withColumn("v", F.try_parse_json("canonical"))
    strings = lambda k: F.try_variant_get("v", f"$.{k}", "array<variant>")
    id_ok = _kind("github_id").isin("BIGINT") & (F.try_variant_get("v", "$.github_id", "bigint") > 0)
    stamp = X.unix_micros(X.strip(F.try_variant_get("v", "$.observed_at", "string")))
    clean = lambda k: F.forall(F.coalesce(strings(k), F.array().cast("array<variant>")), lambda x: (F.schema_of_variant(x) == "STRING") & X.strip(F.try_variant_get(x, "$", "string")).isNotNull())
    listed = lambda k: _absent(k) | ((_kind(k) == "VOID") & F.lit(k != "paper_ids")) | (_kind(k).startswith("ARRAY") & F.coalesce(clean(k), F.lit(False)))
    checks = [(F.col("v").isNull(), "not-an-object"), (~F.coalesce(id_ok, F.lit(False)), "github_id"), (~F.coalesce(_absent("queryless") | (_kind("queryless") == "BOOLEAN"), F.lit(False)), "queryless"), (stamp.isNull(), "observed_at")]
    checks += [(~F.coalesce(listed(k), F.lit(False)), k) for k in LABELS]
    rule = F.coalesce(*[F.when(c, F.lit(r)) for c, r in checks])
    judged = parsed.withColumn("rule", rule)
    texts = lambda k: F.from_json(F.try_variant_get("v", f"$.{k}", "string"), "array<string>")
    known = [*STRINGS, *LABELS, *FLAGS, *COUNTS, "github_id", "topics"]
    rows = judged.where("rule IS NULL").select(
        F.try_variant_get("v", "$.github_id", "bigint").alias("github_id"),
        *[F.when(_kind(k) == "STRING", F.try_variant_get("v", f"$.{k}", "string")).alias(k) for k in STRINGS],
        *[texts(k).alias(k) for k in [*LABELS, "topics"]],
        *[F.when(_kind(k) == "BOOLEAN", F.try_variant_get("v", f"$.{k}", "boolean")).alias(k) for k in FLAGS],
        *[F.when(_kind(k) == "BIGINT", F.try_variant_get("v", f"$.{k}", "bigint")).alias(k) for k in COUNTS],
        _without(known)("canonical").alias("extra_json"), "canonical", stamp.alias("stamp"),
        F.when(F.coalesce(F.try_variant_get("v", "$.queryless", "boolean"), F.lit(False)), 0).otherwise(1).alias("rank"), "path",
    )
    return rows, judged.where("rule IS NOT NULL").select("path", "value", "rule")


def evidence(spark: SparkSession, paths: str | list[str], versions: list[str], signals: list[str], sections: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, violations) of README evidence files: exactly the ten fields, known enums, no signals on missing files."""
    raw = lines(spark, paths).where(X.strip(F.col("value")).isNotNull()).withColumn("canonical", canonical_json("value"))
    typed = "github_id bigint, repository_name_at_fetch string, observed_at string, readme_status string, readme_etag string, readme_blob_sha string, readme_evidence_version string, readme_signals array<string>, readme_sections array<string>, readme_checked_at string"
    df = raw.withColumns({"v": F.try_parse_json("canonical"), "k": F.json_object_keys("canonical"), "r": F.from_json("canonical", typed)})
    some = lambda c: X.strip(F.col(f"r.{c}")).isNotNull() & (_kind(c) == "STRING")
    enum = lambda c, known: F.coalesce((F.size(F.array_distinct(f"r.{c}")) == F.size(f"r.{c}")) & (F.size(F.array_except(f"r.{c}", F.array(*map(F.lit, known)))) == 0), F.lit(False))
    checks = [
        (F.col("v").isNull(), "not-an-object"), (~F.coalesce(F.array_sort("k") == F.array_sort(F.array(*map(F.lit, EVIDENCE))), F.lit(False)), "fields"),
        (~F.coalesce((_kind("github_id") == "BIGINT") & (F.col("r.github_id") > 0), F.lit(False)), "github_id"), (X.unix_micros(F.col("r.observed_at")).isNull(), "observed_at"),
        (~(some("repository_name_at_fetch") & some("readme_status") & some("readme_evidence_version")), "empty"), (~F.col("r.readme_status").isin("ok", "unchanged", "missing"), "readme_status"),
        (~F.col("r.readme_evidence_version").isin(*versions), "readme_evidence_version"), (~(_typed("readme_etag", "STRING") & _typed("readme_blob_sha", "STRING") & _typed("readme_checked_at", "STRING")), "type"),
        (~enum("readme_signals", signals), "readme_signals"), (~enum("readme_sections", sections), "readme_sections"),
        ((F.col("r.readme_status") == "missing") & (F.size("r.readme_signals") > 0), "missing-with-signals"), (F.col("r.readme_checked_at").isNotNull() & X.unix_micros(F.col("r.readme_checked_at")).isNull(), "readme_checked_at"),
    ]
    judged = df.withColumn("rule", F.coalesce(*[F.when(c, F.lit(x)) for c, x in checks]))
    rows = judged.where("rule IS NULL").select("r.*", "canonical", X.unix_micros(F.col("r.observed_at")).alias("stamp"))
    return rows, judged.where("rule IS NOT NULL").select("path", "value", "rule")


def require(rows: DataFrame, violations: DataFrame, quarantine: str | None = None) -> DataFrame:
    """rows, if no line broke a rule; else InvalidInput, or with quarantine the bad lines go there."""
    if quarantine:
        violations.write.mode("append").parquet(quarantine)
        return rows
    bad = violations.take(3)
    if bad:
        raise InvalidInput("; ".join(f"{r.path}: {r.rule}: {r.value[:120]}" for r in bad))
    return rows


def not_canonical(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines that differ from their canonical form."""
    df = lines(spark, paths).withColumn("canonical", canonical_json("value"))
    return df.where(~F.col("value").eqNullSafe(F.col("canonical"))).select("path", "value", F.lit("not-canonical").alias("rule"))


def audit_files(found: DataFrame, listed: DataFrame) -> DataFrame:
    """(path, problem): files that no manifest lists, listed files that are missing, and other row counts.

    found and listed: (path, rows).
    """
    both = found.alias("f").join(listed.alias("l"), "path", "full_outer")
    problem = F.when(F.col("l.rows").isNull(), "not-listed").when(F.col("f.rows").isNull(), "missing").when(F.col("f.rows") != F.col("l.rows"), "row-count")
    return both.select("path", problem.alias("problem")).where("problem IS NOT NULL")
