"""An archive's links as a snapshot of two tables: assertions checked against their provenance, joined to repositories by name."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quarry.functions import text as X
from quarry.operators import registry
from quarry.streaming import ledger

SOURCE = ["source_dataset", "source_revision", "source_snapshot", "source_license", "source_license_url"]
LINKS = (
    "source_row_offset bigint not null, normalized_repo_name string not null, paper_url string, paper_arxiv_id string, is_official boolean, source_repo_url string, "
    + ", ".join(f"{c} string not null" for c in [*SOURCE, "source_attribution"]) + ", github_id bigint"
)


def assertion(row: str = "v") -> list[Column]:
    """The typed fields of an archive row, a variant: a value of another type is null; an older name of the paper's number also counts."""
    kind = lambda k: F.coalesce(F.schema_of_variant(F.try_variant_get(row, f"$.{k}", "variant")), F.lit(""))
    string = lambda k: F.when(kind(k) == "STRING", F.try_variant_get(row, f"$.{k}", "string"))
    number = F.when(F.coalesce(kind("paper_arxiv_id"), F.lit("")).isin("", "VOID"), string("arxiv_id")).otherwise(string("paper_arxiv_id"))
    flag = F.when(kind("is_official") == "BOOLEAN", F.try_variant_get(row, "$.is_official", "boolean"))
    return [string("paper_url").alias("paper_url"), number.alias("paper_arxiv_id"), flag.alias("is_official"), string("repo_url").alias("source_repo_url")]


def link_records(rows: DataFrame, provenance: dict[str, str], attribution: str, row: str = "v") -> DataFrame:
    """Links of archive rows (source_row_offset, v) whose address is a repository's, with their provenance."""
    own = [F.lit(provenance[c]).alias(c) for c in SOURCE]
    out = rows.select("source_row_offset", *assertion(row), *own, F.lit(attribution).alias("source_attribution"))
    return out.withColumn("normalized_repo_name", X.loose_repository(F.col("source_repo_url"))).where("normalized_repo_name IS NOT NULL")


def foreign(rows: DataFrame, provenance: dict[str, str]) -> DataFrame:
    """Rows whose provenance is another, or that credit nobody."""
    same = F.lit(True)
    for c in SOURCE:
        same = same & F.col(c).eqNullSafe(F.lit(provenance[c]))
    return rows.where(~(same & X.strip(F.col("source_attribution")).isNotNull()))


def pair(links: DataFrame, observations: DataFrame, provenance: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(repositories, links with github_id), or ValueError: rows of another source, or an offset with two contents."""
    for df, what in ((links, "link"), (observations, "observation")):
        if foreign(df, provenance).limit(1).count():
            raise ValueError(f"a {what} of another source")
    packed = links.withColumn("canonical", F.to_json(F.struct(*sorted(links.columns)), {"ignoreNullFields": "false"}))
    clash = registry.conflicts(packed, "source_row_offset").first()
    if clash:
        raise ValueError(f"offset {clash.source_row_offset} has two contents")
    repositories = registry.latest(observations, "github_id", ["stamp", "canonical"])
    return repositories, registry.link_by_name(links.dropDuplicates(["source_row_offset"]), repositories)


def write_pair(spark: SparkSession, path: str, repositories: DataFrame, links: DataFrame, provenance: dict[str, str], inputs: DataFrame) -> dict:
    """Write both tables and a manifest of provenance, inputs, counts and digests; the manifest comes last."""
    out: dict = {"provenance": provenance, "inputs": [r.asDict() for r in inputs.orderBy("path").collect()], "outputs": {}}
    typed = T.StructType.fromDDL(LINKS)
    links = links.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=provenance) for f in typed])
    for name, df, key in (("repositories", repositories, "github_id"), ("paper_links", links, "source_row_offset")):
        df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
        out["outputs"][name] = summary(spark, f"{path}/{name}")
    ledger.write_text(spark, f"{path}/manifest.json", ledger.canonical(out))
    return out


def summary(spark: SparkSession, path: str) -> dict:
    """Rows, schema and a digest of a table's rows that does not depend on files or order."""
    df = spark.read.parquet(path)
    each = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    halves = [F.sum(F.conv(F.substring(each, i, 15), 16, 10).cast("decimal(38,0)")).cast("string") for i in (1, 17, 33, 49)]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.concat_ws(":", *halves).alias("digest")).first()
    return {"rows": row.n, "schema": df.schema.simpleString(), "digest": row.digest}


def problems(spark: SparkSession, path: str, provenance: dict[str, str], card: str | None = None, words: tuple[str, ...] = ("attribution", "modifications", "limitations", "github_id", "repositories", "paper_links")) -> list[str]:
    """What is wrong with a written pair: its manifest, provenance, counts, types, contents, or the card that describes it."""
    text = ledger.read_text(spark, f"{path}/manifest.json")
    if not text:
        return ["no manifest"]
    found = json.loads(text)
    out = [] if found.get("provenance") == provenance else ["provenance"]
    for name in ("repositories", "paper_links"):
        if not ledger.exists(spark, f"{path}/{name}"):
            out.append(f"{name} is missing")
        elif found.get("outputs", {}).get(name) != summary(spark, f"{path}/{name}"):
            out.append(f"{name} is not what the manifest says")
    if card is not None:
        out += [f"the card lacks {w}" for w in words if w not in card.lower()]
    return out


def publish_pair(spark: SparkSession, root: str, path: str, provenance: dict[str, str], card: str, main: str | None = None) -> dict:
    """Point root at a written pair that has no problems; never the root of the main registry."""
    if main is not None and root.rstrip("/") == main.rstrip("/"):
        raise ValueError("the archive does not go to the main registry")
    wrong = problems(spark, path, provenance, card)
    if wrong:
        raise ValueError("; ".join(wrong))
    now, name = ledger.head(spark, root), ledger.content_path("archive", json.loads(ledger.read_text(spark, f"{path}/manifest.json")))
    if now and now["snapshot"] == name:
        return now | {"skipped": True}
    for part in ("repositories", "paper_links"):
        spark.read.parquet(f"{path}/{part}").write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}/{part}")
    ledger.write_text(spark, f"{root}/{name}/README.md", card)
    ledger.write_text(spark, f"{root}/{name}/manifest.json", ledger.read_text(spark, f"{path}/manifest.json"))
    ledger.swap(spark, root, now and now["snapshot"], {"snapshot": name, "parent": now and now["snapshot"]})
    return ledger.head(spark, root)
