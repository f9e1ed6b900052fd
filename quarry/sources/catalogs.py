"""Versioned catalogs in TOML: query specs and topics. They are small by contract and become broadcast dimensions."""

from __future__ import annotations

import re
import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ID, _SLUG = re.compile(r"[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"), re.compile(r"[a-z0-9](?:[a-z0-9-]*[a-z0-9])?")
MAX_QUERY, MAX_TOPICS = 512, 100


class InvalidCatalog(ValueError):
    pass


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise InvalidCatalog(what)


def read_queries(folder: str | Path) -> list[dict]:
    """All [[queries]] of all *.toml files, in order of their ids; ids are unique over files."""
    out: dict[str, dict] = {}
    for path in sorted(Path(folder).glob("*.toml")):
        for entry in tomllib.loads(path.read_text(encoding="utf-8")).get("queries", []):
            _need(set(entry) <= {"id", "q", "domains", "methods"}, f"{path.name}: unknown field in {sorted(entry)}")
            key, q = entry.get("id"), entry.get("q")
            _need(isinstance(key, str) and _ID.fullmatch(key) is not None, f"{path.name}: bad id {key!r}")
            _need(key not in out, f"{path.name}: repeated id {key}")
            _need(isinstance(q, str) and 0 < len(q.strip()) and len(q) <= MAX_QUERY and q.isprintable(), f"{path.name}: bad query of {key}")
            for kind in ("domains", "methods"):
                some = entry.get(kind, [])
                _need(isinstance(some, list) and all(isinstance(s, str) and _SLUG.fullmatch(s) for s in some) and len(set(some)) == len(some), f"{path.name}: bad {kind} of {key}")
            out[key] = {"id": key, "q": q, "domains": entry.get("domains", []), "methods": entry.get("methods", [])}
    _need(bool(out), f"no queries in {folder}")
    return [out[k] for k in sorted(out)]


def read_topics(path: str | Path) -> list[str]:
    """The ordered topics of [catalog]; 1 to 100 distinct slugs and nothing else."""
    found = tomllib.loads(Path(path).read_text(encoding="utf-8"))
    _need(set(found) == {"catalog"} and set(found["catalog"]) == {"topics"}, "only [catalog] topics is allowed")
    topics = found["catalog"]["topics"]
    _need(isinstance(topics, list) and 1 <= len(topics) <= MAX_TOPICS and all(isinstance(t, str) and _SLUG.fullmatch(t) for t in topics) and len(set(topics)) == len(topics), "bad topics")
    return topics


def queries(spark: SparkSession, folder: str) -> DataFrame:
    return spark.createDataFrame([tuple(e.values()) for e in read_queries(folder)], "id string, q string, domains array<string>, methods array<string>")


def topics(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(read_topics(path))), "pos int, topic string")
