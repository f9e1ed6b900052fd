"""Bundles of a run: files and a marker with their digests, published at one revision of a root or not at all.

A root's revision is its HEAD. A writer whose answer was lost finds its own marker at HEAD and is done.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.streaming import ledger

#: The form of a run's name, the paths of inputs, and the most bytes of a run's state by kind.
RUN = re.compile(r"[A-Za-z0-9_-]{1,128}")
OBSERVATIONS, EVIDENCE = r"^data/observations/.+\.jsonl$", r"^data/readme-evidence/\d{4}/\d{2}/\d{2}/[^/]+\.jsonl$"
STATE_BYTES = {"census": 32 << 20, "topics": 32 << 20, "papers": 1 << 20}


def publish(spark: SparkSession, root: str, base: str | None, run: str, files: dict[str, str], kind: str) -> dict:
    """Add files (path to text) and a marker in one step to the root, whose HEAD must be base; the new HEAD.

    Files go to a folder of the new revision; only the swap of HEAD makes them part of the root.
    """
    if not RUN.fullmatch(run):
        raise ValueError(f"unsafe run name {run!r}")
    marker = f"runs/{kind}-{run}.manifest.json"
    for path in files:
        if ledger.safe(path) == marker:
            raise ValueError("a file has the marker's place")
    digests = {p: hashlib.sha256(t.encode()).hexdigest() for p, t in sorted(files.items())}
    body = ledger.canonical({"format": kind, "version": 1, "run": run, "parent": base, "payloads": digests})
    name = hashlib.sha256(body.encode()).hexdigest()[:20]
    now = ledger.head(spark, root)
    if now and now["snapshot"] == name and not missing(spark, root, now, files | {marker: body}):
        return now
    if (now["snapshot"] if now else None) != base:
        raise ledger.Conflict(f"HEAD is not {base}")
    listed = dict(now["files"]) if now else {}
    if marker in listed:
        raise ValueError(f"run {run} is there already")
    for path, text in (files | {marker: body}).items():
        ledger.write_text(spark, f"{root}/revisions/{name}/{path}", text)
    value = {"snapshot": name, "parent": base, "files": listed | dict.fromkeys([*files, marker], name)}
    ledger.swap(spark, root, base, value)
    return value


def missing(spark: SparkSession, root: str, head: dict, files: dict[str, str]) -> list[str]:
    """The paths that HEAD does not have with the contents given."""
    return [p for p, t in files.items() if p not in head["files"] or ledger.read_text(spark, f"{root}/revisions/{head['files'][p]}/{p}") != t]


def listing(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(revision, path, file): the files of the root at its present revision, by name; a later revision does not change them."""
    now = ledger.head(spark, root)
    rows = [(now["snapshot"], p, f"{root}/revisions/{r}/{p}") for p, r in sorted(now["files"].items())] if now else []
    out = spark.createDataFrame(rows, "revision string, path string, file string")
    return inputs(out, pattern) if pattern else out


def inputs(files: DataFrame, pattern: str, path: str = "path") -> DataFrame:
    """The files whose path has the form of an input."""
    return files.where(F.col(path).rlike(pattern))


def publish_run(spark: SparkSession, root: str, base: str | None, kind: str, run: str, day: str, state: dict, coverage: dict, lines: list[str]) -> dict:
    """A census, topic or paper run: its coverage, its state and, where there are any, its observations under their day."""
    if kind not in STATE_BYTES:
        raise ValueError(f"unknown kind {kind!r}")
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
        raise ValueError(f"no day {day!r}")
    saved = ledger.canonical(state)
    if len(saved.encode()) > STATE_BYTES[kind]:
        raise ValueError("the state is too large")
    for line in lines:
        if "\n" in line or not isinstance(json.loads(line), dict):
            raise ValueError("an observation is not one object a line")
    files = {f"coverage/{kind}-{run}.json": ledger.canonical(coverage), f"state/{kind}.json": saved}
    if lines:
        files[f"data/observations/{day.replace('-', '/')}/{kind}-{run}.jsonl"] = "".join(f"{x}\n" for x in lines)
    return publish(spark, root, base, run, files, kind)


def hydrate(spark: SparkSession, root: str, kind: str) -> dict | None:
    """The state that the last run of a kind left at the root."""
    now = ledger.head(spark, root)
    path = f"state/{kind}.json"
    if not now or path not in now["files"]:
        return None
    return ledger.load_state(spark, f"{root}/revisions/{now['files'][path]}/{path}")
