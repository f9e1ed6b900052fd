"""Durable state of resumable runs: a pointer that is swapped by comparison, idempotent batches, snapshots, retry pools.

Files go through Hadoop's file systems, so any store that Spark writes does.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.operators import registry

#: Tries before a row is parked, and the most bytes of a state.
MAX_ATTEMPTS, MAX_STATE = 5, 32 << 20


class Conflict(RuntimeError):
    """Another writer moved the pointer first."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Stage, then rename over the old file."""
    fs, p = _fs(spark, path)
    staged = spark._jvm.org.apache.hadoop.fs.Path(path + ".staged")
    stream = fs.create(staged, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(p, False)
    if not fs.rename(staged, p):
        raise OSError(f"cannot replace {path}")


def safe(path: str) -> str:
    """A relative path without parent steps, else ValueError."""
    parts = path.split("/")
    if not path or path.startswith("/") or "\\" in path or any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"unsafe path {path!r}")
    return path


def canonical(value) -> str:
    return json.dumps(value, ensure_ascii=False, allow_nan=False, sort_keys=True, separators=(",", ":"))


def head(spark: SparkSession, root: str) -> dict | None:
    text = read_text(spark, f"{root}/HEAD")
    return json.loads(text) if text else None


def swap(spark: SparkSession, root: str, parent: str | None, value: dict) -> None:
    """Move HEAD from parent (a snapshot's name) to value, or Conflict.

    A lock file that only one writer can create guards the comparison. A writer whose answer was lost finds its
    own snapshot at HEAD and is done.
    """
    fs, lock = _fs(spark, f"{root}/HEAD.lock")
    if not fs.createNewFile(lock):
        raise Conflict("HEAD is being moved")
    try:
        now = head(spark, root)
        name = now["snapshot"] if now else None
        if name == value["snapshot"]:
            return
        if name != parent:
            raise Conflict(f"HEAD is {name}, not {parent}")
        write_text(spark, f"{root}/HEAD", canonical(value))
    finally:
        fs.delete(lock, False)


def publish_snapshot(spark: SparkSession, root: str, view: DataFrame, rows: DataFrame, inputs: DataFrame, versions: dict[str, str], attempts: int = 3) -> dict:
    """Write the four views and a manifest as one snapshot and point HEAD at it; skip if inputs and versions are as before.

    inputs: (path, sha256). The view must keep its invariants. A moved HEAD means another look and another try.
    """
    digest = registry.fingerprint(inputs).first()[0]
    for _ in range(attempts):
        now = head(spark, root)
        if now and now["fingerprint"] == digest and now["versions"] == versions:
            return now | {"skipped": True}
        wrong = registry.invariants(view)
        if wrong:
            raise ValueError("; ".join(wrong))
        name = hashlib.sha256(canonical([digest, versions, now and now["snapshot"]]).encode()).hexdigest()[:20]
        counts = {}
        for label, df in {**registry.views(view), "observations": rows}.items():
            path = f"{root}/snapshots/{name}/{label}"
            registry.to_view(df).write.mode("overwrite").option("compression", "zstd").parquet(path)
            counts[label] = spark.read.parquet(path).count()
        summary = {f"{r.kind}:{r.label}": r.n for r in registry.selection_summary(view).collect()}
        value = {"snapshot": name, "fingerprint": digest, "versions": versions, "counts": counts, "selection": summary, "parent": now and now["snapshot"]}
        write_text(spark, f"{root}/snapshots/{name}/manifest.json", canonical(value))
        try:
            swap(spark, root, now and now["snapshot"], value)
            return value
        except Conflict:
            continue
    raise Conflict("HEAD kept moving")


def batch_sink(root: str, name: str):
    """A foreachBatch function: each batch's rows by kind in a folder of its number, which a replay overwrites whole."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").partitionBy("kind").parquet(f"{root}/{safe(name)}/batch={batch}")

    return write


def content_path(prefix: str, *parts) -> str:
    """A path from the digest of what is stored there, so storing it twice is storing it once."""
    return f"{safe(prefix)}/{hashlib.sha256(canonical(list(parts)).encode()).hexdigest()}"


def save_state(spark: SparkSession, path: str, state: dict, most: int = MAX_STATE) -> None:
    text = canonical(state)
    if len(text.encode()) > most:
        raise ValueError(f"a state of {len(text)} characters is too large")
    write_text(spark, path, text)


def load_state(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, path)

    def sole(pairs):
        if len({k for k, _ in pairs}) < len(pairs):
            raise ValueError("repeated key in a state")
        return dict(pairs)

    return json.loads(text, object_pairs_hook=sole) if text else None


def under_policy(state: dict | None, version: int) -> dict | None:
    """A walk's state, if it was saved under this version of the queries' rules; else progress starts anew, since cursors
    that count pages or finished years of other queries say nothing."""
    if state is None or state.get("policy") == version:
        return state
    return None


def window(state: dict | None, start: str, now: str) -> dict:
    """The frozen window of a run: an open one goes on; a complete one hands its end to the next as start."""
    if state and not state.get("complete"):
        return state
    return {"since": state["until"] if state else start, "until": now, "complete": False}


def retry_pools(pool: DataFrame, tried: DataFrame, most: int = MAX_ATTEMPTS) -> DataFrame:
    """(id, attempts, pool) after tries (id, ok): done rows leave, failed ones count up and are parked at the limit."""
    both = pool.select("id", "attempts").join(tried.select("id", "ok"), "id", "full_outer")
    n = F.coalesce("attempts", F.lit(0)) + F.when(F.col("ok").isNotNull(), 1).otherwise(0)
    left = both.where(~F.coalesce("ok", F.lit(False))).select("id", n.alias("attempts"))
    return left.withColumn("pool", F.when(F.col("attempts") >= most, "failed").otherwise("retry"))


def admit(queue: DataFrame, page: DataFrame, keys: list[str], room: int) -> tuple[DataFrame, bool]:
    """The queue with a page's new keys, and whether the page was taken: only if all of it fits."""
    fresh = page.join(queue, keys, "left_anti").dropDuplicates(keys)
    if queue.count() + fresh.count() > room:
        return queue, False
    return queue.unionByName(fresh), True


def ledger_migrate(state: dict) -> dict:
    """A completion ledger of version 1 (a list of done pairs) as version 2 (years by query)."""
    if state.get("version", 1) >= 2:
        return state
    done: dict[str, list] = {}
    for spec, year in state.get("done", []):
        done.setdefault(spec, []).append(year)
    return {"version": 2, "done": {k: sorted(set(v)) for k, v in sorted(done.items())}, "complete": bool(state.get("complete"))}
