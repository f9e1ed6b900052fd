"""Shared pieces: vectorised word scanning of Arrow text columns, and durable intermediates.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text, found with numpy over chunks
of about two megabytes (a longer document is a chunk of its own, so no text is ever cut).
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quarry.functions.plan import spread

CHUNK_BYTES = 2 << 20
U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_GRAM = U64(0xD6E8FEB86659FD93)
_powers = np.ones(1, U64)


def ready(spark: SparkSession) -> None:
    """Send this package to the executors, unless the driver's folder or PYTHONPATH already gives it to them."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(root) in known or getattr(context, "_quarry_sent", False) or not (root / "quarry").is_dir():
        return
    folder = tempfile.mkdtemp(prefix="quarry-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/quarry_code.zip", "w") as z:
        for f in sorted((root / "quarry").rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(f"{folder}/quarry_code.zip")
    context._quarry_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(docs: DataFrame) -> DataFrame:
    """docs over all cores if its files are of one task's size, else as they are; rows are dealt the same way each time."""
    return spread(docs)


def row_of(docs: DataFrame) -> Column:
    """All columns of docs as one column "row", beside which other columns may have any names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def schema_of(source: DataFrame, columns: list[str], more: str) -> T.StructType:
    """The types of some columns of source, whatever their names, and those that more says."""
    return T.StructType([*(source.schema[c] for c in columns), *T.StructType.fromDDL(more).fields])


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir, or a temporary one where that is unset and Spark runs on this machine alone."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="quarry-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def uri(path: str) -> str:
    """A path as an address that both Spark and Arrow read; without a scheme it is local. file:/x becomes file:///x."""
    if path.startswith("file:"):
        return "file://" + "/" + path.removeprefix("file:").lstrip("/")
    return path if "://" in path else f"file://{path}"


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that nothing reads any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def drop(*frames: DataFrame) -> None:
    """Delete what materialise wrote for frames that nothing reads any more.

    Spark's cleaner follows the driver's collector, which may not run once in a query, so it is called: shuffles of
    plans that nobody holds go then, too.
    """
    spark = frames[0].sparkSession
    for df in frames:
        written = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if written.isDefined():
            remove(spark, written.get())
    gc.collect()
    spark._jvm.System.gc()


# What a shuffle tells a partition of the input: files in a folder for each partition, which only its task reads when
# it goes over the same rows again.


def task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def write_told(told: DataFrame, path: str) -> None:
    """Write rows (pid, ...) by pid."""
    told.repartition("pid").write.partitionBy("pid").parquet(path)


def my_rows(path: str, columns: list[str]) -> Iterator[pa.Table]:
    """What the files below path say to this task's partition, a table a file."""
    fs, top = pafs.FileSystem.from_uri(path)
    folder = f"{top}/pid={task()}"
    if fs.get_file_info(folder).type == pafs.FileType.Directory:
        for f in fs.get_file_info(pafs.FileSelector(folder)):
            if f.base_name.endswith(".parquet"):
                with fs.open_input_file(f.path) as source:
                    yield pq.read_table(source, columns=columns)


def mine(path: str) -> dict[str, list[bytes]]:
    """What the files below path say to this task's partition, by kind."""
    out: dict[str, list[bytes]] = {}
    for t in my_rows(path, ["kind", "blob"]):
        for kind, blob in zip(t.column("kind").to_pylist(), t.column("blob").to_pylist(), strict=True):
            out.setdefault(kind, []).append(blob)
    return out


def size_blob(rows: int, size: int) -> bytes:
    return np.array([rows, size], "<i8").tobytes()


def same(known: dict, rows: int, size: int) -> None:
    """Fail unless this scan of the partition had as many rows and bytes as the one that told."""
    want = [tuple(np.frombuffer(x, "<i8")) for x in known.get("size", [])]
    if want != [(rows, size)]:
        raise RuntimeError(f"a repeated scan gave another partition: {(rows, size)} for {want}")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 4096), _BASE, U64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans ascend, do not overlap and are not empty."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    within = np.arange(int(lens.sum())) - np.repeat(first, lens)
    value = data[within + np.repeat(starts, lens)].astype(U64) + U64(1)
    total = np.add.reduceat(value * powers(int(lens.max()))[within], first)
    return mix(total + lens.astype(U64) * _GRAM)


@dataclass
class Chunk:
    """Rows first to last of a batch; word_at has, for each document, the index of its first word (and the end)."""

    first: int
    last: int
    data: np.ndarray
    at: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word_at: np.ndarray

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_at)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), self.n_words)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)

    def per_doc(self, flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The sum of flags over each document, whose positions begin at at[i]."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[at[1:]] - total[at[:-1]]


def binary(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())


try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:
    _libc = None


def trim() -> None:
    """Give freed memory back, so that a worker does not hold a large batch's pages while it waits."""
    pa.default_memory_pool().release_unused()
    if _libc is not None and hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def chunks(column: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The whole texts of a column (null as empty), a few megabytes at a time, with their words' bounds."""
    column = binary(column)
    n = len(column)
    if not n:
        return
    at = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    raw = column.buffers()[2]
    every = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        j = min(j, n)
        data, offsets = every[at[i] : at[j]], at[i : j + 1] - at[i]
        if lower:
            data = _LOWER[data]
        yield scan(data, offsets, i, j)
        i = j
    trim()


def scan(data: np.ndarray, at: np.ndarray, first: int, last: int) -> Chunk:
    size = len(data)
    word = ~_SPACE[data]
    begins, stops = np.zeros(size, bool), np.zeros(size, bool)
    if size:
        begins[1:], stops[:-1] = ~word[:-1], ~word[1:]
        begins[at[:-1][at[:-1] < size]] = True
        stops[(at[1:] - 1)[at[1:] > 0]] = True
    starts = np.flatnonzero(word & begins)
    ends = np.flatnonzero(word & stops) + 1
    return Chunk(first, last, data, at, starts, ends, np.searchsorted(starts, at))


def grams(h: np.ndarray, word_at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k words that lie in one document, and the index of their first words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    g = np.zeros(n, U64)
    for j in range(k):
        g *= _GRAM
        g += h[j : j + n]
    room = np.repeat(word_at[1:], np.diff(word_at))[:n] - np.arange(n)
    keep = np.flatnonzero(room >= k)
    return mix(g[keep]), keep
