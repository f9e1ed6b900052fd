"""Token files: Parquet with list columns for selective reads, and flat files of ids scanned for separators."""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache
from itertools import repeat
from operator import methodcaller

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, Window as W

from quarry.llm import common as C

CACHE_PIECES = 450_000
#: White space by the Unicode property, in RE2's notation.
_WHITE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TAIL = ".,!?;:#%$*&\"')"
_STEM = methodcaller("rstrip", _TAIL)
ROW_GROUP_BYTES, PAGE_BYTES, BROADCAST_FILES = 24 << 20, 256 << 10, 1_000_000


def _gather(flat: np.ndarray, at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[at[p] : at[p + 1]] of all places p, one after the other, and their sizes."""
    size = at[place + 1] - at[place]
    ends = np.cumsum(size)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[place] - (ends - size), size)], size


class Encoder:
    """Whole texts to ids with the tokenizers library, for byte-level vocabularies; each distinct piece is encoded once while known.

    The pre-tokeniser cuts before a space that begins a run of white space and before one that a word follows. So a
    text in which all spaces are such is cut at its spaces, and its ids are those of its pieces, each with its space. Arrow cuts a batch of texts and
    finds its distinct pieces; only these are looked up, and the ids of all pieces are gathered from one array.
    New pieces are encoded as one text; where each one's ids end follows from the tokens' bytes. Marks
    after letters are a pre-token of their own, so "word," is " word" and ",". Other texts are encoded as they
    are. When CACHE_PIECES are known they become the older generation, from which only those come back that
    are met again.

    The strings of special tokens in a text get the special ids, the library's own setting; with as_text they
    are ordinary text.
    """

    def __init__(self, path: str, as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = as_text
        special = [] if as_text else [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.uncut = "|".join([f"{_WHITE} {_WHITE}", rf"{_WHITE} \z", *special])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(max([*vocabulary.values(), *self.tokenizer.get_vocab().values()]) + 2, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)  # a byte-level token has a character for each byte
        self.known: dict[str, int] = {}
        self.flat, self.at = np.zeros(1 << 16, "<u4"), np.zeros(1 << 16, np.int64)
        self.older: dict[str, int] = {}
        self.older_ids = self.flat, self.at
        self.tails: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def head(self, piece: str) -> bytes:
        """The ids of a piece without a space before it."""
        if piece not in self.heads:
            self.heads[piece] = self.plain(piece)
        return self.heads[piece]

    def add(self, pieces: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        """Append some pieces' ids to the array and give the pieces their places."""
        n, m = len(self.known), len(pieces)
        if not m:
            return
        ends = self.at[n] + np.cumsum(size)
        while len(self.at) <= n + m:
            self.at = np.concatenate((self.at, np.zeros_like(self.at)))
        while len(self.flat) < ends[-1]:
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.at[n] : ends[-1]] = ids
        self.at[n + 1 : n + m + 1] = ends
        self.known.update(zip(pieces, range(n, n + m), strict=True))

    def learn(self, new: list[str]) -> None:
        text = " " + " ".join(new)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        raw = np.frombuffer(text.encode(), np.uint8)
        ends = np.append(np.flatnonzero(raw == 32)[1:], len(raw))
        self.add(new, ids, np.diff(np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1, prepend=0))

    def retire(self) -> None:
        self.older, self.older_ids, self.known = self.known, (self.flat, self.at), {}
        self.flat, self.at = np.zeros(1 << 16, "<u4"), np.zeros(1 << 16, np.int64)
        self.tails.clear()
        self.heads.clear()

    def places(self, pieces: list[str]) -> np.ndarray:
        """Where the ids of each of some distinct pieces lie in the array; new ones are learnt."""
        if len(self.known) > CACHE_PIECES:
            self.retire()
        known, tails = self.known, self.tails
        at = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        lost = np.flatnonzero(at < 0)
        if not len(lost):
            return at
        missing = new = [pieces[i] for i in lost.tolist()]
        if self.older:
            then = np.fromiter(map(self.older.get, missing, repeat(-1)), np.int64, len(missing))
            met = np.flatnonzero(then >= 0)
            self.add([missing[i] for i in met.tolist()], *_gather(*self.older_ids, then[met]))
            new = [missing[i] for i in np.flatnonzero(then < 0).tolist()]
        if "" in new:
            new = [p for p in new if p]
            ids = np.frombuffer(self.plain(" "), "<u4")
            self.add([""], ids, np.array([len(ids)]))
        joined = [(p, s) for p, s in zip(new, map(_STEM, new), strict=True) if p != s and s.isalpha()]
        whole = list(set(new).difference([p for p, _ in joined]).union(s for _, s in joined if s not in known))
        for i in range(0, len(whole), 20_000):
            self.learn(whole[i : i + 20_000])
        ids = []
        for p, stem in joined:
            tail = p[len(stem) :]
            if tail not in tails:
                tails[tail] = self.plain(tail)
            place = known[stem]
            ids.append(self.flat[self.at[place] : self.at[place + 1]].tobytes() + tails[tail])
        self.add([p for p, _ in joined], np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
        at[lost] = np.fromiter(map(known.__getitem__, missing), np.int64, len(missing))
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a large_string array without nulls, one after the other, and where each one's begin (and the end)."""
        other = np.asarray(pc.match_substring_regex(texts, self.uncut).to_numpy(zero_copy_only=False), bool)
        cut = pc.split_pattern(texts.filter(pa.array(~other)), " ")
        begin = cut.offsets.to_numpy()
        begin, pieces = begin - begin[0], cut.flatten()
        coded = pieces.dictionary_encode()
        rest = np.ones(len(pieces), bool)
        rest[begin[:-1]] = False  # the first piece has no space before it
        codes = coded.indices.to_numpy()[rest]
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = self.places(distinct)[codes]
        body, size = _gather(self.flat, self.at, place)
        ends = np.cumsum(size)
        upto = np.concatenate(([0], ends))[begin - np.arange(len(begin))]  # where each regular text's body begins
        heads = iter(map(self.head, pieces.take(pa.array(begin[:-1])).to_pylist()))
        odd = iter(texts.filter(pa.array(other)).to_pylist())
        parts, i = [], 0
        for t in other.tolist():
            if t:
                parts.append([np.frombuffer(self.plain(next(odd)), "<u4")])
            else:
                parts.append([np.frombuffer(next(heads), "<u4"), body[upto[i] : upto[i + 1]]])
                i += 1
        n = np.array([sum(map(len, p)) for p in parts], np.int64)
        return np.concatenate([x for p in parts for x in p]) if parts else body, np.concatenate(([0], np.cumsum(n)))


@lru_cache(maxsize=2)
def encoder(path: str, as_text: bool = False) -> Encoder:
    return Encoder(path, as_text)


def _batches_of_texts(column: pa.Array, size: int = 3 << 20):
    """Whole texts (null as empty), about three million bytes at a time, and the first one's row."""
    texts = column.cast(pa.large_string()).fill_null("")
    at = pc.cumulative_sum(pc.binary_length(texts)).to_numpy() if len(texts) else []
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(at, (at[start - 1] if start else 0) + size, side="right")))
        yield start, texts.slice(start, end - start)
        start = end


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", files: int | None = None, as_text: bool = False) -> None:
    """Write (file, offset, key, n_tokens, tokens) in key order, a range of keys a file.

    Where the input's partitions already hold disjoint ranges of keys, they stay; else rows are dealt by range.

    Small integers are packed: Parquet v2 pages, delta encoding for keys, offsets and lengths, a dictionary for
    ids while it fits its page; zstd; bounded row groups and pages, whose column indexes allow reads of a few
    pages by key. A task writes its file under another name and renames it when whole. offset is the count of ids
    before the row in its file, so a reader of the narrow columns knows every position without the ids.

    Null and empty texts are the end id alone; null keys come first; rows with equal keys are in the order of
    their texts' hashes; an empty table gives an empty dataset. Only the key and the text are read, so other columns may have any names.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if files or not _in_ranges(docs.select(F.col(key).alias("key"))):
        rows = rows.repartitionByRange(files or max(rows.rdd.getNumPartitions(), 1), "key", F.xxhash64("text"))
    dealt = rows.sortWithinPartitions("key", F.xxhash64("text"))
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)

    def encode(batches):
        from pyspark import TaskContext

        file = _partition_id()
        store, top = pafs.FileSystem.from_uri(path)
        name, temporary = f"{top}/part-{file:06d}.parquet", f"{top}/_part-{file:06d}.{TaskContext.get().taskAttemptId()}"
        writer, held, size, done, n_rows = None, [], 0, 0, 0

        def flush():
            nonlocal writer, held, size
            table = pa.Table.from_batches(held)
            if writer is None:
                plain = {c: "DELTA_BINARY_PACKED" for c in ("file", "offset", "n_tokens")} | ({"key": "DELTA_BINARY_PACKED"} if pa.types.is_integer(table.schema.field("key").type) else {})
                writer = pq.ParquetWriter(
                    temporary, table.schema, filesystem=store, version="2.6", data_page_version="2.0", compression="zstd", use_dictionary=["tokens.list.element"], column_encoding=plain,
                    data_page_size=PAGE_BYTES, dictionary_pagesize_limit=1 << 20, write_page_index=True,
                )
            writer.write_table(table, row_group_size=len(table))
            held, size = [], 0
            del table
            C.trim()

        for b in batches:
            for start, texts in _batches_of_texts(b.column(1)):
                ids, cuts = encoder(tokenizer, as_text).encode(texts)
                n = np.diff(cuts) + 1
                ends = np.cumsum(n)
                flat = np.insert(ids, cuts[1:], end_id).view("<i4")
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat))
                held.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(n), file, np.int32)), pa.array(done + ends - n), b.column(0).slice(start, len(n)), pa.array(n), lists], ["file", "offset", "key", "n_tokens", "tokens"]))
                done, size, n_rows = done + int(ends[-1]), size + 4 * len(flat), n_rows + len(n)
                if size >= ROW_GROUP_BYTES:
                    flush()
        if held:
            flush()
        if writer is not None:
            writer.close()
            store.move(temporary, name)
        yield pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([n_rows], pa.int64())], ["file", "rows"])

    written = dealt.mapInArrow(encode, "file int, rows long").agg(F.sum("rows")).first()[0]
    if not written:  # a dataset without files has no schema that Spark could read
        kind = rows.schema["key"].dataType.simpleString()
        docs.sparkSession.createDataFrame([], f"file int, offset long, key {kind}, n_tokens long, tokens array<int>").write.mode("append").parquet(path)


def _in_ranges(keys: DataFrame) -> bool:
    """Whether no partition's keys reach into another's; from the key column alone, a row a partition."""
    parts = keys.groupBy(F.spark_partition_id()).agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count_if(F.col("key").isNull()).alias("nulls"))
    before = F.max("high").over(W.orderBy("low").rowsBetween(W.unboundedPreceding, -1))
    return not parts.withColumn("before", before).where("nulls > 0 or before >= low").limit(1).count()


def _partition_id() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, tokens): start counts the ids of all rows before, in key order.

    Only the files' totals are summed over (a row a file); every other column is read where it is used.
    """
    stored = spark.read.parquet(path)
    joined = stored.join(_hinted(_bases(stored), len(stored.inputFiles())), "file")
    return joined.select("key", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "tokens")


def _hinted(base: DataFrame, files: int) -> DataFrame:
    """base, a row a file, to be broadcast if there are not too many files."""
    return F.broadcast(base) if files <= BROADCAST_FILES else base


def _bases(stored: DataFrame) -> DataFrame:
    """(file, base): the count of ids in all files before."""
    totals = stored.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    before = W.orderBy(F.col("low").asc_nulls_first(), F.col("high").asc_nulls_first(), "file").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) read back from the files, a row group at a time: the checksum is that of
    the ids as little-endian unsigned 32-bit integers."""
    fs, root = pafs.FileSystem.from_uri(path)
    files = [f.base_name for f in fs.get_file_info(pafs.FileSelector(root)) if f.is_file and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", "."))]
    base = _bases(spark.read.parquet(path))
    kind = spark.read.parquet(path).schema["key"].dataType.simpleString()
    names = spark.createDataFrame([(f,) for f in files], "name string").repartition(max(1, min(len(files), 4096)), "name")

    def read(batches):
        store, top = pafs.FileSystem.from_uri(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_file(f"{top}/{name}") as source:
                    stored = pq.ParquetFile(source)
                    for g in range(stored.num_row_groups):
                        for part in stored.read_row_group(g, use_threads=False).to_batches():
                            lists = part.column("tokens")
                            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
                            sums = [zlib.crc32(flat[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
                            yield pa.RecordBatch.from_arrays([part.column("file"), part.column("offset"), part.column("key"), part.column("n_tokens"), pa.array(sums, pa.int64())], ["file", "offset", "key", "n_tokens", "ids_crc32"])

    found = names.mapInArrow(read, f"file int, offset long, key {kind}, n_tokens long, ids_crc32 long")
    return found.join(_hinted(base, len(files)), "file").select("key", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_files(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Token files of all documents with end id 2, read back: (doc_id, start, n_tokens, ids_crc32); see write_tokens.

    Null and empty texts have one id, the end; a null doc_id comes first, repeated rows each count, an empty table gives no rows.
    """
    import public_tokenizers

    path = C.uri(C.fresh_dir(spark, "tokens"))
    write_tokens(C.small(C.table(spark, sf_dir, "documents").select("doc_id", "text")), path, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return digests(spark, path).withColumnRenamed("key", "doc_id")


# Flat files of ids: nothing but little-endian integers, each document followed by the separator.

BLOCK_BYTES = 8 << 20
SEPARATOR = 50256


@lru_cache(maxsize=2)
def _ranks_encoder(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path) as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_flat(docs: DataFrame, path: str, tokenizer: str, separator: int = SEPARATOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write each partition's ids to a file of 16-bit integers; return (file, ordinal, key) of the documents.

    A task writes under a name of its own and renames when done, so a task that runs twice leaves one whole file.
    The files know nothing of keys; which document is the n-th of a file is in the returned rows alone.
    """
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def write(batches):
        from pyspark import TaskContext

        file, attempt = f"part-{_partition_id():06d}.ids", TaskContext.get().taskAttemptId()
        store, top = pafs.FileSystem.from_uri(path)
        done, temporary = 0, f"{top}/_{file}.{attempt}"
        with store.open_output_stream(temporary) as out:
            for b in batches:
                for start, texts in _batches_of_texts(b.column(1)):
                    for t in texts.to_pylist():
                        ids = _ranks_encoder(tokenizer).encode_ordinary(t)
                        ids.append(separator)
                        out.write(np.array(ids, "<u2").tobytes())
                    n = len(texts)
                    yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array(np.arange(done, done + n)), b.column(0).slice(start, n)], ["file", "ordinal", "key"])
                    done += n
        store.move(temporary, f"{top}/{file}")

    kind = rows.schema["key"].dataType.simpleString()
    return C.materialise(rows.mapInArrow(write, f"file string, ordinal long, key {kind}"))


def blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, item: int = 2) -> DataFrame:
    """(file, size, block, offset, length) over the flat files below path; files of no bytes have no block."""
    fs, root = pafs.FileSystem.from_uri(path)
    block_bytes -= block_bytes % item
    found = [(os.path.basename(f.path), f.size) for f in fs.get_file_info(pafs.FileSelector(root)) if f.is_file and not f.base_name.startswith(("_", "."))]
    files = spark.createDataFrame(found, "file string, size long")
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block_bytes).cast("long"))
    cut = files.where("size > 0").select("file", "size", F.posexplode(starts).alias("block", "offset"))
    return cut.withColumn("length", F.least(F.lit(block_bytes), F.col("size") - F.col("offset")))


def count_tokens(spark: SparkSession, path: str, separator: int = SEPARATOR, block_bytes: int = BLOCK_BYTES, dtype: str = "<u2") -> DataFrame:
    """(file, ordinal, start, n_tokens, ended): each document of the flat files, n_tokens without its separator.

    Blocks are read apart from each other, twice. The first reading finds how many separators a block has and
    where its last one is. A prefix scan over these (a row a block) gives every block the documents that ended
    before it and the start of the one that is open where it begins. With these, the second reading
    emits the documents that end in the block. What follows a file's last separator is a document with
    ended = false; a file that ends with a separator has none. Two separators in a row have an empty document between.
    """
    item = np.dtype(dtype).itemsize
    todo = blocks(spark, path, block_bytes, item)
    n_blocks = todo.count()
    todo = todo.repartition(max(1, min(n_blocks, 4096)), "file", "block")

    def load(file, offset, length):
        store, top = pafs.FileSystem.from_uri(path)
        with store.open_input_file(f"{top}/{file}") as f:
            f.seek(offset)
            return np.frombuffer(f.read(length), dtype)

    def summary(batches):
        for b in batches:
            for r in b.to_pylist():
                at = np.flatnonzero(load(r["file"], r["offset"], r["length"]) == separator)
                last = int(at[-1]) + r["offset"] // item if len(at) else None
                yield pa.RecordBatch.from_pylist([r | {"n_seps": len(at), "last_sep": last}], schema=out_schema)

    fields = [("file", pa.string()), ("size", pa.int64()), ("block", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
    out_schema = pa.schema([*fields, ("n_seps", pa.int64()), ("last_sep", pa.int64())])
    seen = C.materialise(todo.mapInArrow(summary, "file string, size long, block int, offset long, length long, n_seps long, last_sep long"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    known = seen.withColumns({"ordinal": F.coalesce(F.sum("n_seps").over(before), F.lit(0)), "open": F.coalesce(F.last("last_sep", True).over(before) + 1, F.lit(0))})

    def emit(batches):
        for b in batches:
            for r in b.to_pylist():
                base = r["offset"] // item
                ends = np.flatnonzero(load(r["file"], r["offset"], r["length"]) == separator) + base
                starts = np.concatenate(([r["open"]], ends + 1))
                stops, ended = ends, np.ones(len(ends), bool)
                total = r["size"] // item
                if r["offset"] + r["length"] >= r["size"] and starts[-1] < total:
                    stops, ended = np.append(ends, total), np.append(ended, False)
                n = len(stops)
                starts = starts[:n]
                yield pa.RecordBatch.from_arrays([pa.array([r["file"]] * n, pa.string()), pa.array(np.arange(n) + r["ordinal"]), pa.array(starts), pa.array(stops - starts), pa.array(ended)], ["file", "ordinal", "start", "n_tokens", "ended"])

    return known.mapInArrow(emit, "file string, ordinal long, start long, n_tokens long, ended boolean")


def op3_token_counts(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Token counts of all documents, found in flat files alone: (doc_id, file, ordinal, start, n_tokens, ended)."""
    import public_tokenizers

    path = C.uri(C.fresh_dir(spark, "flat"))
    order = write_flat(C.small(C.table(spark, sf_dir, "documents").select("doc_id", "text")), path, tokenizer or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    # a checkpoint has no size that the planner could trust, so the join is told not to broadcast
    return count_tokens(spark, path).join(order.hint("merge"), ["file", "ordinal"]).select(F.col("key").alias("doc_id"), "file", "ordinal", "start", "n_tokens", "ended")
