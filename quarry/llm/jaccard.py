"""Exact Jaccard join of documents' shingle sets as a metric-space join.

The metric is the Jaccard distance; two documents link at a distance of at most eps = 1 - similarity.

1. Shingles, in an order that all documents share (frequent ones last), are the first pivots. Linked sets x, y
   have |x - y| <= K(x) = |x| - ceil(s |x|), so by the triangle inequality the first L shingles that they share
   lie among the first K(x) + L of x and K(y) + L of y, for L = min(L(x), L(y)). That window of x is where x is
   replicated. A document of whose window fewer than L shingles occur in any other window has no link.
2. In each shingle's region the smallest remaining document is the pivot; a document goes to the regions of all
   pivots of its window, so linked documents share at least one. It leaves the pivots of fewest shingles out as
   long as these have at most (L - 1) / 2 of its shingles together: of the L shingles that linked documents
   share in their windows, one is then still with a pivot that both keep.
3. A region is joined recursively: documents among it are pivots of Voronoi cells, each document goes to the
   cell of the nearest and to all cells that are at most 2 eps farther, and cells are divided again until they
   are small or do not shrink. In a leaf, triangle inequality on the distances to the pivots and the ratio
   of sizes rule out most pairs; the rest are compared exactly. Documents that are already known to be in one
   component are not compared again, so a dense group of m near copies costs m steps, not m * m rows.

Equal sets are one node. Regions beyond MAX_REGION shingles or MAX_DOCS sets are cut into blocks. First each block is
joined for itself, together with the region's smallest set; what is then linked with that set needs no comparison
with each other any more. What is not is compared with all blocks of the linked ones, and among itself by pairs of
blocks. So a dense group of near copies, however large, costs about one pass, and no task holds it whole.

Texts are never shuffled, however many documents are in regions: each input partition is told, in a file that only its
task reads, which of its rows go to which blocks, and cuts them into shingles again. A repeated scan must give the same
partitions; each task checks this and fails otherwise. What a step has read is deleted before the next one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from quarry.llm import common as C
from quarry.llm.components import components

#: The share of a set that must be found in other windows before the set counts as a candidate (L of the text above).
EXTRA = 0.05
#: A shingle in more than this share of a sample of the documents (one in SAMPLE, by hash) is frequent. This only
#: sets the order and how entries are dealt out; results do not depend on it.
FREQUENT, SAMPLE, MIN_SEEN = 0.004, 8, 12
ENTRIES_PER_CELL, MAX_REGION, MAX_DOCS, LEAF, PIVOTS = 250_000, 1_000_000, 128, 48, 8
BROADCAST_ROWS = 500_000
#: Bytes of sets that a task of a later scan gives away at once.
BATCH_BYTES = 8 << 20
#: Sets that a task of the first scan remembers, so that copies in one partition add no entries twice.
KNOWN_SETS = 500_000
_TOP = np.uint64(1 << 63)


def shingle_sets(c: C.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, document after document, and where each document's begin."""
    h = c.hashes()
    g, at = C.grams(h, c.word_at, k)
    doc = c.doc_of_word()
    n = c.n_words
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):  # the whole sequence is the one shingle
        lens = n[short]
        first = np.concatenate(([0], np.cumsum(lens)[:-1]))
        pos = np.arange(int(lens.sum())) - np.repeat(first, lens)
        rolled = np.add.reduceat(C.mix(h[pos + np.repeat(c.word_at[short], lens)] + pos.astype(C.U64) * C._GRAM), first)
        g, d = np.concatenate((g, C.mix(rolled + lens.astype(C.U64)))), np.concatenate((doc[at], short))
    else:
        d = doc[at]
    g >>= C.U64(1)  # the highest bit is for frequent shingles
    order = np.lexsort((g, d))
    g, d = g[order], d[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    g, d = g[new], d[new]
    return g, np.searchsorted(d, np.arange(c.last - c.first + 1))


def _digests(g: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, whatever the order of its members."""
    out = []
    for salt in (0x51ED270B, 0x2545F491):
        total = np.concatenate((np.zeros(1, C.U64), np.cumsum(C.mix(g * C.U64(salt * 2 + 1) + C.U64(salt)), dtype=C.U64)))
        out.append(C.mix((total[at[1:]] - total[at[:-1]]) + np.diff(at).astype(C.U64)).view(np.int64))
    return out[0], out[1]


def bound(n: np.ndarray, percent: int) -> np.ndarray:
    """The fewest members that a set linked to one of n shares with it: ceil(s n)."""
    return -(-percent * n // 100)


def window_sizes(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many first shingles of a set are its window, and how many must occur elsewhere."""
    least = bound(n, percent)
    return np.minimum(n, n - least + 1 + (EXTRA * n).astype(np.int64)), 1 + (EXTRA * least).astype(np.int64)


def frequent_shingles(texts: DataFrame, k: int) -> np.ndarray:
    """The frequent shingles, sorted. There are at most (mean set size / FREQUENT) of them."""
    part = texts.where(F.pmod(F.xxhash64("k", F.lit(7)), F.lit(SAMPLE)) == 0).select("text")

    def count(batches):
        for b in batches:
            for c in C.chunks(b.column(0), lower=True, limit=4 * C.CHUNK_BYTES):
                g, n = np.unique(shingle_sets(c, k)[0], return_counts=True)
                some = n >= max(2, FREQUENT * (c.last - c.first))
                docs = np.zeros(int(some.sum()) + 1, np.int64)
                docs[-1] = c.last - c.first
                yield pa.RecordBatch.from_arrays([pa.array(np.append(g[some], C.U64(0)).view(np.int64)), pa.array(np.append(n[some], 0)), pa.array(docs)], ["g", "n", "docs"])

    seen = part.mapInArrow(count, "g long, n long, docs long")
    sums = C.materialise(seen.groupBy("g").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    total = sums.agg(F.sum("docs")).first()[0] or 0
    found = sums.where(F.col("n") >= max(MIN_SEEN, FREQUENT * total)).select("g").toPandas()["g"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def _nodes(texts: DataFrame, k: int, percent: int, frequent, cells: int) -> DataFrame:
    """A row (doc_id, k, n, d1, d2, pid, row) for each document, and rows (cell, blob) with the windows' entries.

    pid and row are the document's place: its input partition, and its number there.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()

    def work(batches):
        known: set[int] = set()
        hot, pid, done = frequent.value, C.task(), 0
        for b in batches:
            row = 0
            for c in C.chunks(b.column("text"), lower=True):
                g, at = shingle_sets(c, k)
                d1, d2 = _digests(g, at)
                size = np.diff(at)
                m = len(size)
                doc = np.repeat(np.arange(m), size)
                if len(hot):
                    where = np.minimum(np.searchsorted(hot, g), len(hot) - 1)
                    g = np.where(hot[where] == g, g | _TOP, g)
                    order = np.lexsort((g, doc))
                    g = g[order]
                window, _ = window_sizes(size, percent)
                fresh = np.zeros(m, bool)  # a set that this task has seen adds no entries
                if len(known) > KNOWN_SETS:
                    known.clear()  # what is entered twice is dropped with its shingle's cell
                for i, x in enumerate(d1.tolist()):
                    if size[i] and x not in known:
                        known.add(x)
                        fresh[i] = True
                take = (np.arange(len(g)) - at[:-1][doc] < window[doc]) & fresh[doc]
                e, owner = g[take], doc[take]
                cell = np.where(e & _TOP, C.mix(d1[owner].view(C.U64)) % C.U64(cells) + C.U64(cells), C.mix(e) % C.U64(cells)).astype(np.int64)
                order = np.argsort(cell, kind="stable")
                cell, e, owner = cell[order], e[order], owner[order]
                packed = np.empty(len(e), [("g", "<u8"), ("d", "<i8"), ("n", "<u4")])
                packed["g"], packed["d"], packed["n"] = e, d1[owner], size[owner]
                cuts = np.concatenate((np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), [len(cell)])) if len(cell) else np.zeros(1, np.int64)
                blobs = [packed[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                some = [int(cell[i]) for i in cuts[:-1]]
                q = len(blobs)
                none = lambda t, q=q: pa.nulls(q, t)
                ids, keys = b.column("doc_id").slice(row, m), b.column("k").slice(row, m)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([ids, none(ids.type)]), pa.concat_arrays([keys, none(pa.int64())]), pa.concat_arrays([pa.array(size), none(pa.int64())]), pa.concat_arrays([pa.array(d1), none(pa.int64())]), pa.concat_arrays([pa.array(d2), none(pa.int64())]), pa.concat_arrays([pa.array([pid] * m, pa.int64()), none(pa.int64())]), pa.concat_arrays([pa.array(np.arange(done, done + m)), none(pa.int64())]), pa.array([None] * m + some, pa.int64()), pa.array([None] * m + blobs, pa.binary())],
                    ["doc_id", "k", "n", "d1", "d2", "pid", "row", "cell", "blob"],
                )
                row += m
                done += m

    return texts.mapInArrow(work, f"doc_id {kind}, k long, n long, d1 long, d2 long, pid long, row long, cell long, blob binary")


def _shared_entries(cells: int):
    """Of a cell's entries, those of shingles that several sets have; of frequent shingles, all."""

    def work(key, table):
        e = np.concatenate([np.frombuffer(_bytes_of(x), [("g", "<u8"), ("d", "<i8"), ("n", "<u4")]) for x in table.column("blob").chunks])
        e = e[np.lexsort((e["d"], e["g"]))]
        g, d, n = e["g"], e["d"], e["n"]
        first = np.ones(len(g), bool)
        first[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
        g, d, n = g[first], d[first], n[first]
        if key[0].as_py() < cells:
            same = g[1:] == g[:-1]
            several = np.zeros(len(g), bool)
            several[1:] |= same
            several[:-1] |= same
            g, d, n = g[several], d[several], n[several]
        out = pa.table({"g": np.ascontiguousarray(g).view(np.int64), "d1": np.ascontiguousarray(d), "n": n.astype(np.int64)})
        del e, g, d, n, first
        C.trim()
        return out

    return work


def _bytes_of(column: pa.Array) -> memoryview:
    """The bytes of a binary column without nulls, one value after the other, in place."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    return memoryview(raw)[at[0] : at[-1]] if raw is not None else memoryview(b"")


class Sets:
    """Sets as runs of small integers, one array."""

    def __init__(self, ids: np.ndarray, flat: np.ndarray, at: np.ndarray, percent: int):
        self.ids, self.at, self.percent, self.eps = ids, at, percent, 1 - percent / 100
        _, self.flat = np.unique(flat, return_inverse=True)
        self.size = np.diff(at)
        self.mark = np.zeros(int(self.flat.max()) + 1 if len(flat) else 1, bool)
        self.parent = np.arange(len(ids))

    def shared(self, x: int, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        own = self.flat[self.at[x] : self.at[x + 1]]
        self.mark[own] = True
        n = np.add.reduceat(self.mark[flat], starts, dtype=np.int64)
        self.mark[own] = False
        return n

    def gather(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = self.size[some]
        starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
        return self.flat[np.arange(int(lens.sum())) + np.repeat(self.at[some] - starts, lens)], starts

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def union(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)

    def distances(self, x: int, some: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = self.shared(x, flat, starts)
        return 1 - n / (self.size[some] + self.size[x] - n)

    def join(self, some: np.ndarray, depth: int = 0) -> None:
        """Divide into Voronoi cells with 2 eps windows, or join exactly."""
        if len(some) <= LEAF or depth > 12:
            return self.leaf(some, np.zeros((0, len(some))))
        flat, starts = self.gather(some)
        pivots = some[(np.arange(PIVOTS) * len(some)) // PIVOTS + depth % max(1, len(some) // PIVOTS)]
        d = np.stack([self.distances(p, some, flat, starts) for p in pivots])
        inside = d <= d.min(axis=0) + 2 * self.eps + 1e-9
        if inside.sum(axis=1).max() > 0.7 * len(some):
            return self.leaf(some, d)
        for cell in inside:
            self.join(some[cell], depth + 1)

    def leaf(self, some: np.ndarray, d: np.ndarray) -> None:
        """Grow components from one document after the other; only those that are not in one yet are compared."""
        size, ratio = self.size[some], self.percent / 100
        alive = np.ones(len(some), bool)
        held = np.arange(len(some))
        flat, starts = self.gather(some)
        for seed in range(len(some)):
            if not alive[seed]:
                continue
            alive[seed] = False
            stack = [seed]
            while stack:
                x = stack.pop()
                ok = alive[held] & (size[held] >= ratio * size[x] - 1e-9) & (size[x] >= ratio * size[held] - 1e-9)
                if len(d):
                    ok &= (np.abs(d[:, held] - d[:, x : x + 1]) <= self.eps + 1e-9).all(axis=0)
                pick = np.flatnonzero(ok)
                if not len(pick):
                    continue
                if 4 * len(pick) < len(held):
                    near = held[pick]
                    n = self.shared(some[x], *self.gather(some[near]))
                else:
                    near = held[pick]
                    n = self.shared(some[x], flat, starts)[pick]
                linked = near[100 * n >= self.percent * (size[near] + size[x] - n)]
                for y in linked.tolist():
                    alive[y] = False
                    self.union(some[x], some[y])
                    stack.append(y)
            left = int(alive[held].sum())
            if left and left < 0.5 * len(held):
                held = held[alive[held]]
                flat, starts = self.gather(some[held])


def _sets_of(table, percent: int) -> tuple[Sets, np.ndarray]:
    """A group's sets, each once, the smallest id first, and the rows of the table that they come from."""
    ids = table.column("d1").to_numpy()
    order = np.argsort(ids, kind="stable")
    order = order[np.r_[True, ids[order][1:] != ids[order][:-1]]]
    members = table.column("members").combine_chunks().take(pa.array(order))
    flat = np.frombuffer(_bytes_of(members), "<u8")
    size = pc.binary_length(members).to_numpy().astype(np.int64) // 8
    return Sets(ids[order], flat, np.concatenate(([0], np.cumsum(size))), percent), order


def _links(s: Sets, p) -> pa.Table:
    """(p, a, b): each set that is linked with a smaller one, and the smallest of its component."""
    roots = np.array([s.find(i) for i in range(len(s.ids))], np.int64)
    linked = np.flatnonzero(roots != np.arange(len(s.ids)))
    return pa.table({"p": pa.array([p] * len(linked), pa.int64()), "a": s.ids[linked], "b": s.ids[roots[linked]]})


def _region_links(percent: int):
    def work(key, table):
        s, _ = _sets_of(table, percent)
        s.join(np.arange(len(s.ids)))
        return _links(s, key[0].as_py())

    return work


def _late_links(percent: int):
    """Of a block of sets that are known to be linked with each other, and sets that may be linked with them; or of the latter alone."""

    def work(key, table):
        s, rows = _sets_of(table, percent)
        far = np.asarray(table.column("far").to_numpy(zero_copy_only=False), bool)[rows]
        if far.all():
            s.join(np.arange(len(s.ids)))
            return _links(s, key[0].as_py())
        near = np.flatnonzero(~far)
        flat, starts = s.gather(near)
        for x in near[1:].tolist():
            s.union(near[0], x)
        for x in np.flatnonzero(far).tolist():
            n = s.shared(x, flat, starts)
            if (100 * n >= s.percent * (s.size[near] + s.size[x] - n)).any():
                s.union(near[0], x)
        return _links(s, key[0].as_py())

    return work


def _regions(pairs: DataFrame) -> DataFrame:
    """(p, c, m, blocks): each region's count of sets, its smallest set, and how many blocks it is cut into."""
    blocks = F.ceil(F.greatest(F.sum("n") / MAX_REGION, F.count(F.lit(1)) / MAX_DOCS)).cast("int")
    return pairs.groupBy("p").agg(F.count(F.lit(1)).alias("c"), F.min("d1").alias("m"), blocks.alias("blocks"))


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("d1"), F.col(blocks)).cast("int")


def _every(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def _small(df: DataFrame) -> DataFrame:
    """df, written once; to be broadcast if it has few rows of numbers. Sets then travel to their regions alone."""
    df = C.materialise(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _placed(texts: DataFrame, places: DataFrame, k: int, files: list[str]):
    """A function that adds members to rows (d1, ...). places: (d1, pid, row); files: gets the folders that are written for it.

    Only numbers are joined; the texts are cut into shingles by the tasks that read them.
    """

    def put(rows: DataFrame) -> DataFrame:
        path, names = C.uri(C.fresh_dir(rows.sparkSession, "places")), rows.columns
        C.write_told(C.materialise(rows).join(places, "d1").select("pid", "row", *names), path)
        files.append(path)

        def work(batches):
            told = list(C.my_rows(path, ["row", *names]))
            told = pa.concat_tables(told).sort_by("row").combine_chunks() if told else None
            at = told.column("row").to_numpy() if told else np.zeros(0, np.int64)
            done = 0
            for b in batches:
                low, high = np.searchsorted(at, [done, done + len(b)])
                some, first = np.unique(at[low:high], return_index=True)
                first = low + np.append(first, high - low)
                for c in C.chunks(b.column("text").take(pa.array(some - done)), lower=True):
                    g, cut = shingle_sets(c, k)
                    begin, end = first[c.first], first[c.last]
                    owner = np.repeat(np.arange(c.last - c.first), np.diff(first[c.first : c.last + 1]))
                    if not np.array_equal(_digests(g, cut)[0][owner], told.column("d1").slice(begin, end - begin).to_numpy()):
                        raise RuntimeError("a repeated scan gave another partition: its texts differ")
                    sets = [g[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
                    part = np.cumsum(8 * np.diff(cut)[owner]) // BATCH_BYTES
                    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(owner)]
                    for i, j in zip(edges[:-1], edges[1:], strict=True):
                        own = told.slice(begin + i, j - i).select(names).combine_chunks().to_batches()[0]
                        yield pa.RecordBatch.from_arrays([*own.columns, pa.array([sets[x] for x in owner[i:j].tolist()], pa.binary())], [*names, "members"])
                done += len(b)
            if len(at) and at[-1] >= done:
                raise RuntimeError(f"a repeated scan gave another partition: {done} rows, not {at[-1] + 1} or more")

        return texts.mapInArrow(work, ", ".join(f"{c} {kind}" for c, kind in rows.dtypes) + ", members binary")

    return put


def _all_links(full, pairs: DataFrame, regions: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what is connected in any region. pairs: (p, d1, n); regions: (p, blocks, low).

    full: a function that adds members to rows (d1, ...), or (d1, members).
    """
    put = full if callable(full) else lambda rows: full.join(_small(rows), "d1")
    dealt = pairs.join(regions, "p")
    first = F.col("d1") == F.col("low")
    own = dealt.where(~first | (F.col("blocks") == 1)).withColumn("i", _block("blocks"))
    own = own.unionByName(dealt.where(first & (F.col("blocks") > 1)).withColumn("i", _every("blocks")))
    kind = "p long, a long, b long"
    links = C.materialise(put(own.select("p", "d1", "i")).groupBy("p", "i").applyInArrow(_region_links(percent), kind))
    large = regions.where("blocks > 1")
    if not large.limit(1).count():
        return links.select("a", "b")
    near = links.join(large.select("p", "low"), "p").where("b = low").select("p", F.col("a").alias("d1")).distinct().withColumn("near", F.lit(True))
    marked = dealt.where("blocks > 1").join(C.materialise(near), ["p", "d1"], "left").select("p", "d1", "n", (~F.coalesce("near", first)).alias("far"))
    marked = C.materialise(marked)
    left = _regions(marked.where("far")).select("p", F.col("blocks").alias("far_blocks"))
    parts = C.materialise(left.join(_regions(marked.where("not far")).select("p", "blocks"), "p"))
    marked = marked.join(parts, "p")  # regions without any set left over are done
    block, zero = _block("blocks"), F.lit(0)
    late = marked.where("not far").select("p", "d1", "far", zero.alias("late"), block.alias("i"), zero.alias("j"))
    late = late.unionByName(marked.where("far").select("p", "d1", "far", zero.alias("late"), _every("blocks").alias("i"), zero.alias("j")))
    among = marked.where("far").withColumn("x", _block("far_blocks")).withColumn("y", _every("far_blocks"))
    late = late.unionByName(among.select("p", "d1", "far", F.lit(1).alias("late"), F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")))
    more = put(late).groupBy("p", "late", "i", "j").applyInArrow(_late_links(percent), kind)
    return links.select("a", "b").union(more.select("a", "b"))


def _text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def near_copies(docs: DataFrame, shingle: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, k, n_shingles, d1, component_id, rep) for each row of docs.

    component_id is the smallest doc_id that links lead to (a null doc_id counts as larger than any other), rep
    the (doc_id, k) of the row that stands for the component; k is a hash of the text. Texts without words
    have no shingles, link with nothing and stand for themselves. Equal rows are two rows with one answer. docs is
    scanned several times and must give the same partitions each time.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("k", _text_key())
    frequent = spark.sparkContext.broadcast(frequent_shingles(texts, shingle))
    rows = texts.select(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    cells = max(64, math.ceil((rows[1] or 0) / 6.5 * 0.21 / ENTRIES_PER_CELL))
    scanned = C.materialise(_nodes(texts, shingle, percent, frequent, cells))
    nodes = C.materialise(scanned.where("cell is null").drop("cell", "blob"))
    shared = scanned.where("cell is not null").select("cell", "blob").groupBy("cell").applyInArrow(_shared_entries(cells), "g long, d1 long, n long")
    shared = C.materialise(shared)
    C.drop(scanned)
    # sets whose window occurs elsewhere often enough
    need = F.lit(1) + F.floor(F.lit(EXTRA) * F.ceil(F.col("n") * percent / 100))
    likely = shared.groupBy("d1").agg(F.count(F.lit(1)).alias("seen"), F.first("n").alias("n")).where(F.col("seen") >= need).select("d1")
    alive = C.materialise(shared.join(likely, "d1"))
    C.drop(shared)
    # what is joined to a table is written first: the join then has shuffles of its own, whose hot keys Spark can split
    pivots = C.materialise(alive.groupBy("g").agg(F.min("d1").alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1").select("g", "p"))
    held = alive.join(pivots, "g").groupBy("p", "d1").agg(F.count(F.lit(1)).alias("w"), F.first("n").alias("n"))
    light = F.sum("w").over(W.partitionBy("d1").orderBy("w", "p"))
    pairs = C.materialise(held.withColumn("upto", light).where(2 * F.col("upto") > need - 1).select("p", "d1", "n"))
    regions = C.materialise(_regions(pairs).where("c > 1").select("p", "blocks", F.col("m").alias("low")))
    C.drop(alive, pivots)
    # the sets of the documents in regions, from their texts
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k", "pid", "row")
    sets = nodes.where("n > 0").groupBy("d1", "d2").agg(F.min(order).alias("rep"), F.max("n").alias("n"))
    sets = sets.select("d1", "d2", F.struct("rep.none", "rep.doc_id", "rep.k").alias("rep"), F.struct("rep.pid", "rep.row").alias("place"))
    files: list[str] = []
    places = _small(pairs.select("d1").distinct().join(sets, "d1").select("d1", "place.pid", "place.row"))
    links = C.materialise(_all_links(_placed(texts, places, shingle, files), pairs, regions, percent))
    C.remove(spark, *files)
    roots = components(links)
    named = sets.join(roots.withColumnRenamed("node", "d1"), "d1", "left").withColumn("root", F.coalesce("root", "d1"))
    best = C.materialise(named.select("d1", "d2", "root", "rep"))
    heads = C.materialise(best.groupBy("root").agg(F.min("rep").alias("head")))  # written, so that the join can split a large component
    answer = best.join(heads, "root").select("d1", "d2", "head")
    empty = nodes.where("n = 0").select("doc_id", "k", F.col("n").alias("n_shingles"), "d1", F.col("doc_id").alias("component_id"), F.struct("doc_id", "k").alias("rep"))
    full_rows = nodes.where("n > 0").join(answer, ["d1", "d2"]).select("doc_id", "k", F.col("n").alias("n_shingles"), "d1", F.col("head.doc_id").alias("component_id"), F.struct("head.doc_id", "head.k").alias("rep"))
    return full_rows.unionByName(empty)


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stand for their components (with the smallest doc_id), with their own columns.

    Rows that equal each other in doc_id and text count as copies: one of them stays. Null and empty texts and
    texts without words stay, all of them; a null doc_id is larger than any other. Of rows linked with each other the one with
    the smallest doc_id stays, on a tie that of the smaller hash of its text. Other columns may have any names; an
    empty table gives no rows.
    """
    found = C.materialise(near_copies(docs, shingle, percent))
    gone = found.where(~(F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("k") == F.col("rep.k")))).select(F.col("doc_id").alias("id"), F.col("k").alias("hash")).distinct()
    gone = C.materialise(gone)
    side = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    keyed = docs.select(C.row_of(docs), F.col("doc_id"), _text_key().alias("k"))
    kept = keyed.join(side, (F.col("k") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_anti")
    if found.where("n_shingles > 0").groupBy("doc_id", "k").count().where("count > 1").limit(1).count():
        wordless = ~F.coalesce(F.col("row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        kept = kept.where(wordless).unionByName(kept.where(~wordless).dropDuplicates(["doc_id", "k"]))
    return kept.select("row.*")


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Words in lower case (A-Z), 4-word shingles, links at 85 percent: (doc_id, n_shingles, component_id); see near_copies.

    Null and empty texts have no shingles and link with nothing; repeated rows each get the same answer; an empty table gives no rows.
    """
    return near_copies(C.small(C.table(spark, sf_dir, "documents").select("doc_id", "text")), 4, 85).select("doc_id", "n_shingles", "component_id")
