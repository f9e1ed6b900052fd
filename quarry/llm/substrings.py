"""Substring dedup with suffix automata of reference shards.

A word is removed if it lies in a window of WINDOW words whose sequence also starts anywhere else in the corpus.

1. Each window belongs to its minimizer, the smallest hash of the ANCHOR-word sequences in it, so equal windows
   have equal minimizers. A first scan counts the minimizers (packed by cell, one entry a chunk) and tells every
   input partition which of its own occur at least twice. Most of the corpus ends here.
2. A second scan cuts the windows of the repeated minimizers into contexts (a run of windows and the words they
   span) and routes the distinct ones to reference shards by minimizer. Each shard builds a suffix automaton of its contexts,
   with the number of places of every substring, and streams the contexts through it: where the longest suffix
   that occurs twice has WINDOW words or more, the window that ends there is repeated. A minimizer whose contexts
   are all the same words needs no automaton: they are repeated if there are two. The automata are
   not broadcast to all documents, because their size grows with the corpus; contexts come to their shard instead.
3. A third scan looks its contexts' verdicts up, joins the windows to maximal spans and removes them.

Hot minimizers (a passage in very many documents) are not sent to one shard: their windows are counted one by one
by hash, which spreads over all shards. Verdicts on a partition lie in files of the shared folder, a
folder a partition, which only that partition's task reads. A repeated scan must give the same
partitions; each task checks this and fails otherwise. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm import common as C

WINDOW, ANCHOR = 35, 12
ENTRIES_PER_CELL, CONTEXTS_PER_SHARD, RUN = 400_000, 4_000, 24
#: A minimizer with more occurrences in the corpus is hot.
HOT = 3_000
_ENTRY = [("g", "<u8"), ("n", "<u4")]


class SuffixAutomaton:
    """All substrings of the sequences added, with the number of places where each occurs."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.places = [-1], [0], [0]
        self.ends: list[list[int]] = []

    def add(self, sequence: list, weight: int = 1) -> None:
        """Add a sequence that occurs weight times."""
        following, link, length, places = self.next, self.link, self.len, self.places
        last, path = 0, []
        for c in sequence:
            q = following[last].get(c)
            if q is None:
                p, last = last, self._state(length[last] + 1, 0, {})
                while p >= 0 and c not in following[p]:
                    following[p][c] = last
                    p = link[p]
                if p >= 0:
                    q = following[p][c]
                    link[last] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            else:  # a prefix that an earlier sequence has
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            path.append(last)
            places[last] += weight
        self.ends.append(path)

    def _state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.len.append(length)
        self.link.append(link)
        self.places.append(0)
        return len(self.len) - 1

    def _split(self, p: int, c, q: int) -> int:
        """Part q into what is as long as p and c allow, and the rest."""
        copy = self._state(self.len[p] + 1, self.link[q], self.next[q].copy())
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def finish(self) -> None:
        """Sum the places up; afterwards repeated[s] is the longest suffix of state s that occurs twice."""
        order = np.argsort(np.array(self.len), kind="stable").tolist()
        for s in reversed(order[1:]):
            self.places[self.link[s]] += self.places[s]
        self.repeated = [0] * len(order)
        for s in order[1:]:
            self.repeated[s] = self.len[s] if self.places[s] > 1 else self.repeated[self.link[s]]

    def matching(self, sequence: list) -> list[int]:
        """Matching statistics: for each end, the length of the longest suffix that is in the automaton."""
        state, n, out = 0, 0, []
        for c in sequence:
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.len[state]
            if c in self.next[state]:
                state, n = self.next[state][c], n + 1
            out.append(n)
        return out


def _runs(c: C.Chunk) -> tuple:
    """(word hashes, minimizer, first and last window start) of each run of windows with one minimizer."""
    h = c.hashes()
    g, _ = C.grams(h, np.array([0, len(h)]), ANCHOR)  # across documents; windows below do not cross
    n = len(h) - WINDOW + 1
    if n <= 0:
        return h, np.zeros(0, C.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, have, need = g, 1, WINDOW - ANCHOR + 1
    while have < need:
        shift = min(have, need - have)
        low, have = np.minimum(low[: len(low) - shift], low[shift:]), have + shift
    low = low[:n]
    inside = np.repeat(c.word_at[1:], c.n_words)[:n] - np.arange(n) >= WINDOW
    doc = c.doc_of_word()[:n]
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    more = -(-size // RUN)  # periodic texts have runs without end: at most RUN windows a piece
    piece = np.arange(int(more.sum())) - np.repeat(np.concatenate(([0], np.cumsum(more)[:-1])), more)
    start = np.repeat(first, more) + piece * RUN
    stop = np.minimum(start + RUN, np.repeat(first + size, more)) - 1
    keep = inside[start]
    return h, low[start[keep]], start[keep], stop[keep]


def _window_hashes(h: np.ndarray) -> np.ndarray:
    return C.grams(h, np.array([0, len(h)]), WINDOW)[0]


def _context_hashes(w: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of each run's words, from its windows' hashes."""
    n = stop - start + 1
    if not len(n):
        return np.zeros(0, C.U64)
    at = np.concatenate(([0], np.cumsum(n)[:-1]))
    place = np.arange(int(n.sum())) - np.repeat(at, n)
    return C.mix(np.add.reduceat(C.mix(w[place + np.repeat(start, n)] + (place.astype(C.U64) + C.U64(1)) * C._GRAM), at) + n.astype(C.U64))


def _cells(key: np.ndarray, cells: int, rows: np.ndarray):
    """(cell, blob) of rows dealt by key."""
    cell = (C.mix(key + C.U64(77)) % C.U64(cells)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    cell, rows = cell[order], rows[order]
    cuts = np.append(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell)) if len(cell) else np.zeros(1, np.int64)
    return [int(cell[i]) for i in cuts[:-1]], [rows[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _told(table, keep_hot: bool):
    """For one cell: each partition's keys that occur twice or more in the corpus, and which are hot."""
    blobs, pids = table.column("blob").to_pylist(), table.column("pid").to_numpy()
    e = np.frombuffer(b"".join(blobs), _ENTRY)
    pid = np.repeat(pids, [len(b) // 12 for b in blobs])
    order = np.argsort(e["g"], kind="stable")
    g, n, pid = e["g"][order], e["n"][order].astype(np.int64), pid[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    total = np.repeat(np.add.reduceat(n, first), np.diff(np.append(first, len(g)))) if len(g) else n
    some = total > 1
    g, pid, hot = g[some], pid[some], (total[some] > HOT) & keep_hot
    order = np.lexsort((g, pid))
    g, pid, hot = g[order], pid[order], hot[order]
    new = np.r_[True, (g[1:] != g[:-1]) | (pid[1:] != pid[:-1])] if len(g) else np.zeros(0, bool)
    g, pid, hot = g[new], pid[new], hot[new]
    at = np.append(np.flatnonzero(np.r_[True, pid[1:] != pid[:-1]]), len(pid)) if len(pid) else np.zeros(1, np.int64)
    packed = np.empty(len(g), _ENTRY)
    packed["g"], packed["n"] = g, hot
    return pa.table({"pid": pa.array([int(pid[i]) for i in at[:-1]], pa.int64()), "kind": pa.array(["key"] * (len(at) - 1), pa.string()), "blob": pa.array([packed[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())})


def _keys(blobs: list[bytes]) -> np.ndarray:
    e = np.frombuffer(b"".join(blobs), _ENTRY)
    return e[np.argsort(e["g"])]


def _find(keys: np.ndarray, g: np.ndarray) -> np.ndarray:
    """The index of each g in keys, or -1."""
    if not len(keys):
        return np.full(len(g), -1)
    at = np.minimum(np.searchsorted(keys["g"], g), len(keys) - 1)
    return np.where(keys["g"][at] == g, at, -1)


def _inner_repeats(c: C.Chunk, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Whether equal windows can be in one run: its words then have equal ANCHOR-word sequences close together."""
    if not len(start):
        return np.zeros(0, np.int64)
    g, _ = C.grams(c.hashes(), np.array([0, len(c.starts)]), ANCHOR)
    near = np.zeros(len(g) + 1, np.int64)
    for d in range(1, RUN):
        near[1 : len(g) - d + 1] |= g[: len(g) - d] == g[d:]
    total = np.cumsum(near)
    return (total[stop + WINDOW - ANCHOR + 1] > total[start]).astype(np.int64)


def _distinct(rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    u, inverse, n = np.unique(rows, return_inverse=True, return_counts=True)
    if weights is not None:
        n = np.bincount(inverse, weights)
    out = np.empty(len(u), _ENTRY)
    out["g"], out["n"] = u, n
    return out


def _judge_shard(table):
    """For one shard: which windows of each context are repeated, told to the partitions that have the context."""
    anchors = table.column("g").to_numpy()
    texts, n, pids, keys = table.column("words").to_pylist(), table.column("n").to_numpy(), table.column("pid").to_numpy(), table.column("key").to_numpy()
    by: dict[tuple, list] = {}
    for i, k in enumerate(zip(anchors.tolist(), texts, strict=True)):
        by.setdefault(k, []).append(i)
    groups: dict[int, list] = {}
    for (a, words), rows in by.items():
        groups.setdefault(a, []).append((words, int(n[rows].sum()), rows))
    automaton, todo, told = SuffixAutomaton(), [], {}

    def tell(rows, mask):
        for i in rows:
            told.setdefault(int(pids[i]), {})[int(keys[i])] = mask

    for some in groups.values():
        for words, total, rows in some:
            if len(some) == 1 and total > 1:
                tell(rows, (1 << (len(words) // 8 - WINDOW + 1)) - 1)
            else:
                automaton.add(np.frombuffer(words, "<u8").tolist(), total)
                todo.append(rows)
    automaton.finish()
    for rows, path in zip(todo, automaton.ends, strict=True):
        mask = sum(1 << i for i, s in enumerate(path[WINDOW - 1 :]) if automaton.repeated[s] >= WINDOW)
        if mask:
            tell(rows, mask)
    blobs = []
    for some in told.values():
        packed = np.empty(len(some), _ENTRY)
        packed["g"], packed["n"] = np.array(list(some), np.int64).view(np.uint64), list(some.values())
        blobs.append(packed.tobytes())
    return pa.table({"pid": pa.array(list(told), pa.int64()), "kind": pa.array(["context"] * len(told), pa.string()), "blob": pa.array(blobs, pa.binary())})


def repeated_spans(texts: DataFrame):
    """Two folders of files for the partitions of texts (first column: text): their repeated minimizers, and verdicts on contexts."""
    spark = texts.sparkSession
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = max(64, math.ceil(size / 6.4 / 12.5 / ENTRIES_PER_CELL))
    shards = max(64, math.ceil(size / 6.4 / 12.5 * 0.2 / CONTEXTS_PER_SHARD))
    first, second = (C.uri(C.fresh_dir(spark, f"repeats-{i}")) for i in range(2))
    kind = "pid long, kind string, blob binary"

    def count(batches):
        pid, rows, size = C.task(), 0, 0
        for b in batches:
            rows += len(b)
            for c in C.chunks(b.column(0), limit=2 * C.CHUNK_BYTES):
                size += len(c.data)
                _, g, start, stop = _runs(c)
                e = _distinct(g, 1 + _inner_repeats(c, start, stop))
                where, blobs = _cells(e["g"], cells, e)
                yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array([pid] * len(where), pa.int64()), pa.array(blobs, pa.binary())], ["cell", "pid", "blob"])
        yield pa.RecordBatch.from_arrays([pa.array([-1 - pid], pa.int64()), pa.array([pid], pa.int64()), pa.array([C.size_blob(rows, size)], pa.binary())], ["cell", "pid", "blob"])

    def shared(key, table):
        if key[0].as_py() < 0:
            return table.select(["pid", "blob"]).add_column(1, "kind", pa.array(["size"] * len(table), pa.string()))
        return _told(table, True)

    counted = texts.mapInArrow(count, "cell long, pid long, blob binary").groupBy("cell")
    C.write_told(counted.applyInArrow(shared, kind), first)

    def contexts(batches):
        pid, known = C.task(), C.mine(first)
        keys, rows, size = _keys(known.get("key", [])), 0, 0
        for b in batches:
            rows += len(b)
            for c in C.chunks(b.column(0), limit=2 * C.CHUNK_BYTES):
                size += len(c.data)
                h, g, start, stop = _runs(c)
                at = _find(keys, g)
                mine = at >= 0
                hot = mine & (keys["n"][at] > 0) if len(keys) else mine
                w = _window_hashes(h)
                parts = []
                if hot.any():
                    n = stop[hot] - start[hot] + 1
                    place = np.arange(int(n.sum())) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
                    e = _distinct(w[place + np.repeat(start[hot], n)])
                    where, blobs = _cells(e["g"], cells, e)
                    parts.append((where, [None] * len(where), [None] * len(where), [0] * len(where), blobs))
                cold = np.flatnonzero(mine & ~hot)
                if len(cold):
                    key = _context_hashes(w, start[cold], stop[cold])
                    _, one, n = np.unique(key, return_index=True, return_counts=True)
                    cold, key = cold[one], key[one]
                    words = [h[s : e + WINDOW].tobytes() for s, e in zip(start[cold], stop[cold], strict=True)]
                    shard = (-1 - (C.mix(g[cold]) % C.U64(shards)).astype(np.int64)).tolist()
                    parts.append((shard, g[cold].view(np.int64).tolist(), key.view(np.int64).tolist(), n.tolist(), words))
                for where, anchors, key, n, blobs in parts:
                    yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array([pid] * len(where), pa.int64()), pa.array(anchors, pa.int64()), pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(blobs, pa.binary())], ["cell", "pid", "g", "key", "n", "blob"])
        C.same(known, rows, size)

    def judge(key, table):
        if key[0].as_py() >= 0:
            out = _told(table.select(["pid", "blob"]), False)
            return out.set_column(1, "kind", pa.array(["window"] * len(out), pa.string()))
        return _judge_shard(table.rename_columns(["cell", "pid", "g", "key", "n", "words"]))

    found = texts.mapInArrow(contexts, "cell long, pid long, g long, key long, n long, blob binary").groupBy("cell")
    C.write_told(found.applyInArrow(judge, kind), second)
    return first, second


def flagged_windows(c: C.Chunk, keys: np.ndarray, verdicts: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Starts of the chunk's windows that occur elsewhere."""
    h, g, start, stop = _runs(c)
    at = _find(keys, g)
    mine = np.flatnonzero(at >= 0)
    if not len(mine):
        return mine
    w = _window_hashes(h)
    hot = mine[keys["n"][at[mine]] > 0]
    n = stop[hot] - start[hot] + 1
    place = np.arange(int(n.sum())) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(n) else np.zeros(0, np.int64)
    every = place + np.repeat(start[hot], n)
    out = [every[_find(windows, w[every]) >= 0]]
    cold = mine[keys["n"][at[mine]] == 0]
    which = _find(verdicts, _context_hashes(w, start[cold], stop[cold]))
    cold, which = cold[which >= 0], which[which >= 0]
    for i in range(RUN):
        hit = (verdicts["n"][which] >> np.uint32(i)) & np.uint32(1) > 0
        out.append(start[cold][hit] + i)
    return np.concatenate(out)


def remove_repeats(docs: DataFrame, text: str = "text", carry: list[str] | None = None, digest: bool = False) -> DataFrame:
    """The columns in carry, n_words, n_removed, spans (first word and words of each maximal removed span), and
    clean (the kept words joined by single spaces) or, with digest, kept_sha256 in place of spans and clean.

    Null and empty texts have no words; equal rows remove each other's windows whole; extra columns may have
    any names. The result is written to the shared folder, since its tasks must match the scans'.
    """
    carry = ["doc_id"] if carry is None else carry
    source = docs.select(F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"))
    first, second = repeated_spans(source)  # the same columns in all scans, else Spark may deal rows otherwise

    def work(batches):
        known, told = C.mine(first), C.mine(second)
        keys, verdicts, windows = _keys(known.get("key", [])), _keys(told.get("context", [])), _keys(told.get("window", []))
        rows = size = 0
        for b in batches:
            rows += len(b)
            for c in C.chunks(b.column(0), limit=2 * C.CHUNK_BYTES):
                size += len(c.data)
                hit = flagged_windows(c, keys, verdicts, windows)
                cover = np.zeros(len(c.starts) + WINDOW + 1, np.int32)
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + WINDOW, -1)
                gone = np.cumsum(cover)[: len(c.starts)] > 0
                removed = c.per_doc(gone, c.word_at)
                data, texts, spans = c.data.tobytes(), [], []
                for i, k in enumerate(removed.tolist()):
                    words = data[c.at[i] : c.at[i + 1]].split()
                    mine = gone[c.word_at[i] : c.word_at[i + 1]]
                    if k:
                        words = [x for x, bad in zip(words, mine.tolist(), strict=True) if not bad]
                    texts.append(b" ".join(words))
                    if not digest:
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], mine.view(np.int8), [0]))))
                        spans.append([{"first": int(s), "words": int(e - s)} for s, e in zip(edge[::2], edge[1::2], strict=True)])
                own = b.column(1).slice(c.first, c.last - c.first)
                head = [own, pa.array(c.n_words), pa.array(removed)]
                if digest:
                    yield pa.RecordBatch.from_arrays([*head, pa.array([hashlib.sha256(t).hexdigest() for t in texts])], ["row", "n_words", "n_removed", "kept_sha256"])
                else:
                    kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
                    yield pa.RecordBatch.from_arrays([*head, pa.array(spans, kind), pa.array([t.decode() for t in texts], pa.string())], ["row", "n_words", "n_removed", "spans", "clean"])
        C.same(known, rows, size)

    tail = "kept_sha256 string" if digest else "spans array<struct<first:bigint,words:bigint>>, clean string"
    out = C.materialise(source.mapInArrow(work, C.schema_of(source, ["row"], f"n_words long, n_removed long, {tail}")))
    C.remove(docs.sparkSession, first, second)
    return out.select("row.*", *[c for c in out.columns if c != "row"])


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without words in repeated windows: (doc_id, n_words, n_removed, kept_sha256); see remove_repeats.

    Null and empty texts have no words; repeated rows lose all windows that they share; an empty table gives no rows.
    """
    return remove_repeats(C.small(C.table(spark, sf_dir, "documents").select("doc_id", "text")), digest=True)
