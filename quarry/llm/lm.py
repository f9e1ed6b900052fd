"""LM scoring by masked pseudo-likelihood: each word is predicted from the words on both sides of it.

The network reads WINDOW words to the left and as many to the right (embeddings, one tanh layer) and predicts words
in two levels, each a softmax over what the hidden layer says: one of CLASSES classes, then an entry of the class,
whose bias starts at the log of its share. A document's score is the sum of its words' conditional log-probabilities.

Vocabulary, shares and classes come from counts of all words of all documents. The VOCABULARY most frequent words
are entries themselves, the others share BUCKETS hashed entries, so the model has a fixed size (about 1 MB,
broadcast); a word of a hashed entry has the entry's probability times its own share of the entry's count. The
words' counts in the corpus come back to each input partition, for its own words, in files that only its task
reads. So the probabilities of all words of the corpus add up to one in every context.

Training goes over all documents in ROUNDS rounds, each document in one by the hash of its key and text, all its words
as targets: each task starts from the round's parameters; the tasks' parameters are averaged, weighted by targets, a
few at a time. Embeddings and the entries in classes are learned in larger batches, on the hidden layer as it was.
What is counted and averaged grows with the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from quarry.llm import common as C

VOCABULARY, BUCKETS, CLASSES = 4096, 1024, 64
WINDOW, DIM, HIDDEN = 2, 12, 32
ROUNDS, BATCH, RATE, SEED = 2, 1024, 0.05, 5
#: Targets a step of the embeddings, and of the entries in classes.
EMBED_BATCH, ENTRY_BATCH = 4 * BATCH, 32 * BATCH
PAD = VOCABULARY + BUCKETS
HELD_WORDS, ENTRIES_PER_CELL, TOGETHER = 1 << 20, 400_000, 64
COUNT = np.dtype([("h", "<u8"), ("n", "<u8")])
TOLD = "kind string, blob binary, pid long"
SHAPES = {"e": (PAD + 1, DIM), "w1": (2 * WINDOW * DIM, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, CLASSES), "b2": (CLASSES,), "u": (PAD, HIDDEN), "c": (PAD,)}


def _packed(cell: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[bytes]]:
    order = np.argsort(cell, kind="stable")
    cell, rows = cell[order], rows[order]
    cuts = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell))
    return [int(cell[i]) for i in cuts[:-1]], [rows[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _totals(key, table):
    """Of a cell's counts: for each partition its own words' totals, but for those of a single place; the cell's most frequent words; its sums by bucket."""
    pids, blobs = table.column("pid").to_numpy(), table.column("blob").to_pylist()
    if key[0].as_py() < 0:
        return pa.table({"pid": pids, "kind": ["size"] * len(pids), "blob": pa.array(blobs, pa.binary())})
    e = np.frombuffer(b"".join(blobs), COUNT)
    pid = np.repeat(pids, [len(b) // COUNT.itemsize for b in blobs])
    order = np.argsort(e["h"], kind="stable")
    e, pid = e[order], pid[order]
    first = np.flatnonzero(np.r_[True, e["h"][1:] != e["h"][:-1]])
    n = np.add.reduceat(e["n"], first)
    all_, top = np.empty(len(first), COUNT), np.argsort(-n.astype(np.int64), kind="stable")[:VOCABULARY]
    all_["h"], all_["n"] = e["h"][first], n
    mass = np.bincount((all_["h"] % C.U64(BUCKETS)).astype(np.int64), n, BUCKETS)
    every = np.repeat(all_, np.diff(np.append(first, len(e))))
    some = every["n"] > 1
    where, told = _packed(pid[some], every[some])
    C.trim()
    return pa.table({"pid": pa.array([*where, -1, -1], pa.int64()), "kind": ["word"] * len(where) + ["top", "mass"], "blob": pa.array([*told, all_[top].tobytes(), mass.tobytes()], pa.binary())})


def count_words(rows: DataFrame) -> str:
    """Count the words of all texts (the column text of rows); the folder that says to each partition its words' counts in the corpus.

    Partial counts go to cells by word, packed; words of a single place, the most of any corpus, are not told.
    """
    spark = rows.sparkSession
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = max(64, math.ceil(size / 6.4 * 0.15 / ENTRIES_PER_CELL))
    path = C.uri(C.fresh_dir(spark, "words"))

    def count(batches):
        pid, n_rows, size, held, n_held = C.task(), 0, 0, [], 0

        def merged():
            h, n = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            order = np.argsort(h)
            first = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]]))
            return h[order[first]], np.add.reduceat(n[order], first)

        def out(h, n):
            e = np.empty(len(h), COUNT)
            e["h"], e["n"] = h, n
            where, blobs = _packed((C.mix(h + C.U64(77)) % C.U64(cells)).astype(np.int64), e)
            return pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array([pid] * len(where), pa.int64()), pa.array(blobs, pa.binary())], ["cell", "pid", "blob"])

        for b in batches:
            n_rows += len(b)
            for c in C.chunks(b.column(b.schema.get_field_index("text"))):
                size += len(c.data)
                held.append(np.unique(c.hashes(), return_counts=True))
                n_held += len(held[-1][0])
                if n_held > HELD_WORDS:
                    held = [merged()]
                    n_held = len(held[0][0])
                    if n_held > HELD_WORDS // 2:
                        yield out(*held[0])
                        held, n_held = [], 0
        if n_held:
            yield out(*merged())
        yield pa.RecordBatch.from_arrays([pa.array([-1 - pid], pa.int64()), pa.array([pid], pa.int64()), pa.array([C.size_blob(n_rows, size)], pa.binary())], ["cell", "pid", "blob"])

    counted = rows.mapInArrow(count, "cell long, pid long, blob binary").groupBy("cell")
    C.write_told(counted.applyInArrow(_totals, "pid long, kind string, blob binary"), path)
    return path


def frequent_words(spark, path: str) -> DataFrame:
    """(word, n): the VOCABULARY most frequent words of each cell; in a small corpus, all."""

    def unpack(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                e = np.frombuffer(blob, COUNT)
                yield pa.RecordBatch.from_arrays([pa.array(e["h"].view(np.int64)), pa.array(e["n"].astype(np.int64))], ["word", "n"])

    return spark.read.schema(TOLD).parquet(path).where("pid = -1 and kind = 'top'").select("blob").mapInArrow(unpack, "word long, n long")


class Vocabulary:
    """Word hashes to entries; each entry's class and log share of its class."""

    def __init__(self, top: list[tuple[int, int]], buckets: np.ndarray):
        words = np.array([w for w, _ in top], np.int64).view(np.uint64)
        order = np.argsort(words)
        self.words, self.entry = words[order], order
        n = np.zeros(PAD)
        n[: len(top)] = [k for _, k in top]
        n[VOCABULARY:] = buckets
        n += 0.5
        by = np.argsort(-n, kind="stable")
        middle = (np.cumsum(n[by]) - n[by] / 2) / n.sum()
        self.klass = np.zeros(PAD, np.int16)  # small integers sort fast
        self.klass[by] = np.minimum((middle * CLASSES).astype(np.int16), CLASSES - 1)
        self.share = np.log(n / np.bincount(self.klass, n, CLASSES)[self.klass])
        self.mass = buckets
        # the entries of each class, and each entry's place among them
        self.members = np.argsort(self.klass, kind="stable")
        self.bounds = np.searchsorted(self.klass[self.members], np.arange(CLASSES + 1))
        self.place = np.empty(PAD, np.int64)
        self.place[self.members] = np.arange(PAD) - self.bounds[self.klass[self.members]]

    def by_class(self, ids: np.ndarray):
        """(rows of ids, the class's entries, the rows' places among them) of each class of several entries that ids have."""
        klass = self.klass[ids]
        order = np.argsort(klass, kind="stable")
        at = np.searchsorted(klass[order], np.arange(CLASSES + 1))
        for k in np.flatnonzero((np.diff(at) > 0) & (np.diff(self.bounds) > 1)):
            rows = order[at[k] : at[k + 1]]
            yield rows, self.members[self.bounds[k] : self.bounds[k + 1]], self.place[ids[rows]]

    def entries(self, h: np.ndarray) -> np.ndarray:
        out = VOCABULARY + (h % C.U64(BUCKETS)).astype(np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            out = np.where(self.words[at] == h, self.entry[at], out)
        return out


def learn_vocabulary(spark, path: str) -> Vocabulary:
    """The vocabulary of the counts below path."""
    top = [(r.word, r.n) for r in frequent_words(spark, path).orderBy(F.col("n").desc(), "word").limit(VOCABULARY).collect()]

    def add(batches):
        total = np.zeros(BUCKETS)
        for b in batches:
            for blob in b.column(0).to_pylist():
                total += np.frombuffer(blob, float)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total)], ["b", "n"])

    sums = spark.read.schema(TOLD).parquet(path).where("pid = -1 and kind = 'mass'").select("blob").mapInArrow(add, "b long, n double")
    buckets = np.zeros(BUCKETS)
    for r in sums.groupBy("b").agg(F.sum("n").alias("n")).collect():
        buckets[r.b] = r.n
    for w, n in top:
        buckets[w & (BUCKETS - 1)] -= n  # an unsigned hash modulo a power of two is its low bits
    return Vocabulary(top, buckets)


def contexts(ids: np.ndarray, word_at: np.ndarray) -> np.ndarray:
    """The entries around each word, left to right; PAD beyond the document."""
    n = np.diff(word_at)
    at = np.arange(len(ids)) + WINDOW * (1 + np.repeat(np.arange(len(n)), n))
    padded = np.full(len(ids) + WINDOW * (len(n) + 1), PAD)
    padded[at] = ids
    return np.stack([padded[at + o] for o in range(-WINDOW, WINDOW + 1) if o], 1)


def _odds(h: np.ndarray, w: np.ndarray, b: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the softmax of h w + b: exp of the logits, each row's own logit, and the row's sum of exps.

    Hidden states lie in -1 to 1, so weights bound the logits; only where exp could overflow are rows shifted.
    """
    z = h @ w
    z += b
    if (np.abs(w).sum(0) + np.abs(b)).max(initial=0) > 60:
        z -= z.max(1, keepdims=True)
    mine = z[np.arange(len(z)), own]
    np.exp(z, out=z)
    return z, mine, z @ np.ones(z.shape[1], z.dtype)


class Network:
    def __init__(self, params: dict[str, np.ndarray] | None = None):
        r = np.random.default_rng(SEED)
        self.p = params or {k: (r.standard_normal(s) / np.sqrt(s[0] if k != "e" else DIM) if len(s) > 1 and k != "u" else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}

    def hidden(self, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.p["e"].take(ctx.ravel(), 0).reshape(len(ctx), -1)
        return x, np.tanh(x @ self.p["w1"] + self.p["b1"])

    def log_classes(self, ctx: np.ndarray, klass: np.ndarray, h: np.ndarray | None = None) -> np.ndarray:
        """The log-probability of each row's class."""
        z, own, total = _odds(self.hidden(ctx)[1] if h is None else h, self.p["w2"], self.p["b2"], klass)
        return own - np.log(total)

    def log_entries(self, h: np.ndarray, ids: np.ndarray, v: Vocabulary) -> np.ndarray:
        """The log-probability of each row's entry in its class, for hidden states h."""
        out = np.zeros(len(ids))
        for rows, some, at in v.by_class(ids):
            _, own, total = _odds(h[rows], self.p["u"][some].T, self.p["c"][some] + v.share[some].astype(h.dtype), at)
            out[rows] = own - np.log(total)
        return out

    def _gradients(self, ctx: np.ndarray, klass: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """The gradients but for the embeddings', those of the words read, and the hidden layer."""
        x, h = self.hidden(ctx)
        z, _, total = _odds(h, self.p["w2"], self.p["b2"], klass)
        z /= total[:, None]
        z[np.arange(len(z)), klass] -= 1
        z /= len(z)
        dh = (z @ self.p["w2"].T) * (1 - h * h)
        return {"w1": x.T @ dh, "b1": dh.sum(0), "w2": h.T @ z, "b2": z.sum(0)}, dh @ self.p["w1"].T, h

    @staticmethod
    def _embedding_gradients(ctx: np.ndarray, dx: np.ndarray) -> np.ndarray:
        flat = ctx.ravel()
        return np.stack([np.bincount(flat, d, PAD + 1) for d in dx.reshape(-1, DIM).T.astype(float)], 1).astype(dx.dtype)

    def gradients(self, ctx: np.ndarray, klass: np.ndarray) -> dict[str, np.ndarray]:
        g, dx, _ = self._gradients(ctx, klass)
        return g | {"e": self._embedding_gradients(ctx, dx)}

    def entry_gradients(self, h: np.ndarray, ids: np.ndarray, v: Vocabulary):
        """(entries, gradient of u, gradient of c) of each class, for the mean over ids."""
        for rows, some, at in v.by_class(ids):
            near = h[rows]
            z, _, total = _odds(near, self.p["u"][some].T, self.p["c"][some] + v.share[some].astype(h.dtype), at)
            z /= total[:, None]
            z[np.arange(len(z)), at] -= 1
            z /= len(ids)
            yield some, z.T @ near, z.sum(0)

    def _move(self, k: str, at, g: np.ndarray, seen: dict[str, np.ndarray]) -> None:
        total = seen[k][at] + g * g
        seen[k][at] = total
        self.p[k][at] -= np.float32(RATE) * g / (np.sqrt(total) + np.float32(1e-6))

    def step(self, ctx: np.ndarray, klass: np.ndarray, seen: dict[str, np.ndarray]) -> np.ndarray:
        """Learn from EMBED_BATCH targets, BATCH at a time, the embeddings together; the hidden layers that they had."""
        parts = [(ctx[i : i + BATCH], klass[i : i + BATCH]) for i in range(0, len(ctx), BATCH)]
        inputs, hidden = [], []
        for near, own in parts:
            g, dx, h = self._gradients(near, own)
            for k, x in g.items():
                self._move(k, ..., x, seen)
            inputs.append(dx)
            hidden.append(h)
        some = np.flatnonzero(np.bincount(ctx.ravel(), minlength=PAD + 1))
        self._move("e", some, self._embedding_gradients(ctx, np.concatenate(inputs))[some], seen)  # the others' gradients are zero
        return np.concatenate(hidden)

    def step_entries(self, h: np.ndarray, ids: np.ndarray, v: Vocabulary, seen: dict[str, np.ndarray]) -> None:
        for some, du, dc in self.entry_gradients(h, ids, v):
            self._move("u", some, du, seen)
            self._move("c", some, dc, seen)

    def pack(self) -> bytes:
        return np.concatenate([self.p[k].ravel() for k in SHAPES]).astype("<f4").tobytes()

    @staticmethod
    def unpack(flat: np.ndarray) -> Network:
        cuts = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])
        return Network({k: x.reshape(s).astype(np.float32) for (k, s), x in zip(SHAPES.items(), np.split(flat, cuts[:-1]), strict=True)})


def train_round(docs: DataFrame, words, start: Network, turn: int, text: str = "text", key: str | None = None) -> Network:
    """Average of the networks that the tasks reach from start, weighted by their targets: the words of the texts of this round."""
    # by key and text, or else the rows of a partition take turns: either way copies are in all rounds
    nth = F.pmod(F.xxhash64(key, text), F.lit(ROUNDS)) if key else F.monotonically_increasing_id() % ROUNDS
    own = docs.select(F.col(text).alias("text"), nth.alias("turn")).where(F.col("turn") == turn).select("text")
    first = docs.sparkSession.sparkContext.broadcast(start.p)

    def fit(batches):
        net, v = Network({k: x.copy() for k, x in first.value.items()}), words.value
        seen = {k: np.full(s, 1e-4 if k in "uc" else 0.1, np.float32) for k, s in SHAPES.items()}
        targets, held = 0, []

        def drain(every: bool):
            nonlocal held, targets
            ctx, ids = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            stop = len(ctx) if every else len(ctx) - len(ctx) % ENTRY_BATCH
            klass = v.klass[ids]
            for i in range(0, stop, ENTRY_BATCH):
                end = min(i + ENTRY_BATCH, stop)
                h = [net.step(ctx[j : min(j + EMBED_BATCH, end)], klass[j : min(j + EMBED_BATCH, end)], seen) for j in range(i, end, EMBED_BATCH)]
                net.step_entries(np.concatenate(h), ids[i:end], v, seen)
            targets += stop
            held = [(ctx[stop:], ids[stop:])]

        for b in batches:
            for c in C.chunks(b.column(0)):
                ids = v.entries(c.hashes())
                held.append((contexts(ids, c.word_at), ids))
                drain(False)
        if held:
            drain(True)
        yield pa.RecordBatch.from_arrays([pa.array([C.task()], pa.int64()), pa.array([targets], pa.int64()), pa.array([net.pack()], pa.binary())], ["task", "n", "params"])

    def average(table):
        n = table.column("n").to_numpy().astype(float)
        flat = sum(np.frombuffer(p, "<f4") * k for p, k in zip(table.column("params").to_pylist(), n / max(n.sum(), 1), strict=True))
        return pa.table({"task": [table.column("task")[0].as_py() // TOGETHER], "n": [int(n.sum())], "params": pa.array([flat.astype("<f4").tobytes()], pa.binary())})

    kind = "task long, n long, params binary"
    rows = C.materialise(own.mapInArrow(fit, kind).where("n > 0"))
    last = rows.agg(F.max("task")).first()[0]
    if last is None:
        return start
    while last >= TOGETHER:
        rows = C.materialise(rows.groupBy((F.col("task") / TOGETHER).cast("long").alias("g")).applyInArrow(average, kind))
        last //= TOGETHER
    found = rows.orderBy("task").collect()
    total = sum(r.n for r in found)
    return Network.unpack(sum(np.frombuffer(r.params, "<f4") * (r.n / total) for r in found))


def shares(h: np.ndarray, ids: np.ndarray, v: Vocabulary, counts: np.ndarray) -> np.ndarray:
    """The log of each word's own share of its hashed entry; 0 for words that are entries. counts: rows COUNT by hash; others occur once."""
    out = np.zeros(len(h))
    rare = np.flatnonzero(ids >= VOCABULARY)
    n = np.ones(len(rare))
    if len(counts):
        at = np.minimum(np.searchsorted(counts["h"], h[rare]), len(counts) - 1)
        n = np.where(counts["h"][at] == h[rare], counts["n"][at], n)
    mass = np.maximum(v.mass, 1)[ids[rare] - VOCABULARY]
    out[rare] = np.log(np.minimum(n, mass) / mass)
    return out


def score_texts(texts: pa.Array, v: Vocabulary, net: Network, batch: int = 4096, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(words, summed log-probability) of each text; without counts, of the words' entries."""
    n_words, sums = [], []
    for c in C.chunks(texts):
        words = c.hashes()
        ids = v.entries(words)
        ctx, logs = contexts(ids, c.word_at), np.zeros(len(ids)) if counts is None else shares(words, ids, v, counts)
        for i in range(0, len(ids), 16 * batch):
            hidden = []
            for j in range(i, min(i + 16 * batch, len(ids)), batch):
                hidden.append(net.hidden(ctx[j : j + batch])[1])
                logs[j : j + batch] += net.log_classes(ctx[j : j + batch], v.klass[ids[j : j + batch]], hidden[-1])
            logs[i : i + 16 * batch] += net.log_entries(np.concatenate(hidden), ids[i : i + 16 * batch], v)
        total = np.concatenate(([0.0], np.cumsum(logs)))
        n_words.append(c.n_words)
        sums.append(total[c.word_at[1:]] - total[c.word_at[:-1]])
    return (np.concatenate(n_words), np.concatenate(sums)) if sums else (np.zeros(0, np.int64), np.zeros(0))


def train(docs: DataFrame, text: str = "text", path: str | None = None, key: str | None = None) -> tuple[Vocabulary, Network]:
    v, net = learn_vocabulary(docs.sparkSession, path or count_words(docs.select(F.col(text).alias("text")))), Network()
    words = docs.sparkSession.sparkContext.broadcast(v)
    for turn in range(ROUNDS):
        net = train_round(docs, words, net, turn, text, key)
    return v, net


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", model: tuple[Vocabulary, Network] | None = None) -> DataFrame:
    """(doc_id, n_words, pseudo_log_likelihood, per_word) for each row of docs; per_word is null without words.

    Null and empty texts have no words and a score of 0; repeated rows are scored alike; an empty table gives no
    rows; other columns are not read. With a model given, rare words' counts are those in docs. The result is
    written to the shared folder, since its tasks must match the scan that counts the words.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    path = count_words(rows)
    v, net = model or train(rows, "text", path, "doc_id")
    shared = spark.sparkContext.broadcast((v, net.p))

    def work(batches):
        (v, p), known = shared.value, C.mine(path)
        counts = np.frombuffer(b"".join(known.get("word", [])), COUNT)
        counts = counts[np.argsort(counts["h"])]
        n_rows = size = 0
        for b in batches:
            n_rows, size = n_rows + len(b), size + (pc.sum(pc.binary_length(b.column(1))).as_py() or 0)
            n, s = score_texts(b.column(1), v, Network(p), counts=counts)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(s)], ["doc_id", "n_words", "pseudo_log_likelihood"])
        C.same(known, n_rows, size)

    out = C.materialise(rows.mapInArrow(work, C.schema_of(rows, ["doc_id"], "n_words long, pseudo_log_likelihood double")))
    C.remove(spark, path)
    return out.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("pseudo_log_likelihood") / F.col("n_words")))


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """The scores of all documents by a network trained on all of them: (doc_id, n_words, pseudo_log_likelihood, per_word); see score.

    Null and empty texts have no words, a score of 0 and a null per_word; repeated rows score alike; an empty table gives no rows.
    """
    return score(C.small(C.table(spark, sf_dir, "documents").select("doc_id", "text")))
