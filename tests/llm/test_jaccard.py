"""The metric-space join against all pairs."""

import random
import re
from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("quarry.llm")
from quarry.llm import common, jaccard  # noqa: E402
from quarry.llm.components import components  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def slow(rows, k, percent, groups=False):
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    if groups:
        return len({find(i) for i in range(len(rows)) if sets[i]})
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0] is None, r[0] or 0), len(sets[i]), -1 if low.get(find(i)) is None else low[find(i)]) for i, r in enumerate(rows))


def corpus(seed, docs=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "Ab", "aB", "x y"]
    shared = " ".join(rng.choices(vocab, k=40))
    texts = [None, "", " \n", "one two", "ONE  two", "one", "one", "a b c d", "A B c d", "word " * 5000]
    for _ in range(docs):
        t = rng.choices(vocab, k=rng.choice([5, 30, 60, 150]))
        texts.append(" ".join(t) + (" " + shared if rng.random() < 0.4 else ""))
        for _ in range(rng.choice([0, 0, 0, 1, 2, 6])):
            t = list(t)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            texts.append(" ".join(t))
    base = rng.choices(vocab, k=120)
    for _ in range(90):  # one large group
        t = list(base)
        t[rng.randrange(120)] = rng.choice(vocab)
        texts.append(" ".join(t))
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[j], "en", "s", 1) for i, j in enumerate(order)]
    return [*rows, (3, "one two", "", "", 1), (None, "one two", "", "", 1), (None, "alone in the world", "", "", 1), rows[7], rows[7]]


@pytest.mark.parametrize("k,percent,tiny", [(4, 85, False), (5, 80, True)])
def test_components_match_all_pairs(spark, monkeypatch, k, percent, tiny):
    if tiny:  # cut regions and divide cells even here
        monkeypatch.setattr(jaccard, "MAX_REGION", 3000)
        monkeypatch.setattr(jaccard, "MAX_DOCS", 7)
        monkeypatch.setattr(jaccard, "KNOWN_SETS", 5)
        monkeypatch.setattr(jaccard, "LEAF", 4)
        monkeypatch.setattr(jaccard, "MIN_SEEN", 3)
    rows = corpus(k)
    got = jaccard.near_copies(spark.createDataFrame(rows, SCHEMA).repartition(3), k, percent).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, -1 if r.component_id is None else r.component_id) for r in got) == slow(rows, k, percent)


def test_large_regions_in_two_steps(spark):
    """A region of a dense group, a chain that leaves it, and a second group, in many blocks."""
    rng = np.random.default_rng(4)
    base, sets = rng.choice(1 << 40, 60, replace=False), []
    for i in range(60):
        x = base.copy()
        x[: i // 4] = rng.integers(1 << 41, 1 << 42, i // 4)  # farther and farther from the first
        sets += [x, np.append(x[:-1], rng.integers(1 << 42))]
    sets += [np.append(rng.permutation(base)[:40], rng.integers(1 << 43, 1 << 44, 20)) for _ in range(10)]
    rows = [(i, np.unique(x).astype("<u8").tobytes()) for i, x in enumerate(sets)]
    full = spark.createDataFrame(rows, "d1 long, members binary")
    pairs = spark.createDataFrame([(7, i, 60) for i, _ in rows], "p long, d1 long, n long")
    plain = jaccard.Sets(np.arange(len(sets)), np.concatenate([np.unique(x) for x in sets]), np.concatenate(([0], np.cumsum([len(np.unique(x)) for x in sets]))), 85)
    plain.leaf(np.arange(len(sets)), np.zeros((0, len(sets))))
    want = [plain.find(i) for i in range(len(sets))]
    assert 1 < len(set(want)) < len(sets)
    for blocks in (1, 3, 9):
        regions = spark.createDataFrame([(7, blocks, 0)], "p long, blocks int, low long")
        got = jaccard.Sets(np.arange(len(sets)), np.arange(1), np.zeros(len(sets) + 1, int), 85)
        with pytest.MonkeyPatch.context() as m:
            m.setattr(jaccard, "MAX_DOCS", max(1, len(sets) // blocks))
            for a, b in jaccard._all_links(full, pairs, regions, 85).collect():
                got.union(a, b)
        assert [got.find(i) for i in range(len(sets))] == want, blocks


def test_texts_are_not_joined_and_steps_are_deleted(spark, monkeypatch):
    """Beyond BROADCAST_ROWS no text goes through a shuffle, and what a step has read does not stay on disk."""
    rng = random.Random(6)
    rows = []
    for i in range(150):
        t = [f"v{rng.randrange(10**6)}" for _ in range(400)]
        rows += [(2 * i, " ".join(t), "en", "s", 1), (2 * i + 1, " ".join([*t, "end"]), "en", "s", 1)]
    folder, plans, keep = Path(common.shared_dir(spark).removeprefix("file:")), [], common.materialise
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "materialise", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), keep(df))[1])
    before = size()
    got = {r.doc_id: r.component_id for r in jaccard.near_copies(spark.createDataFrame(rows, SCHEMA).repartition(3), 4, 85).collect()}
    assert got == {i: i - i % 2 for i in range(300)}
    assert any("Join" in p for p in plans) and not [p for p in plans if "Join" in p and "text#" in p]
    entries = 20 * 300 * int(jaccard.window_sizes(np.array([397]), 85)[0][0])
    assert size() - before < entries  # they alone were kept to the end


def test_another_partition_is_refused(spark):
    texts = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string").coalesce(1)
    for row, said in ((0, "texts differ"), (1, "rows, not")):
        put = jaccard._placed(texts, spark.createDataFrame([(5, 0, row)], "d1 long, pid long, row long"), 4, [])
        with pytest.raises(Exception, match=said):
            put(spark.createDataFrame([(5, 7)], "d1 long, p long")).collect()


def test_keep_one(spark):
    rows = corpus(9, 60)
    want = slow(rows, 5, 80)
    kept = jaccard.keep_one(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "k")).collect()
    assert sum(bool(shingles(r.text, 5)) for r in kept) == slow(rows, 5, 80, groups=True)
    assert sum(not shingles(r.text, 5) for r in kept) == sum(not x[1] for x in want)


def test_empty(spark):
    assert jaccard.near_copies(spark.createDataFrame([], SCHEMA), 4, 85).count() == 0
    assert jaccard.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0


def test_voronoi_leaves_agree():
    rng = np.random.default_rng(0)
    base = [rng.choice(3000, 60, replace=False) for _ in range(40)]
    sets = []
    for b in base:
        for _ in range(rng.integers(1, 12)):
            x = b.copy()
            x[: rng.integers(0, 8)] = rng.integers(3000, 9000)
            sets.append(np.unique(x))
    at = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    fast, plain = (jaccard.Sets(np.arange(len(sets)), np.concatenate(sets), at, 85) for _ in range(2))
    fast.join(np.arange(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                plain.union(i, j)
    assert [fast.find(i) for i in range(len(sets))] == [plain.find(i) for i in range(len(sets))]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
