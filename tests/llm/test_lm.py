"""Counts, gradients, scores by brute force, and order against shuffled words on held-out texts."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("quarry.llm")
from quarry.llm import common as C, lm  # noqa: E402


def grammar(rng, n):
    """Words in a fixed cycle of kinds, so the neighbours tell the kind."""
    kinds = [["der", "die"], ["rote", "alte", "neue"], ["hund", "tisch", "baum"], ["sieht", "hat"]]
    start = rng.randrange(4)
    return [rng.choice(kinds[(start + i) % 4]) for i in range(n)]


def test_counts_and_vocabulary(spark):
    rows = [(1, "a b a c a"), (2, None), (3, ""), (4, "b  b\na")] * 3
    path = lm.count_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    got = {r.word: r.n for r in lm.frequent_words(spark, path).collect()}
    want = Counter(w for _, t in rows for w in (t or "").split(" ") for w in w.split("\n") if w)
    assert sorted(got.values()) == sorted(want.values())
    v = lm.learn_vocabulary(spark, path)
    assert sum(v.mass) == 0
    assert np.allclose(np.bincount(v.klass, np.exp(v.share), lm.CLASSES)[np.unique(v.klass)], 1)


def test_gradients():
    r = np.random.default_rng(0)
    net = lm.Network()
    net.p = {k: x.astype(float) for k, x in net.p.items()}
    ctx, klass = r.integers(0, lm.PAD + 1, (20, 2 * lm.WINDOW)), r.integers(0, lm.CLASSES, 20)
    g = net.gradients(ctx, klass)
    for k, at in (("e", (ctx[0, 1], 2)), ("w1", (5, 3)), ("b1", (4,)), ("w2", (1, klass[0])), ("b2", (klass[1],))):
        net.p[k][at] += 1e-4
        up = -net.log_classes(ctx, klass).mean()
        net.p[k][at] -= 2e-4
        down = -net.log_classes(ctx, klass).mean()
        net.p[k][at] += 1e-4
        assert abs((up - down) / 2e-4 - g[k][at]) < 1e-5


def test_scores_match_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(grammar(rng, rng.randint(0, 30))) for _ in range(30)] + [None, "", "x"]
    v, net = lm.learn_vocabulary(spark, lm.count_words(spark.createDataFrame([(t,) for t in texts], "text string"))), lm.Network()
    n, s = lm.score_texts(pa.array(texts), v, net, batch=7)
    h = lambda w: int(v.entries(next(C.chunks(pa.array([w]))).hashes())[0])
    for t, k, total in zip(texts, n, s, strict=True):
        ids = [h(w) for w in (t or "").split()]
        want = 0.0
        for i, x in enumerate(ids):
            around = [ids[j] if 0 <= j < len(ids) else lm.PAD for j in (i - 2, i - 1, i + 1, i + 2)]
            z = np.tanh(net.p["e"][around].ravel() @ net.p["w1"] + net.p["b1"]) @ net.p["w2"] + net.p["b2"]
            want += z[v.klass[x]] - math.log(np.exp(z.astype(float)).sum()) + v.share[x]
        assert k == len(ids) and abs(want - total) < 1e-3 * max(1, abs(want))


def test_held_out_order(spark, monkeypatch):
    monkeypatch.setattr(lm, "TOGETHER", 2)
    rng = random.Random(2)
    train = [(i, " ".join(grammar(rng, 1500))) for i in range(600)]
    model = lm.train(spark.createDataFrame(train, "doc_id long, text string").repartition(5))
    good = [grammar(rng, 60) for _ in range(40)]
    bad = [rng.sample(t, len(t)) for t in good]
    _, a = lm.score_texts(pa.array([" ".join(t) for t in good]), *model)
    _, b = lm.score_texts(pa.array([" ".join(t) for t in bad]), *model)
    assert (a > b).all() and (a - b).mean() > 20


def test_score_edges(spark):
    rows = [(1, None, 3), (2, "", 3), (None, "a b c", 3), (1, "a b c", 3)]
    got = {(r.doc_id, r.n_words): r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string, n_words long")).collect()}
    assert got[1, 0].per_word is None and got[1, 3].per_word == got[None, 3].per_word
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_probabilities_of_all_words_add_up_to_one(spark):
    """Rare words have their own share of a hashed entry: over all words of the corpus, one-word texts have a total of one."""
    n = lm.VOCABULARY + 3000
    docs = spark.range(4 * n).selectExpr("id doc_id", f"concat('w', id % {n}) text").where(f"doc_id < {n} or doc_id % {n} < {n - 1500}")
    got = {}
    for r in docs.transform(lm.score).join(docs, "doc_id").collect():
        got.setdefault(r.text, set()).add(round(r.pseudo_log_likelihood, 6))
    assert len(got) == n and all(len(x) == 1 for x in got.values())
    assert abs(sum(math.exp(min(x)) for x in got.values()) - 1) < 1e-3


def test_entries_of_a_class_depend_on_the_context():
    r = np.random.default_rng(3)
    v, net = lm.Vocabulary([(i, 10) for i in range(640)], np.zeros(lm.BUCKETS)), lm.Network()
    k = v.klass[0]
    some = np.flatnonzero(v.klass == k)[:2]
    ids = some[r.integers(0, 2, 400)]
    ctx = r.integers(0, 600, (400, 2 * lm.WINDOW))
    ctx[:, 1] = 600 + np.searchsorted(some, ids)  # the word on the left tells which
    h = net.hidden(ctx)[1]
    before = net.log_entries(h, ids, v)
    assert np.allclose(before, v.share[ids], atol=1e-5)
    [(at, du, dc)] = net.entry_gradients(h, ids, v)
    net.p = {k: x.astype(float) for k, x in net.p.items()}
    for name, g, place in (("u", du[1, 3], (at[1], 3)), ("c", dc[0], (at[0],))):
        net.p[name][place] += 1e-2
        up = -net.log_entries(h, ids, v).mean()
        net.p[name][place] -= 2e-2
        down = -net.log_entries(h, ids, v).mean()
        net.p[name][place] += 1e-2
        assert abs((up - down) / 2e-2 - g) < 1e-4
    seen = {k: np.full(s, 1e-4) for k, s in lm.SHAPES.items()}
    for _ in range(200):
        net.step_entries(net.hidden(ctx)[1], ids, v, seen)
    swapped = np.where(ids == some[0], some[1], some[0])
    assert (net.log_entries(h, ids, v) - net.log_entries(h, swapped, v)).mean() > 0.5


def test_every_word_is_a_target(spark):
    """The second word of texts of two words is learned too."""
    docs = spark.range(200_000).selectExpr("concat('k', id % 4, ' v', id % 4) text").repartition(2)
    v, net = lm.train(docs)
    entry = lambda w: int(v.entries(next(C.chunks(pa.array([w]))).hashes())[0])
    for i in range(4):
        ctx = np.array([[lm.PAD, entry(f"k{i}"), lm.PAD, lm.PAD]])
        own, other = (net.log_classes(ctx, v.klass[[entry(f"v{j}")]])[0] for j in (i, (i + 1) % 4))
        assert own > other + 1
