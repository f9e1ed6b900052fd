"""The automaton against plain counting, and substring dedup against all windows."""

import hashlib
import random
import re
from collections import Counter

import pytest

pytest.importorskip("quarry.llm")
from quarry.llm import substrings  # noqa: E402

SCHEMA = "doc_id long, text string, n_words long"


def test_automaton():
    rng = random.Random(3)
    for trial in range(60):
        some = [([rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 14))], rng.randint(1, 2)) for _ in range(rng.randint(1, 6))]
        a = substrings.SuffixAutomaton()
        for s, w in some:
            a.add(s, w)
        a.finish()
        n = Counter()
        for s, w in some:
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    n[tuple(s[i:j])] += w
        for (s, _), path in zip(some, a.ends, strict=True):
            for j, state in enumerate(path):
                want = max((j + 1 - i for i in range(j + 1) if n[tuple(s[i : j + 1])] > 1), default=0)
                assert a.repeated[state] == want, (trial, some, s, j)
        other = [rng.randrange(3) for _ in range(20)]
        for j, got in enumerate(a.matching(other)):
            assert got == max((j + 1 - i for i in range(j + 1) if tuple(other[i : j + 1]) in n), default=0)


def slow(texts, k=35):
    docs = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    n = Counter(tuple(w[i : i + k]) for w in docs for i in range(len(w) - k + 1))
    out = []
    for w in docs:
        bad = set()
        for i in range(len(w) - k + 1):
            if n[tuple(w[i : i + k])] > 1:
                bad |= set(range(i, i + k))
        kept = [x for i, x in enumerate(w) if i not in bad]
        out.append((len(w), len(bad), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def corpus():
    rng = random.Random(8)
    vocab = [f"é{i}" for i in range(500)] + ["A", "a", "x\x1cy"]
    shared = [rng.choices(vocab, k=rng.choice([34, 35, 36, 50, 90])) for _ in range(6)]
    texts = [None, "", " \n ", "a " * 500, "b c " * 300, " ".join(["p"] * 35), " ".join(["q"] * 36)]
    for _ in range(120):
        w = rng.choices(vocab, k=rng.choice([3, 34, 35, 100, 400]))
        for _ in range(rng.choice([0, 1, 2])):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(shared)
        texts.append(rng.choice([" ", "\n", "  "]).join(w))
    texts += texts[20:26]
    near = texts[30].split()
    near[len(near) // 2 :] = ["changed"] + near[len(near) // 2 + 1 :]
    return [*texts, " ".join(near), " ".join(["n"] * 40)]


@pytest.mark.parametrize("hot", [3000, 3])
def test_remove_repeats(spark, monkeypatch, hot):
    texts = corpus()
    if hot == 3:  # the workers read the module's own value, so the shared passages must be many
        rng = random.Random(1)
        passage = " ".join(f"h{i}" for i in range(60))
        texts = [*texts, *(f"{rng.random()} {passage} {rng.random()} {i}" for i in range(3100))]
    rows = [(i, t, 5) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), digest=True).withColumnRenamed("n_words", "words").collect()}
    want = slow(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_clean_texts_and_edges(spark):
    p = " ".join(f"w{i}" for i in range(40))
    few = spark.createDataFrame([(1, " ".join("abcdefghijklmn"), 0)], SCHEMA)
    assert substrings.remove_repeats(few, digest=True).first().n_removed == 0
    rows = [(1, f"start {p} end", 0), (None, f"{p}", 0), (1, None, 0)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA), carry=["doc_id"]).collect()
    assert sorted((r.clean, r.n_removed, [tuple(s) for s in r.spans]) for r in got) == [("", 0, []), ("", 40, [(0, 40)]), ("start end", 40, [(1, 40)])]
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA), digest=True).count() == 0
