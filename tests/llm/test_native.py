"""Mixing against its SQL and its laws, decontamination against all windows."""

import random
import re
from collections import Counter

import duckdb
import pytest

pytest.importorskip("quarry.llm")
from quarry.llm import decontamination, mixing  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=400):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["en", "de", "fr", None]), rng.choice(["src0", "src0", "src1", "src5", "x", None]), 1) for i in range(n)]
    return [*rows, (5, "again and", "en", "src0", 1), (5, "again", "en", "src0", 1), (None, "no key", "en", "src0", 1), (n, None, "xx", "src77", 1)]


def run_sql(tmp_path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    return con.sql(mixing.ORACLE_SQL).fetchall()


@pytest.mark.parametrize("bucket_rows", [500, 7])
def test_mixing_matches_sql(spark, tmp_path, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op7_mixing(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(run_sql(tmp_path))


def test_budgets_share_shortages_among_siblings_first(spark):
    leaves = spark.createDataFrame([("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d0", "de", "c", 1000), ("d1", "en", "e", 10_000)], "domain string, lang string, source string, tokens long")
    weights = {"domain": {"d0": 1, "d1": 1}, "lang": {"en": 1, "de": 1}, "source": {}}
    got = {r.source: r.budget for r in mixing.budgets(leaves, 800, weights, 1).collect()}
    assert got == {"a": 10, "b": 190, "c": 200, "e": 400}  # a's shortage stays with b
    short = {r.source: r.budget for r in mixing.budgets(leaves, 6000, weights, 1).collect()}
    assert short == {"a": 10, "b": 1000, "c": 1000, "e": 3990}  # all of d0 short: d1 takes the rest


def test_mixing_edges(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    only_empty = spark.createDataFrame([(1, "", "en", "src0", 1), (2, None, None, None, 1)], SCHEMA).withColumn("domain", mixing.F.lit("clash")).withColumn("copies", mixing.F.lit(9))
    assert {r.copies for r in mixing.mix(only_empty).collect()} == {9}


def slow_leaks(docs, bench):
    out = {}
    words = lambda t: [w for w in re.split("[\x20\x09-\x0d]+", (t or "").lower()) if w]
    shingles = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    for d, t in docs:
        w = words(t)
        for i, b in bench:
            iw = words(b)
            own = shingles(iw)
            for s in range(max(1, len(w) - len(iw) + 1)):
                here = shingles(w[s : s + len(iw)])
                common, union = sum((own & here).values()), sum((own | here).values())
                if common and 100 * common >= 80 * union:
                    out[d, i] = max(out.get((d, i), 0), common / union)
    return out


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(300)]
    bench = [(i, " ".join(rng.choices(vocab, k=rng.randint(12, 60)))) for i in range(12)] + [(50, "one two three four"), (51, None), (52, ""), (53, "a a a a a a a a a a b"), (0, bench0 := "x1 x2 x3 x4 x5 x6 x7")]
    assert bench0
    docs = [(None, bench[3][1]), (1, None), (2, ""), (3, "one two three four"), (4, "a " * 9 + "A b"), (5, "X1 x2\nx3 x4 x5 x6 x7"), (5, "other text with key five")]
    for d in range(10, 60):
        w = rng.choices(vocab, k=rng.randint(0, 200))
        if rng.random() < 0.7:
            p = bench[rng.randrange(12)][1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                p[rng.randrange(len(p))] = rng.choice(vocab)
            if rng.random() < 0.3:
                p.insert(rng.choice([1, 2, len(p) - 2]), "new")
            at = rng.randint(0, len(w))
            w[at:at] = p
        docs.append((d, " ".join(w)))
    docs.append(docs[-1])
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", mixing.F.lit("clash"))
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.leaks(df, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = slow_leaks(docs, bench)
    assert got.keys() <= want.keys()
    # windows that no shared shingle aligns may be better by a shift, never the only ones
    assert got.keys() == want.keys()
    assert all(got[k] <= want[k] + 1e-9 for k in got)
    kept = decontamination.decontaminate(df, spark.createDataFrame(bench, "item_id long, text string"))
    assert kept.columns == df.columns and kept.count() == sum((d, t) not in {(d, t) for d, t in docs if any(x == d and slow_leaks([(d, t)], bench) for x, _ in want)} for d, t in docs)


def test_windows_between_alignments_are_found(spark):
    """Insertions of several words, edits at the edges, and swapped halves: the best window is often one that no shared shingle aligns."""
    rng = random.Random(6)
    bench = [(n, " ".join(f"i{n}w{j}" for j in range(n))) for n in (59, 60, 61, 80, 100)]
    docs = []
    for n, text in bench:
        for ends, inserted in ((1, 2), (2, 5), (0, 3), (2, 0), (3, 3)):
            p = text.split()
            p[:ends] = [f"new{j}" for j in range(ends)]
            p[n - ends :] = [f"old{j}" for j in range(ends)]
            p[n // 2 : n // 2] = [f"mid{j}" for j in range(inserted)]
            docs.append((len(docs), " ".join([*rng.choices("abcdefgh", k=rng.randint(0, 90)), *p, *rng.choices("abcdefgh", k=rng.randint(0, 90))])))
        p = text.split()
        docs.append((len(docs), " ".join(["x", *p[n // 2 :], *p[: n // 2], "y"])))
        docs.append((len(docs), " ".join(p[1 : n - 2])))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = slow_leaks(docs, bench)
    assert {k: s for k, (s, _) in got.items()} == pytest.approx(want)
    assert len(want) > 20


def test_decontamination_empty(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontamination.leaks(docs, bench).count() == 0
    assert decontamination.decontaminate(bench.withColumnRenamed("item_id", "doc_id"), bench.limit(0)).count() == 1
