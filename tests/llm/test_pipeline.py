"""The pipeline's stages against brute force on a small corpus."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

pytest.importorskip("quarry.llm")
pytest.importorskip("corpus_pipeline")
import corpus_pipeline  # noqa: E402

from tests.llm.test_jaccard import shingles  # noqa: E402
from tests.llm.test_native import slow_leaks  # noqa: E402
from tests.llm.test_simple import slow_shard, slow_stats  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline(spark, tmp_path):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(900)]
    bench = [(i, " ".join(rng.choices(vocab, k=30))) for i in range(3)]
    docs = []
    for i in range(150):
        w = rng.choices(vocab, k=rng.choice([4, 40, 120]))
        if i % 11 == 0:
            w[5:5] = bench[i % 3][1].split()
        docs.append(" ".join(w))
        if i % 5 == 0:
            w[-1] = "changed"
            docs.append(" ".join(w))
    docs += [None, "", "same same " * 40, docs[4], docs[4]]
    rows = [(i, t, rng.choice(["en", "de"]), f"src{i % 4}", len(t or "")) for i, t in enumerate(docs)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = [r for r in rows if not slow_stats(r[1])[5]]
    sets = {r[0]: shingles(r[1], 5) for r in good}
    root = {r[0]: r[0] for r in good}
    find = lambda x: x if root[x] == x else find(root[x])
    for a in sets:
        for b in sets:
            if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    first = [r for r in good if find(r[0]) == r[0]]
    leaked = {d for d, _ in slow_leaks([(r[0], r[1]) for r in first], bench)}
    clean = {r[0] for r in first} - leaked
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(sorted(r.doc_id for r in docs.collect()))
    assert seen == [sorted(r[0] for r in good), sorted(r[0] for r in first), sorted(clean)]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    chosen = {r.doc_id for r in got}
    assert len(chosen) == len(got) and chosen <= clean
    words = lambda some: sum(len(dict((r[0], r[1]) for r in rows)[d].split()) for d in some)
    assert 0.6 * words(clean) < words(chosen) <= 0.8 * words(clean)
    assert all(r.shard == slow_shard(r.doc_id, 8) for r in got)


CLASHES = ["quality", "_k", "_id", "__k", "p", "leaf", "shard", "row", "k", "hash", "id", "mix", "_mix", "own", "h", "host", "q", "salt", "w", "item_id", "copies", "domain", "bucket", "key", "n", "d1", "rep", "odd name.x"]


def test_stages_take_columns_of_any_names_and_odd_rows(spark, tmp_path):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(200)]
    bench = spark.createDataFrame([(0, " ".join(vocab[:20])), (1, None), (None, "a b c d e f")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = [" ".join(rng.choices(vocab, k=30)) for _ in range(20)]
    texts += [texts[0], " ".join(vocab[:20]) + " more words here and there", None, "", "\n", "long " * 5000]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, 1) for i, t in enumerate(texts)]
    rows += [rows[1], (None, texts[2], None, None, None), (None, None, None, None, None)]
    plain = spark.createDataFrame(rows, SCHEMA)
    extra = plain
    for i, c in enumerate(CLASHES):
        extra = extra.withColumn(c, F.lit(f"mine {i}") if i % 2 else F.lit(i))
    for name, stage in corpus_pipeline.STAGES:
        want = Counter((r.doc_id, r.text) for r in stage(spark, plain, str(tmp_path)).collect())
        got = stage(spark, extra, str(tmp_path))
        shown = got.collect()
        assert Counter((r.doc_id, r.text) for r in shown) == want, name
        assert got.columns == extra.columns, name  # the last stage puts its shard in place of the column of that name
        mine = {c: v for c, v in extra.first().asDict().items() if c in CLASHES and (c, name) != ("shard", "shards")}
        assert all(r[c] == v for r in shown for c, v in mine.items()), name
        assert stage(spark, extra.limit(0), str(tmp_path)).count() == 0, name
    assert all(isinstance(r.shard, int) and r.shard < 8 for r in shown)
