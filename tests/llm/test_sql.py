"""The operators against their SQL, on odd rows."""

import random
from collections import Counter

import duckdb
import pytest

pytest.importorskip("quarry.llm")
from quarry.llm import queries  # noqa: E402


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    rng = random.Random(12)
    vocab = [f"v{i}" for i in range(150)] + ["É", "Ab", "a#b", "x y", "$", "Éé"]
    bench = [(i, " ".join(rng.choices(vocab, k=rng.randint(6, 40)))) for i in range(6)] + [(9, None), (10, ""), (11, "too short")]
    texts = [None, "", " \n", "one two", "ONE  two", "a b c", "same line\nsame line\n\nsame line", "w " * 300]
    for i in range(60):
        w = rng.choices(vocab, k=rng.choice([3, 20, 60, 90]))
        if i % 6 == 0:
            w[2:2] = bench[i % 6][1].split()
        texts += [" ".join(w)] * rng.choice([1, 1, 2])
        w[-1] = "other"
        texts.append("\t".join(w))
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["s0", "s1", None]), len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    known, sql = dict(queries.QUERIES), dict(queries.ORACLES)
    try:
        import corpus_pipeline
    except ImportError:
        pass
    else:
        known["pipeline"], sql["pipeline"] = corpus_pipeline.run, corpus_pipeline.ORACLE_SQL
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    show = lambda v: round(v, 9) if isinstance(v, float) else v
    for name, text in sql.items():
        found = con.sql(text)
        columns = sorted(found.columns)
        want = Counter(tuple(show(r[found.columns.index(c)]) for c in columns) for r in found.fetchall())
        got = known[name](spark, str(tmp_path))
        assert sorted(got.columns) == columns, name
        assert Counter(tuple(show(r[c]) for c in columns) for r in got.collect()) == want, name
        assert want, name
