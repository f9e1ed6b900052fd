"""Brute-force versions, odd rows and the laws of the quality, sharding and token-file operators."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("quarry.llm")
from quarry.llm import common as C, quality, sharding, tokens  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality string, row string"


def odd_rows():
    rng = random.Random(3)
    words = ["ab", "cd", "é#", "x\x1cy", "z q", "$", "ÀB", "Ab"]
    texts = [None, "", " \n ", "one", "a\nb\na\n\na", "a a a a a a a a a a a", "\n\nx\n\nx\r\n y", "long " * 30_000]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 60))).replace("cd ", "cd\n") for _ in range(60)]
    texts += texts[8:12]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, 1, "q", "r") for i, t in enumerate(texts)]
    return [*rows, (5, "again", "en", "s1", 1, None, None), (None, "no key", None, None, None, None, None)]


def slow_stats(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    rep = set()
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            rep |= set(range(i, i + 5))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(rep), len(w) < 10 or 100 * len(rep) > 20 * len(w)


def test_quality_matches_brute_force(spark):
    rows = odd_rows()
    got = {(r.doc_id, r.text): r for r in quality.annotate(spark.createDataFrame(rows, SCHEMA).drop("quality")).collect()}
    for r in rows:
        q = got[r[0], r[1]].quality
        assert tuple(q)[:6] == slow_stats(r[1]), r[1]
        assert q.kept == (not q.base_failed and not q.host_rejected)
    assert quality.annotate(spark.createDataFrame([], SCHEMA).drop("quality")).count() == 0


def test_hosts_shrink(spark):
    tallies = spark.createDataFrame([("big_bad", 1000, 990), ("tiny_bad", 1, 1), ("good", 1000, 20), ("good2", 500, 30)], "host string, docs long, failed long")
    got = {r.host: r for r in quality.host_verdicts(tallies).collect()}
    assert got["big_bad"].rejected and not got["tiny_bad"].rejected and not got["good"].rejected
    assert got["tiny_bad"].expected < 1


def slow_shard(key, n):
    best = max(((1.0 / -math.log((int(hashlib.md5(f"{key}#{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52)), -i) for i in range(n))
    return -best[1]


def test_sharding_law(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.op6_sharding(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        key = "null" if r.doc_id is None else r.doc_id
        assert r.shard == slow_shard(key, 8) and r.grown_shard == slow_shard(key, 9)
        assert r.grown_shard in (r.shard, 8)
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)


def test_weights_and_growth_move_few(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = Counter(r.shard for r in sharding.assign(df, [1.0, 3.0, 0.0]).collect())
    assert n[2] == 0 and 2.7 < n[1] / n[0] < 3.3


def test_token_files_round_trip(spark, tmp_path):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [r for r in odd_rows() if r[0] is not None] + [(1000, "a  b\n\n c\t\td \n e <|endoftext|>  ", "", "", 1, "", "")]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tokens.op1_token_files(spark, str(tmp_path)).collect(), key=lambda r: (r.start))
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    want = Counter()
    for r in rows:
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        want[r[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    total = 0
    for r in got:
        assert r.start == total
        total += r.n_tokens
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert tokens.op1_token_files(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("as_text", [False, True])
def test_pieces_have_the_ids_of_whole_texts(as_text, monkeypatch):
    import pyarrow as pa

    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "CACHE_PIECES", 40)  # generations change all the time
    path, rng = P.path("byte_bpe_50k.json"), random.Random(9)
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = as_text
    pieces = ["word", "word,", "'s", "it's", "\t", "\n", "x\ny", "é", "日本", "<|endoftext|>", "a<|endoftext|>b", "don't!", ",", ")(", "12", "ﬀ,", "\u00a0", "q" * 40, "", "W"]
    texts = ["", " ", "  ", " a", "a ", "word,", "word \u00a0 \u00a0", "a \t \n", "a  b", "a   b", "a\n ", "a \u2003 b", *(rng.choice([" ", " ", " ", "  "]).join(rng.choices(pieces, k=rng.randint(1, 30))) for _ in range(400))]
    texts += ["".join(rng.choices("ab ,\n", k=20)) for _ in range(200)]
    e = tokens.Encoder(path, as_text)
    for i in range(0, len(texts), 50):
        ids, at = e.encode(pa.array(texts[i : i + 50], pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts[i : i + 50]]
    ids, at = e.encode(pa.array([], pa.large_string()))
    assert len(ids) == 0 and at.tolist() == [0]


def test_encoded_pages_have_indexes_and_encodings(spark, tmp_path):
    import pyarrow.parquet as pq

    P = pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([(i, "some words here " * 20) for i in range(500)], "doc_id long, text string")
    tokens.write_tokens(df, f"file://{tmp_path}/t", P.path("byte_bpe_50k.json"), 2, files=1)
    (file,) = (tmp_path / "t").glob("*.parquet")
    meta = pq.read_metadata(file).row_group(0)
    by = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert any("DICTIONARY" in e for e in by["tokens.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in by["key"].encodings and by["key"].has_column_index
    picked = tokens.read_tokens(spark, f"file://{tmp_path}/t").where("key = 7").select("start", "n_tokens").first()
    assert picked.start == 7 * picked.n_tokens


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
def test_separator_scan(spark, tmp_path, block_bytes):
    rng = np.random.default_rng(1)
    want = []
    for name, tail in (("a.ids", True), ("b.ids", False), ("c.ids", False), ("empty.ids", None)):
        ids = rng.integers(0, 5, 300).astype("<u2") if tail is not None else np.zeros(0, "<u2")
        if name == "c.ids":
            ids[:] = 3
        if len(ids):
            ids[-1] = 4 if tail else 0
        ids.tofile(tmp_path / name)
        start, n = 0, 0
        for i, x in enumerate(ids):
            if x == 4:
                want.append((name, n, start, i - start, True))
                start, n = i + 1, n + 1
        if start < len(ids):
            want.append((name, n, start, len(ids) - start, False))
    got = tokens.count_tokens(spark, f"file://{tmp_path}", 4, block_bytes)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_flat_files_know_every_document(spark, tmp_path):
    P = pytest.importorskip("public_tokenizers")
    rows = odd_rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = tokens.op3_token_counts(spark, str(tmp_path)).collect()
    e = tokens._ranks_encoder(P.path("byte_bpe_multi_50k.tiktoken"))
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((r[0], len(e.encode_ordinary(r[1] or ""))) for r in rows)


def test_chunks_are_whole():
    import pyarrow as pa

    texts = ["a b", None, "", "c" * 50 + " d", " ", "e"]
    for limit in (1, 10, 1000):
        seen = []
        for c in C.chunks(pa.array(texts), limit=limit):
            for i in range(c.last - c.first):
                k = slice(c.word_at[i], c.word_at[i + 1])
                seen.append([c.data[s:e].tobytes().decode() for s, e in zip(c.starts[k], c.ends[k], strict=True)])
        assert seen == [(t or "").split() for t in texts]
