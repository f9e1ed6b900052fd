"""Readings, census pages, paper links, archive pairs and bundles, with fake services."""

import base64
import json
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from quarry import cli
from quarry.functions import patterns as P
from quarry.operators import archives, census, pages, papers, readings
from quarry.plans import catalog
from quarry.sources import jsonl, paged
from quarry.streaming import bundles, ledger
from tests.test_sources import row, write

TEXT = b"We propose a transformer in a paper, with code."
ASKED = []


def body(text=TEXT, **more):
    return json.dumps({"type": "file", "size": len(text), "encoding": "base64", "sha": "abc", "content": base64.b64encode(text).decode()[:20] + "\n" + base64.b64encode(text).decode()[20:]} | more)


def make_reader():
    def get(name, etag):
        n = int(name.rsplit("r", 1)[1])
        if etag == "e1":
            return 304, None, None
        return {1: (200, "e1", body()), 2: (404, None, None), 3: (500, None, None), 4: (200, "e4", body(size=3)), 5: (429, None, None)}.get(n, (200, "e1", body()))

    return get


def test_readings(spark):
    now = F.lit("2026-01-10 00:00:00").cast("timestamp")
    empty = spark.createDataFrame([], f"github_id long, {readings.STATE}")
    queue = spark.createDataFrame([(i, f"o/r{i}", 0, i) for i in range(1, 8)], "github_id long, name string, queue_tier int, position int")
    todo = readings.to_read(queue, empty, now)
    done = readings.records(todo, readings.ask(todo, "tests.test_flows:make_reader"), empty, now)
    got = {r.github_id: r for r in done.collect()}
    assert sorted(got) == [1, 2, 3, 4]  # after the limit nothing is asked
    assert [got[i].outcome for i in (1, 2, 3, 4)] == ["ok", "missing", "error", "error"]
    assert "paper-code-relationship" in got[1].record.readme_signals and got[1].record.readme_etag == "e1"
    assert got[2].record.readme_signals == [] and got[3].record is None and got[4].state.due_at.startswith("2026-01-11")
    prior = readings.next_states(empty, done)
    soon, later = F.lit("2026-01-10 12:00:00").cast("timestamp"), F.lit("2027-01-11 00:00:00").cast("timestamp")
    assert sorted(r.github_id for r in readings.to_read(queue, prior, soon).collect()) == [5, 6, 7]
    renamed = queue.withColumn("name", F.concat("name", F.lit("x1")))
    assert {r.sent_etag for r in readings.to_read(renamed, prior, soon).collect()} == {None}
    again = readings.to_read(queue, prior, later).where("github_id < 3")
    assert {r.github_id: r.sent_etag for r in again.collect()} == {1: "e1", 2: None}
    kept = {r.github_id: r for r in readings.records(again, readings.ask(again, "tests.test_flows:make_reader"), prior, later).collect()}
    assert kept[1].outcome == "unchanged" and kept[1].record.readme_signals == got[1].record.readme_signals and kept[1].record.readme_blob_sha == "abc"
    side = spark.createDataFrame([(1, "o/r1", P.README_VERSION, ["a"], None), (2, "o/r2", P.README_VERSION, ["a"], 404), (3, "other", P.README_VERSION, ["a"], None)], "github_id long, repository_name_at_fetch string, readme_evidence_version string, readme_signals array<string>, last_status int")
    assert {r.github_id: r.earlier_signals for r in readings.earlier_signals(queue.where("github_id < 4"), side).collect()} == {1: ["a"], 2: None, 3: None}


def test_answers_that_break_a_rule(spark):
    bad = [body(type="dir"), body(size=-1), body(size=True), body(encoding="utf-8"), body(sha=""), body(sha="x" * 129), body(content="!!!!"), "[]", "no json", None, body(b"\xff\xfe"), body(size=readings.MAX_BYTES + 1)]
    rows = [(i, 200, None, b) for i, b in enumerate([body(), *bad])]
    got = {r.github_id: r for r in readings.checked(spark.createDataFrame(rows, readings.ANSWER)).collect()}
    assert got[0].outcome == "ok" and got[0].text == TEXT.decode()
    assert {r.outcome for i, r in got.items() if i} == {"error"}


def census_nodes():
    return lambda keys: [None if k == "n3" else RuntimeError("later") if k == "n4" else {"nameWithOwner": f"o/{k}", "url": "u", "description": "deep learning" if k == "n1" else "a cooking blog", "topics": [], "stargazerCount": 1, "isArchived": False, "isFork": False} for k in keys]


def census_nodes_later():
    return lambda keys: [{"nameWithOwner": f"o/{k}", "url": "u", "description": "deep learning", "topics": [], "stargazerCount": 1, "isArchived": False, "isFork": False} if k == "n3" else None for k in keys]


class Pages:
    def __init__(self, options):
        pass

    def page(self, since):
        items = [{"id": i, "node_id": f"n{i}", "full_name": f"o/n{i}", "name": f"n{i}", "description": None} for i in range(since + 1, min(since + 4, 8))]
        return items, None


def test_census_command(spark, tmp_path):
    out = str(tmp_path / "o")
    args = ["census", "--client", "tests.test_flows:Pages", "--state", str(tmp_path / "s.json"), "--output", out, "--max-requests", "2"]
    assert cli.main([*args, "--nodes", "tests.test_flows:census_nodes"]) == 0
    assert [r.github_id for r in spark.read.parquet(f"{out}/pages/run=0").collect()] == [1]
    cover = {r.since: r for r in spark.read.parquet(f"{out}/coverage/run=0").collect()}
    assert cover[0].retry_ids == [3] and cover[0].resolved_ids == [1, 2] and cover[3].retry_ids == [4]
    assert (cover[0].candidate_count, cover[0].unknown_count, cover[0].not_candidate_count) == (1, 1, 1)
    assert cli.main([*args, "--nodes", "tests.test_flows:census_nodes_later"]) == 0
    assert [r.github_id for r in spark.read.parquet(f"{out}/pages/run=1").collect()] == [3]
    left = {r.github_id: r.attempts for r in spark.read.parquet(f"{out}/retry/run=1").collect()}
    assert left == {4: 2, 7: 1}
    late = spark.read.parquet(f"{out}/rows/run=1").where("late and enrichment_status = 'enriched'").select("since", "github_id", "candidate_status")
    after = {r.since: r for r in census.late_coverage(spark.read.parquet(f"{out}/coverage/run=0"), late.union(late), spark.createDataFrame([(3, 4)], "since long, github_id long")).collect()}
    assert (after[0].candidate_count, after[0].unknown_count, after[0].enriched, after[0].retry_ids) == (2, 0, 3, []) and after[3].retry_ids == []


class Lists:
    def __init__(self, options):
        pass

    def papers(self, day, page, limit):
        return [{"id": f"{day}/{i}", "github_repo": f"https://github.com/o/r{i}" if i == 0 else None} for i in range(3)] if day == "2026-01-01" else []


def paper_details():
    return lambda keys: [RuntimeError("later") if k.endswith("/2") else {"github_repo": "https://github.com/o/r1"} for k in keys]


def repository_ids():
    return lambda keys: [{"id": 10} if k == "o/r0" else None for k in keys]


def repository_ids_later():
    return lambda keys: [{"id": 11} for _ in keys]


def test_papers_command(spark, tmp_path):
    out = str(tmp_path / "o")
    args = ["papers-daily", "--client", "tests.test_flows:Lists", "--details", "tests.test_flows:paper_details", "--state", str(tmp_path / "s.json"), "--output", out, "--option", "start=2026-01-01", "--option", "end=2026-01-02", "--max-requests", "2", "--today", "2026-01-02"]
    assert cli.main([*args, "--nodes", "tests.test_flows:repository_ids"]) == 0
    show = lambda run: {(r.paper_id[-1], r.normalized_repo, r.github_id, r.link_status) for r in spark.read.parquet(f"{out}/links/run={run}").collect()}
    assert show(0) == {("0", "o/r0", 10, "resolved"), ("1", "o/r1", None, "unresolved")}
    assert [(r.paper_id[-1], r.attempts) for r in spark.read.parquet(f"{out}/queue/run=0").collect()] == [("2", 1)]
    assert cli.main([*args, "--nodes", "tests.test_flows:repository_ids_later"]) == 0
    assert show(1) == {("0", "o/r0", 10, "resolved"), ("1", "o/r1", 11, "resolved")}
    assert [r.attempts for r in spark.read.parquet(f"{out}/queue/run=1").collect()] == [2]


def test_history_and_topics():
    specs = json.dumps([{"id": i, "q": i} for i in ("a-1", "a-2", "b-1")])
    options = {"walk": "history", "client": "tests.fake_remote:Client", "specs": specs, "first_year": "2023", "last_year": "2024", "per_page": "10"}
    rows, state = paged.walk(options, None, 4)
    asked = [p["query"].split(" ")[0] + p["query"][-10:-6] for kind, _, p in rows if kind == "coverage"]
    assert asked == ["a-12024", "b-12024", "a-22024", "a-12023"] and not state["complete"]
    rows, state = paged.walk(options, state, 9)
    assert len([1 for kind, *_ in rows if kind == "coverage"]) == 2 and state["complete"] and state["done"]["b-1"] == [2023, 2024]
    assert paged.walk(options, {"done": [["a-1", 2024]]}, 0)[1]["done"] == {"a-1": [2024]}
    options = {"walk": "topics", "client": "tests.fake_remote:Client", "topics": json.dumps(["x", "y"]), "today": "2026-01-01"}
    rows, state = paged.walk(options, None, 99)
    assert state["deep_done"] == {"x": "2026-01-01", "y": "2026-01-01"}
    modes = lambda day, s: [(k, p["mode"]) for kind, k, p in paged.walk(options | {"today": day}, s, 3)[0] if kind == "coverage"]
    assert modes("2026-01-01", state) == [] and modes("2026-01-02", state) == [("x", "head"), ("y", "head")]
    assert modes("2026-01-31", state) == [("x", "head"), ("y", "head"), ("x", "deep")]


def test_topic_rows(spark):
    rows = [(1, 10, "o/a", ["x"], False, "ml", True), (1, 10, "o/a", ["x"], False, "ml", True), (1, 11, "o/b", None, True, "ml", True), (2, 12, "o/c", ["y"], None, "ml", False)]
    got = {r.github_id: r for r in census.topic_rows(spark.createDataFrame(rows, "page int, github_id long, full_name string, topics array<string>, fork boolean, topic string, head boolean")).collect()}
    assert sorted(got) == [10, 12] and got[10].topics == ["ml", "x"] and got[12].topics == ["y"] and got[10].topic_names == ["ml"]


def test_paper_links(spark):
    found = spark.createDataFrame([("p1", "2026-01-01", "https://github.com/a/b"), ("p2", "2026-01-01", None), ("p3", "2026-01-02", "not one"), ("p4", "2026-01-02", None), ("p5", "2026-01-02", None)], "paper_id string, paper_date string, github_repo string")
    queue = spark.createDataFrame([("p4", "2026-01-02", 1)], "paper_id string, paper_date string, attempts int")
    looked = spark.createDataFrame([("p5", "2026-01-09"), ("p3", "2026-01-08")], "paper_id string, checked_on string")
    new = papers.need_details(found, queue, looked, F.lit("2026-01-09"))
    assert sorted(r.paper_id for r in new.collect()) == ["p2", "p3"]
    assert [r.normalized_repo for r in papers.links(found).collect()] == ["a/b"]
    every = queue.unionByName(new)
    assert [r.paper_id for r in papers.next_details(every, ("2026-01-01", "p2"), 2).collect()] == ["p3", "p4"]
    answers = spark.createDataFrame([("p2", True, "https://github.com/c/d"), ("p3", False, None), ("p4", True, None)], "paper_id string, ok boolean, github_repo string")
    left, made, done = papers.after_details(every, answers)
    assert [(r.paper_id, r.attempts) for r in left.collect()] == [("p3", 1)] and [r.normalized_repo for r in made.collect()] == ["c/d"] and sorted(r.paper_id for r in done.collect()) == ["p2", "p4"]
    old = papers.links(found).withColumns({"github_id": F.lit(5).cast("long"), "link_status": F.lit("resolved")})
    side = papers.sidecar(old, papers.links(found).unionByName(made), spark.createDataFrame([("p2", "c/d", 9)], "paper_id string, normalized_repo string, github_id long"))
    assert {(r.paper_id, r.github_id, r.link_status) for r in side.collect()} == {("p1", None, "unresolved"), ("p2", 9, "resolved")}


SOURCE = dict.fromkeys(archives.SOURCE, "s")


def test_archive_offset_over_files(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    for i, ids in enumerate(([*range(40, 60)], [*range(40)], [None, 60, 60, 61])):  # files whose rows are not in order of id
        spark.createDataFrame([(x,) for x in ids], "doc_id long").coalesce(1).write.parquet(f"{tmp_path}/one")
        next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / f"part-{i}.parquet")
        shutil.rmtree(tmp_path / "one")
    (tmp_path / "documents.parquet").mkdir()
    for f in tmp_path.glob("part-*"):
        f.rename(f"{path}/{f.name}")
    ids = [*range(40, 60), *range(40), None, 60, 60, 61]
    for offset in (0, 1, 25, 63, 64, 99):
        assert sorted((r.source_row_offset, r.doc_id) for r in pages.archive(spark, path, offset).collect()) == [*enumerate(ids)][offset:], offset
        ordered = sorted(enumerate(ids), key=lambda x: (x[1] is None, x[1] or 0, x[0]))
        assert sorted((r.source_row_offset, r.doc_id) for r in pages.archive(spark, path, offset, "doc_id").collect()) == sorted(ordered[offset:]), offset
    want = duckdb.sql(catalog.ORACLES["archive_offset"].replace("documents", f"'{path}/*.parquet'")).fetchall()
    assert [tuple(r) for r in catalog.QUERIES["archive_offset"](spark, str(tmp_path)).select("n", "first").collect()] == want == [(27, 37)]


def test_archive_pair(spark, tmp_path):
    rows = [(0, '{"paper_url":"u","arxiv_id":"1","is_official":true,"repo_url":"https://github.com/A/b"}'), (1, '{"paper_url":3,"paper_arxiv_id":"2","arxiv_id":"9","is_official":"yes","repo_url":"https://github.com/c/d"}'), (2, '{"repo_url":"nowhere"}')]
    raw = spark.createDataFrame(rows, "source_row_offset long, j string").withColumn("v", F.parse_json("j"))
    links = archives.link_records(raw, SOURCE, "credit")
    got = {r.source_row_offset: r for r in links.collect()}
    assert sorted(got) == [0, 1] and got[0].paper_arxiv_id == "1" and got[0].is_official and got[1].paper_url is None and got[1].paper_arxiv_id == "2" and got[1].is_official is None
    own = [F.lit("s").alias(c) for c in archives.SOURCE]
    seen = spark.createDataFrame([(7, "a/B", 1, "x"), (7, "a/b", 2, "y"), (8, "z/z", 1, "z")], "github_id long, name string, stamp long, canonical string").select("*", *own, F.lit("credit").alias("source_attribution"))
    repositories, joined = archives.pair(links.unionByName(links), seen, SOURCE)
    assert {(r.source_row_offset, r.github_id) for r in joined.collect()} == {(0, 7), (1, None)}
    files = spark.createDataFrame([("f", "0")], "path string, sha256 string")
    archives.write_pair(spark, str(tmp_path / "p"), repositories, joined, SOURCE, files)
    card = "attribution modifications limitations github_id repositories paper_links"
    assert archives.problems(spark, str(tmp_path / "p"), SOURCE, card) == [] and archives.problems(spark, str(tmp_path / "p"), SOURCE | {"source_license": "x"}, "no") != []
    first = archives.publish_pair(spark, str(tmp_path / "root"), str(tmp_path / "p"), SOURCE, card)
    assert archives.publish_pair(spark, str(tmp_path / "root"), str(tmp_path / "p"), SOURCE, card)["skipped"] and spark.read.parquet(f"{tmp_path}/root/{first['snapshot']}/paper_links").count() == 2
    with pytest.raises(ValueError):
        archives.publish_pair(spark, "/main/", str(tmp_path / "p"), SOURCE, card, "/main")
    with pytest.raises(ValueError, match="another source"):
        archives.pair(links.withColumn("source_license", F.lit("other")), seen, SOURCE)
    with pytest.raises(ValueError, match="two contents"):
        archives.pair(links.unionByName(links.withColumn("paper_url", F.lit("other"))), seen, SOURCE)
    joined.limit(1).write.mode("overwrite").parquet(str(tmp_path / "p/paper_links"))
    assert archives.problems(spark, str(tmp_path / "p"), SOURCE) == ["paper_links is not what the manifest says"]


def test_bundles(spark, tmp_path):
    root = str(tmp_path / "root")
    one = bundles.publish_run(spark, root, None, "census", "r1", "2026-01-02", {"since": 4}, {"enumerated": 2}, ['{"github_id":1}'])
    assert bundles.publish_run(spark, root, None, "census", "r1", "2026-01-02", {"since": 4}, {"enumerated": 2}, ['{"github_id":1}']) == one  # a lost answer
    with pytest.raises(ledger.Conflict):
        bundles.publish_run(spark, root, None, "census", "r2", "2026-01-03", {}, {}, [])
    with pytest.raises(ValueError, match="already"):
        bundles.publish_run(spark, root, one["snapshot"], "census", "r1", "2026-01-03", {"since": 5}, {}, [])
    two = bundles.publish_run(spark, root, one["snapshot"], "papers", "r2", "2026-01-03", {"day": 1}, {}, [])
    assert bundles.hydrate(spark, root, "census") == {"since": 4} and bundles.hydrate(spark, root, "topics") is None
    assert [r.path for r in bundles.listing(spark, root, bundles.OBSERVATIONS).collect()] == ["data/observations/2026/01/02/census-r1.jsonl"]
    assert {r.revision for r in bundles.listing(spark, root).collect()} == {two["snapshot"]}
    for bad in (dict(run="a b"), dict(day="today"), dict(kind="x"), dict(lines=["[]"]), dict(state={"x": "y" * (1 << 20)}, kind="papers")):
        with pytest.raises(ValueError):
            bundles.publish_run(spark, root, two["snapshot"], **({"kind": "census", "run": "r3", "day": "2026-01-04", "state": {}, "coverage": {}, "lines": []} | bad))
    with pytest.raises(ValueError):
        bundles.publish(spark, root, two["snapshot"], "r3", {"../x": ""}, "census")


def test_extra_keys_ids_and_policy(spark, tmp_path):
    write(tmp_path / "a.jsonl", [row(1, score=3, deep={"b": [1, 2.50], "a": None}), row(2), row(1)])
    rows, bad = jsonl.observations(spark, str(tmp_path / "a.jsonl"))
    assert bad.count() == 0 and {r.extra_json for r in rows.collect()} >= {'{"deep":{"a":null,"b":[1,2.5]},"score":3}', None}
    (tmp_path / "b.jsonl").write_text('{"github_id":5}\nbroken\n{"github_id":true}\n[1]\n{"github_id":-1}\n{"github_id":5}\n')
    assert [r.github_id for r in jsonl.recover_ids(spark, str(tmp_path / "b.jsonl")).collect()] == [5]
    assert ledger.under_policy({"at": 1, "policy": 1}, 1) and ledger.under_policy({"at": 1, "policy": 1}, 2) is None and ledger.under_policy(None, 1) is None
