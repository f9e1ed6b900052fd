"""Sources with a fake remote: budgets, resume, splitting, fairness; ledgers, snapshots and strict files."""

import json

import pytest
from pyspark.sql import functions as F

from quarry.operators import audit, registry, rules
from quarry.plans import catalog
from quarry.sources import catalogs, jsonl, paged
from quarry.streaming import ledger

SPECS = json.dumps([{"id": "a", "q": "cats"}, {"id": "b", "q": "dogs"}])


def options(walk, **more):
    return {"walk": walk, "client": "tests.fake_remote:Client", **{k: str(v) for k, v in more.items()}}


def test_exact_resume_in_small_steps():
    o = options("search", specs=SPECS, start="2024-01-01", end="2024-03-01", per_page=100)
    whole, end = paged.walk(o, None, 10_000)
    state, rows = None, []
    for _ in range(10_000):
        found, state = paged.walk(o, state, 1)
        rows += found
        if not found:
            break
    assert rows == whole and state == end
    covered = [p for kind, _, p in whole if kind == "coverage"]
    assert {p["status"] for p in covered} == {"partitioned", "complete"}
    assert all(p["total_count"] <= 1000 for p in covered if p["status"] == "complete")


def test_fair_lanes_take_turns_and_changed_queries_restart():
    o = options("search", specs=SPECS, start="2024-01-01", per_page=50, fair="true")
    rows, state = paged.walk(o, None, 2)
    assert {p["query_id"] for kind, _, p in rows if kind == "item"} == {"a", "b"}
    o["specs"] = json.dumps([{"id": "a", "q": "cats"}, {"id": "b", "q": "birds"}])
    aligned = paged.make(o).align(state)
    assert [lane["page"] for lane in aligned["lanes"]] == [2, 1]


def test_sample_is_a_page_a_query():
    rows, state = paged.walk(options("search", specs=SPECS, start="2024-01-01", end="2024-12-31", once="true"), None, 99)
    assert [p["status"] for kind, _, p in rows if kind == "coverage"] == ["sampled", "sampled"] and paged.walk(options("search", specs=SPECS, start="2024-01-01", once="true"), state, 99)[0] == []


def test_halve():
    assert paged.halve("2024-01-01", "2024-01-04") == [["2024-01-01", "2024-01-02"], ["2024-01-03", "2024-01-04"]]
    assert paged.halve("2024-01-01", "2024-01-01")[0][1] == paged.halve("2024-01-01", "2024-01-01")[1][0]
    assert paged.halve("2024-01-01T00:00:00Z", "2024-01-01T00:00:01Z") == []


def test_other_walks():
    rows, state = paged.walk(options("enumerate"), None, 99)
    assert [k for kind, k, _ in rows if kind == "item"] == [str(i) for i in range(1, 11)] and state["end"]
    rows, state = paged.walk(options("topics", topics=json.dumps(["x", "gone", "y"])), None, 99)
    seen = [(k, p["mode"]) for kind, k, p in rows if kind == "coverage"]
    assert seen == [("x", "head"), ("gone", "head"), ("y", "head"), ("x", "deep"), ("y", "deep"), ("x", "deep"), ("y", "deep"), ("x", "deep"), ("y", "deep")]
    kept = paged.make(options("topics", topics=json.dumps(["y", "z"]))).align(state)
    assert kept["order"] == ["y", "z"] and kept["deep"] == {"z": None}
    rows, state = paged.walk(options("papers", start="2024-01-01", end="2024-01-02", limit=10, room=6), None, 99)
    assert state["full"] and state["day"] == "2024-01-02" and state["page"] == 0


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    spark.dataSource.register(paged.PagedSource)
    o = options("search", specs=SPECS, start="2024-01-01", per_page=50, max_requests=2)

    def run():
        df = spark.readStream.format("paged").options(**o).load()
        query = df.writeStream.foreachBatch(ledger.batch_sink(str(tmp_path / "out"), "search")).option("checkpointLocation", str(tmp_path / "cp")).trigger(once=True).start()
        query.awaitTermination()

    for _ in range(4):
        run()
    got = spark.read.parquet(str(tmp_path / "out/search"))
    want, _ = paged.walk(o, None, 99)
    assert got.where("kind = 'item'").select("key").distinct().count() == len({k for kind, k, _ in want if kind == "item"})
    batch = spark.read.format("paged").options(**o).load()
    assert batch.where("kind = 'state'").count() == 1


def test_lookup_aligns(spark):
    got = {r.key: r.status for r in paged.lookup(spark.range(1, 16), "id", "tests.fake_remote:batch_lookup", 4).collect()}
    assert got["5"] == "missing" and got["7"] == "error" and got["8"] == "ok" and len(got) == 15


def row(i, **more):
    base = {"github_id": i, "name": f"o/r{i}", "observed_at": "2024-01-01T00:00:00Z", "query_ids": ["q"], "domains": None, "methods": ["Flow Matching"], "novelty_signals": []}
    return base | more


def write(path, rows, end="\n"):
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + end, encoding="utf-8")


def test_log_to_views(spark, tmp_path):
    rows = [
        row(1, observed_at="2024-05-01T00:00:00+00:00", queryless=True, paper_ids=["p1"], custom={"x": 1.0}), row(1, observed_at="2024-01-01T02:00:00+02:00", description="A novel diffusion model", stars=3), row(1, observed_at="2023-01-01T00:00:00Z", queryless=True),
        row(2, description="line inside", queryless=True), row(2, description="line inside", queryless=True, url="x"),
    ]
    write(tmp_path / "a.jsonl", rows[:3])
    write(tmp_path / "b.jsonl", rows[3:])
    good, bad = jsonl.observations(spark, str(tmp_path / "*.jsonl"))
    view = {r.github_id: r for r in registry.current_view(jsonl.require(good, bad)).collect()}
    assert view[1].description == "A novel diffusion model" and view[1].selection_status == "include" and view[1].observation_count == 3
    assert view[1].first_observed_at == "2023-01-01T00:00:00Z" and view[1].paper_ids == ["p1"] and view[1].all_methods == ["flow-matching"]
    assert view[2].url is None and view[2].description == "line inside" and view[2].stars is None
    extra = good.where("github_id = 1 AND extra_json IS NOT NULL").first()
    assert json.loads(extra.extra_json)["custom"] in ('{"x":1.0}', {"x": 1.0})
    typed = registry.to_view(registry.current_view(good))
    assert len(typed.columns) == 49 and typed.columns[-1] == "extra_json"
    inputs = jsonl.fingerprints(spark, str(tmp_path / "*.jsonl"))
    root = str(tmp_path / "published")
    versions = {"selection": rules.P.SELECTION_VERSION}
    first = ledger.publish_snapshot(spark, root, registry.current_view(good), good, inputs, versions)
    assert first["counts"] == {"current": 1, "candidates": 1, "repositories": 0, "observations": 5}
    assert ledger.publish_snapshot(spark, root, registry.current_view(good), good, inputs, versions)["skipped"]
    with pytest.raises(ledger.Conflict):
        ledger.swap(spark, root, "someone-else", first | {"snapshot": "new"})


@pytest.mark.parametrize("bad,rule", [({"github_id": True}, "github_id"), ({"github_id": 0}, "github_id"), ({"queryless": 1}, "queryless"), ({"observed_at": "2024-01-01T00:00:00"}, "observed_at"), ({"paper_ids": None}, "paper_ids"), ({"methods": ["x", 3]}, "methods"), ({"domains": [" "]}, "domains")])
def test_bad_rows_fail_closed(spark, tmp_path, bad, rule):
    write(tmp_path / "a.jsonl", [row(1), row(2, **bad)])
    good, wrong = jsonl.observations(spark, str(tmp_path / "a.jsonl"))
    assert [r.rule for r in wrong.collect()] == [rule] and good.count() == 1
    with pytest.raises(jsonl.InvalidInput):
        jsonl.require(good, wrong)


def test_strict_files(spark, tmp_path):
    for name, data in {"ok": b'{"a":1}\n', "cr": b'{"a":1}\r\n', "tail": b'{"a":1}', "blank": b'{"a":1}\n\n{"b":2}\n', "utf": b'{"a":"\xff"}\n'}.items():
        (tmp_path / f"{name}.jsonl").write_bytes(data)
    got = {r.path.split("/")[-1]: r.rule for r in jsonl.strict_violations(spark, str(tmp_path / "*.jsonl")).collect()}
    assert got == {"cr.jsonl": "carriage-return", "tail.jsonl": "no-final-line-feed", "blank.jsonl": "blank-line", "utf.jsonl": "utf8"}
    (tmp_path / "c.jsonl").write_text('{"b":1, "a":2}\n{"a":1.0,"b":2}\n')
    assert jsonl.not_canonical(spark, str(tmp_path / "c.jsonl")).count() == 1


def test_evidence_rows(spark, tmp_path):
    base = {"github_id": 1, "repository_name_at_fetch": "o/r", "observed_at": "2024-01-01T00:00:00Z", "readme_status": "ok", "readme_etag": None, "readme_blob_sha": None, "readme_evidence_version": "v3", "readme_signals": ["s"], "readme_sections": [], "readme_checked_at": None}
    write(tmp_path / "e.jsonl", [base, base | {"extra": 1}, base | {"readme_signals": ["t"]}, base | {"readme_status": "missing"}, base | {"readme_evidence_version": "v9"}, base | {"github_id": True}])
    good, bad = jsonl.evidence(spark, str(tmp_path / "e.jsonl"), ["v3"], ["s"], [])
    assert good.count() == 1 and sorted(r.rule for r in bad.collect()) == ["fields", "github_id", "missing-with-signals", "readme_evidence_version", "readme_signals"]


def test_catalog_files(spark, tmp_path):
    (tmp_path / "b.toml").write_text('[[queries]]\nid = "z"\nq = "cats"\n')
    (tmp_path / "a.toml").write_text('[[queries]]\nid = "a"\nq = "dogs"\nmethods = ["rag"]\n')
    assert [e["id"] for e in catalogs.read_queries(tmp_path)] == ["a", "z"] and catalogs.queries(spark, str(tmp_path)).count() == 2
    (tmp_path / "c.toml").write_text('[[queries]]\nid = "a"\nq = "dogs"\n')
    with pytest.raises(catalogs.InvalidCatalog):
        catalogs.read_queries(tmp_path)
    t = tmp_path / "topics"
    t.write_text('[catalog]\ntopics = ["x", "x"]\n')
    with pytest.raises(catalogs.InvalidCatalog):
        catalogs.read_topics(t)


def test_ledgers(spark, tmp_path):
    pool = spark.createDataFrame([(1, 4), (2, 0), (3, 1)], "id long, attempts int")
    tried = spark.createDataFrame([(1, False), (2, True), (9, False)], "id long, ok boolean")
    assert {tuple(r) for r in ledger.retry_pools(pool, tried).collect()} == {(1, 5, "failed"), (3, 1, "retry"), (9, 1, "retry")}
    queue = spark.createDataFrame([("a",), ("b",)], "k string")
    assert not ledger.admit(queue, spark.createDataFrame([("c",), ("d",)], "k string"), ["k"], 3)[1]
    assert ledger.admit(queue, spark.createDataFrame([("b",), ("d",), ("d",)], "k string"), ["k"], 3)[0].count() == 3
    assert ledger.window({"since": "a", "until": "b", "complete": True}, "x", "c")["since"] == "b" and ledger.window(None, "x", "c")["since"] == "x"
    assert ledger.ledger_migrate({"done": [["q", 2024], ["q", 2023]]})["done"] == {"q": [2023, 2024]}
    ledger.save_state(spark, str(tmp_path / "s.json"), {"a": 1})
    assert ledger.load_state(spark, str(tmp_path / "s.json")) == {"a": 1} and ledger.load_state(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError):
        ledger.safe("../x")
    with pytest.raises(ValueError):
        ledger.save_state(spark, str(tmp_path / "s.json"), {"a": "x" * 100}, 10)


def test_seeded_sample(spark):
    frame = spark.createDataFrame([(i, f"n{i}", "u", audit.STATUSES[i % 3]) for i in range(1, 61)], "github_id long, name string, url string, selection_status string").repartition(3)
    import random

    rng, want = random.Random(5), set()
    for status in ("include", "review"):
        ids = [i for i in range(1, 61) if audit.STATUSES[i % 3] == status]
        want |= set(rng.sample(ids, 4))
    key = audit.sample(frame, 5, {"review": 4, "include": 4}, [2]).collect()
    assert {r.github_id for r in key if r.sample_kind == "probability"} == want and sum(r.sample_kind == "challenge" for r in key) == 1
    assert all(r.weight == 5.0 for r in key if r.sample_kind == "probability") and len({r.case_id for r in key}) == len(key)
    with pytest.raises(ValueError):
        audit.sample(frame, 5, {"review": 400})


def test_flagship(spark):
    assert catalog.QUERIES["current_registry"](spark, "/root/testdata/sf0.001").where(F.col("evidence_tier").isNull()).count() == 0


def test_node_projection(spark):
    from quarry.operators import pages

    node = "struct<nameWithOwner:string,url:string,description:string,topics:array<string>,primaryLanguage:string,stargazerCount:int,isArchived:boolean,isFork:boolean>"
    df = spark.createDataFrame([(1, ("o/r", "u", None, ["b", "a", "b"], None, 3, False, False)), (2, ("o/r", None, None, [], None, 3, False, False)), (3, None)], f"id long, node {node}")
    strict, loose = pages.project_node(df).collect(), pages.project_node(df, strict=False).collect()
    assert [r.id for r in strict] == [1] and strict[0].topics == ["a", "b"] and strict[0].stargazers_count == 3
    assert len(loose) == 3 and registry.project_repository(pages.project_node(df).withColumns({"license": F.lit(None).cast("struct<spdx_id:string,key:string,name:string>"), "homepage": F.lit(" "), "forks_count": F.lit(None).cast("long"), **{c: F.lit(None).cast("string") for c in ("created_at", "pushed_at", "updated_at")}})).first().homepage is None


def test_log_round_trip(spark, tmp_path):
    from quarry.operators import pages

    write(tmp_path / "a.jsonl", [row(2), row(1, description="é"), row(1)])
    good, _ = jsonl.observations(spark, str(tmp_path / "a.jsonl"))
    pages.write_log(good.coalesce(1), str(tmp_path / "out"))
    assert jsonl.strict_violations(spark, str(tmp_path / "out/*.txt")).count() == 0 and jsonl.not_canonical(spark, str(tmp_path / "out/*.txt")).count() == 0
    base = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "github_id long, name string, description string")
    new = spark.createDataFrame([(1, None, "new")], "github_id long, name string, description string")
    assert {(r.name, r.description) for r in registry.overlay_enrichment(base, new).collect()} == {("a", "new"), ("b", "old")}
