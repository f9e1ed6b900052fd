"""Commands end to end on small files."""

import json
import tempfile
from pathlib import Path

import pytest

from quarry import cli
from tests.test_sources import row, write


ASKED = Path(tempfile.gettempdir(), "quarry-test-asked")


def make_readmes():
    import base64

    text = b"We propose a transformer in a paper, with code."

    def get(name, etag):
        with ASKED.open("a") as f:
            f.write(name + "\n")
        return 200, "e", json.dumps({"type": "file", "size": len(text), "encoding": "base64", "sha": "s", "content": base64.b64encode(text).decode()})

    return get


def test_view_commands(spark, tmp_path, capsys):
    ASKED.unlink(missing_ok=True)
    write(tmp_path / "a.jsonl", [row(1, description="A novel diffusion model"), row(2, description="machine learning")])
    src = str(tmp_path / "a.jsonl")
    assert cli.main(["current-view", "--observations", src, "--output", str(tmp_path / "v")]) == 0
    assert spark.read.parquet(str(tmp_path / "v")).count() == 2
    for skipped in (False, True):
        assert cli.main(["publish-current-view", "--observations", src, "--output", str(tmp_path / "p")]) == 0
        assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]).get("skipped", False) is skipped
    args = ["readme-enrich", "--observations", src, "--output", str(tmp_path / "r"), "--state", str(tmp_path / "s.json"), "--client", "tests.test_cli:make_readmes", "--max-requests", "1"]
    assert cli.main(args) == 0 and cli.main(args) == 0
    got = spark.read.parquet(str(tmp_path / "r")).collect()
    assert {r.github_id for r in got} == {1, 2} and all("paper-code-relationship" in r.record.readme_signals for r in got)
    assert cli.main(args) == 0  # nothing is due
    assert sorted(ASKED.read_text().split()) == ["o/r1", "o/r2"]  # one request a row
    write(tmp_path / "bad.jsonl", [row(0)])
    assert cli.main(["current-view", "--observations", str(tmp_path / "bad.jsonl"), "--output", str(tmp_path / "v")]) == 2
    assert spark.read.parquet(str(tmp_path / "v")).count() == 2


def test_walk_commands(spark, tmp_path):
    (tmp_path / "q").mkdir()
    (tmp_path / "q/a.toml").write_text('[[queries]]\nid = "a"\nq = "cats"\n')
    base = ["--client", "tests.fake_remote:Client", "--state", str(tmp_path / "s.json"), "--output", str(tmp_path / "o"), "--max-requests", "1"]
    for _ in range(3):
        assert cli.main(["run", *base, "--queries", str(tmp_path / "q"), "--option", "start=2024-01-01", "--option", "per_page=100"]) == 0
    assert sum(spark.read.parquet(str(p)).count() for p in (tmp_path / "o/search").glob("*/kind=item")) == 150


def test_audit_commands(spark, tmp_path):
    spark.createDataFrame([(i, f"n{i}", "u", "include" if i % 2 else "review") for i in range(1, 21)], "github_id long, name string, url string, selection_status string").write.parquet(str(tmp_path / "f"))
    assert cli.main(["audit-sample", "--frame", str(tmp_path / "f"), "--output", str(tmp_path / "a"), "--seed", "3", "--size", "include=2", "--size", "review=2"]) == 0
    cases = [r.case_id for r in spark.read.parquet(str(tmp_path / "a/roster")).collect()]
    note = {"label": "yes", "rationale": "r"}
    write(tmp_path / "n.jsonl", [{"case_id": c, "annotator_1": note, "annotator_2": note, "adjudicated_label": "yes", "evidence": [{"kind": "paper", "url": "https://x.org/1", "locator": "p"}]} for c in cases])
    assert cli.main(["audit-score", "--annotations", str(tmp_path / "n.jsonl"), "--key", str(tmp_path / "a/key")]) == 0
    write(tmp_path / "n.jsonl", [{"case_id": c, "annotator_1": note, "annotator_2": note, "adjudicated_label": "yes", "evidence": [{"kind": "paper", "url": "ftp://x.org/1", "locator": "p"}]} for c in cases[:3]])
    assert cli.main(["audit-score", "--annotations", str(tmp_path / "n.jsonl"), "--key", str(tmp_path / "a/key")]) == 2


def test_unknown_command():
    with pytest.raises(SystemExit):
        cli.main(["nothing"])
