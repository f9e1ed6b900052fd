"""One row or more for each way out of each rule, and near misses."""

import pytest

from quarry.functions import patterns as P
from quarry.operators import rules

SCHEMA = (
    "id long, name string, full_name string, description string, topics array<string>, fork boolean, readme_status string, readme_signals array<string>, "
    "readme_sections array<string>, readme_evidence_version string, paper_ids array<string>, homepage string"
)

# name, description, topics, fork, README signals -> status, reason
SELECTIONS = [
    ("a/b", "A new transformer architecture", [], True, None, "exclude", "fork"),
    ("a/b", "Homework 3: transformers", [], False, None, "exclude", "explicit-noncontribution"),
    ("a/b", "A survey of diffusion models", [], None, None, "exclude", "survey-or-paper-list-repository"),
    ("a/b", "A tutorial on transformers", [], None, None, "exclude", "tutorial-repository"),
    ("a/b", "Digital filter design in C", [], None, None, "exclude", "non-ml-utility"),
    ("ann/ann", "Hello there", [], None, None, "exclude", "owner-profile-repository"),
    ("ann/.github", "Defaults", [], None, None, "exclude", "owner-profile-repository"),
    (".github", "Defaults", [], None, None, "exclude", "owner-profile-repository"),
    ("espnet/espnet", "End-to-end speech processing", [], None, None, "review", "insufficient-repository-evidence"),
    ("a/bt", "Backtesting of strategies", [], None, None, "exclude", "non-ml-utility"),
    ("a/bt", "Backtesting with a new transformer model", [], None, None, "review", "non-ml-utility-with-ml-contribution-cue"),
    ("a/c", "Course materials on neural nets", [], None, None, "exclude", "course-or-utility-repository"),
    ("a/c", "Course project: a novel transformer architecture", [], None, None, "review", "course-or-utility-with-novel-method-cue"),
    ("a/d", "A novel diffusion model", [], None, ["course-cue"], "review", "course-readme-without-official-paper-evidence"),
    ("a/d", "A novel diffusion model", [], None, ["course-cue", "paper-reference"], "include", "specific-method-with-novelty-claim"),
    ("a/e", "Reproduction of a transformer", [], None, None, "review", "overview-reproduction-or-dataset"),
    ("a/e", "Dataset of cats", [], None, None, "review", "overview-reproduction-or-dataset"),
    ("a/f", "Official implementation of our NeurIPS 2023 paper on transformers", [], None, None, "include", "official-paper-method-implementation"),
    ("a/f", "Official code for our CVPR 2021 paper", ["diffusion-models"], None, None, "include", "official-paper-method-implementation"),
    ("a/f", "Unofficial implementation of the transformer paper", [], None, None, "review", "ml-relevance-without-clear-contribution"),
    ("a/g", "A new attention mechanism method for tables", [], None, None, "include", "specific-method-with-novelty-claim"),
    ("a/g", "A new method. It has a transformer", [], None, None, "review", "ml-relevance-without-clear-contribution"),
    ("a/g", "A new method " + "x" * 70 + " with a transformer", [], None, None, "review", "ml-relevance-without-clear-contribution"),
    ("a/new-transformer-model", "Exploring forecasting such as TimesNet", [], None, None, "review", "ml-relevance-without-clear-contribution"),
    ("a/h", "DragThing official code (SIGGRAPH 2023)", ["gan"], None, ["ml-method-context", "paper-reference"], "include", "readme-supported-paper-method-implementation"),
    ("a/h", "Something", [], None, ["ml-method-context", "method-contribution", "paper-code-relationship"], "include", "readme-supported-paper-method-implementation"),
    ("a/h", "Something", [], None, ["ml-method-context", "method-contribution", "paper-code-relationship", "survey-cue"], "review", "insufficient-repository-evidence"),
    ("a/i", "Machine learning things", [], None, None, "review", "ml-relevance-without-clear-contribution"),
    ("a/j", "A calendar app", [], None, None, "review", "insufficient-repository-evidence"),
    (None, None, None, None, None, "review", "insufficient-repository-evidence"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_selector_exits(spark):
    rows = [(i, n, None, d, t, f, "ok" if s else None, s, None, None, None, None) for i, (n, d, t, f, s, *_) in enumerate(SELECTIONS)]
    got = {r.id: r for r in rules.select(frame(spark, rows)).collect()}
    for i, (*_, status, reason) in enumerate(SELECTIONS):
        assert (got[i].selection_status, got[i].selection_reason) == (status, reason), SELECTIONS[i]
        assert got[i].selection_signals == sorted(set(got[i].selection_signals))
    assert got[0].selection_signals == ["fork"] and got[1].selection_signals == ["explicit-noncontribution"]
    assert got[17].selection_signals == ["ml-method-cue", "contribution-language", "paper-and-code-cue", "official-paper-implementation-cue"] or set(got[17].selection_signals) == {
        "ml-method-cue", "contribution-language", "paper-and-code-cue", "official-paper-implementation-cue",
    }


CONTENT = [
    ("We train a neural network model.", ["original-implementation"]),
    ("Fine-tuned BERT adapter", ["adaptation-or-fine-tuning"]),
    ("Pruning trees in the garden with ai", []),
    ("Pruning of a neural network", ["adaptation-or-fine-tuning"]),
    ("We evaluate transformers on accuracy for medical text.", ["substantive-application-or-experiments"]),
    ("We collected a dataset with labels for machine learning.", ["original-dataset-or-benchmark"]),
    ("Builds a training pipeline for neural networks", ["original-implementation", "original-tooling"]),
    ("A tutorial to train a neural network model", []),
    ("This repository will train a neural network model", []),
    ("An api wrapper for ai", []),
    ("Independent third-party profile. We train a neural network model.", []),
    ("A novel deep learning architecture", ["original-implementation"]),
    ("Gardening", []),
    (None, []),
]


def test_probable_content(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CONTENT)], "id long, t string")
    got = {r.id: r.s for r in df.select("id", rules.probable_content(df.t).alias("s")).collect()}
    assert [got[i] for i in range(len(CONTENT))] == [w for _, w in CONTENT]


def test_relevance_and_labels(spark):
    rows = [(0, "a/b", None, "Deep-learning for LLMs", ["transformers"], None, None, None, None, None, None, None), (1, "x/emb", None, "embedding tools", None, None, None, None, None, None, None, None), (2, None, None, None, None, None, None, None, None, None, None, None), (3, "storage/drag", None, "drag queens, ragtime; graph neural networks; k-means; arXiv: 2101.00001 model weights", [], None, None, None, None, None, None, None)]
    got = {r.id: r for r in rules.relevance(frame(spark, rows)).collect()}
    assert (got[0].evidence_tier, got[0].evidence_signals) == ("direct_ml_text", ["deep-learning", "large-language-model", "transformer"])
    assert (got[1].evidence_tier, got[1].evidence_signals) == ("ml_related_text", ["embedding"]) and got[2].evidence_tier == "no_text_signal"
    df = frame(spark, rows).selectExpr("*", "array(' Vision ', null) AS sd", "array('Flow  Matching', '--') AS sm", "id = 3 AS hit")
    lab = {r.id: r for r in rules.labels(df, "sd", "sm", "hit").collect()}
    assert lab[3].methods == ["flow-matching", "graph-neural-network", "k-means", "neural-network"] and lab[3].domains == ["graph-learning", "vision"]
    assert lab[3].novelty_signals == ["description", "model-weights", "paper-reference", "query-match"]
    assert lab[2].methods == ["flow-matching"]


def test_decision(spark):
    texts = [("a/deep", "deep learning", "candidate"), ("a/b", "ml", "candidate"), ("", "", "unknown"), ("a/b", "cv", "candidate"), ("a/b", "rl stuff of mine", "unknown"), ("a/b", "x", "unknown"), ("some/calendar", "a calendar app", "not_candidate")]
    rows = [(i, n, None, d, None, None, "enriched", None, None, None, None, None) for i, (n, d, _) in enumerate(texts)]
    got = {r.id: r for r in rules.decision(frame(spark, rows)).collect()}
    assert [got[i].candidate_status for i in range(len(texts))] == [w for *_, w in texts]
    assert got[3].candidate_evidence == ["census-rule:liberal-ml-ai-v1", "classifier-domain:computer-vision"]
    forced = rules.decision(frame(spark, rows).withColumn("e", rules.F.lit("error")), enrichment="e").first()
    assert forced.candidate_status == "unknown" and forced.candidate_evidence == ["enrichment-error"]


README = """# My Project
We propose a method: a transformer. See the paper https://arxiv.org/abs/2101.00001 and our code.

## Results
Trained model weights of the neural network. We evaluate transformers on accuracy for text.

```
course homework
```
## Citation
We train a neural network model and a survey.
<p>An official implementation of <a href="https://x.y/paper">this diffusion model</a></p>
> thanks to the teachers of engineering studies
## Result
plain
"""


def test_readme(spark):
    df = spark.createDataFrame([(0, README), (1, "A dataset.\n\nThe dataset again."), (2, None), (3, "# Course\nof course\n"), (4, "## Method ##\r\nx y")], "id long, text string")
    got = {r.id: r for r in rules.readme_evidence(df).collect()}
    assert got[0].readme_sections == ["citation", "other", "results"]
    assert got[0].readme_signals == ["course-cue", "method-contribution", "ml-method-context", "model-training-artifact", "original-implementation", "paper-code-relationship", "paper-reference", "substantive-application-or-experiments", "survey-cue"]
    assert got[1].readme_signals == ["dataset-only-cue"] and got[2].readme_signals == []
    assert got[3].readme_signals == [] and got[3].readme_sections == ["course"] and got[4].readme_sections == ["method"]


def test_candidate_routes(spark):
    rows = [
        (0, "review", "ml-relevance-without-clear-contribution", "We train a neural network model", None, None, None, None, None, True, "probable-original-content:description:original-implementation"),
        (1, "exclude", "tutorial-repository", "x", "ok", ["original-tooling"], ["results"], None, None, True, "probable-original-content:readme:original-tooling"),
        (2, "exclude", "tutorial-repository", "x", "ok", ["original-tooling"], ["usage"], None, None, False, "not-selected-or-reviewable"),
        (3, "exclude", "non-ml-utility", "We evaluate transformers on accuracy for text.", None, None, None, None, None, True, "probable-original-content:description:substantive-application-or-experiments"),
        (4, "exclude", "owner-profile-repository", "We train a neural network model", None, None, None, None, None, False, "not-selected-or-reviewable"),
        (5, "include", "specific-method-with-novelty-claim", "", None, None, None, None, None, True, "selected-by-current-rule"),
        (6, "review", "ml-relevance-without-clear-contribution", "plain", None, None, None, ["ml-method-cue", "paper-and-code-cue"], None, True, "review-with-repository-evidence"),
        (7, "review", "ml-relevance-without-clear-contribution", "plain", None, None, None, ["ml-method-cue"], ["2101.1"], True, "review-with-unverified-paper-link"),
        (8, "review", "ml-relevance-without-clear-contribution", "plain", None, None, None, ["ml-method-cue"], [" "], False, "insufficient-repository-evidence"),
        (9, "odd", None, "We train a neural network model", None, None, None, None, None, False, "insufficient-repository-evidence"),
        (10, "review", "fork", "x", None, None, None, None, None, False, "fork"),
    ]
    df = spark.createDataFrame([r[:9] for r in rows], "id long, selection_status string, selection_reason string, description string, readme_status string, readme_signals array<string>, readme_sections array<string>, selection_signals array<string>, paper_ids array<string>")
    df = df.withColumn("readme_evidence_version", rules.F.lit(P.README_VERSION)).withColumn("evidence_tier", rules.F.lit("direct_ml_text"))
    got = {r.id: (r.candidate_eligible, r.candidate_reason) for r in rules.candidate(df).collect()}
    assert got == {r[0]: r[9:] for r in rows}


@pytest.mark.parametrize("extra,tier", [
    ({"selection_signals": ["paper-and-code-cue"]}, 0), ({"selection_status": "include"}, 1), ({"selection_signals": ["ml-method-cue"]}, 2),
    ({"description": "official jax code", "evidence_tier": "direct_ml_text"}, 3), ({"description": "We train a neural network model"}, 4), ({"topics": ["deep_learning"]}, 5), ({"methods": ["rag"]}, 5),
    ({}, None), ({"fork": True, "selection_status": "include"}, None), ({"name": "me/me", "selection_status": "include"}, None), ({"description": "a course", "selection_status": "include"}, None),
])
def test_queue_tier(spark, extra, tier):
    row = {"name": "a/b", "description": "plain", "topics": None, "methods": None, "fork": None, "selection_status": None, "selection_signals": None, "evidence_tier": None} | extra
    schema = "name string, description string, topics array<string>, methods array<string>, fork boolean, selection_status string, selection_signals array<string>, evidence_tier string"
    assert rules.queue_tier(spark.createDataFrame([tuple(row.values())], schema)).first().queue_tier == tier
