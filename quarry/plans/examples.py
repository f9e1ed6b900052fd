"""Repository texts that take every way out of the rules, with what must come out; queries deal them to rows."""

from __future__ import annotations

#: (name, description, topics, fork, README signals, README sections, status, reason, eligible, candidate reason)
REPOSITORIES = [
    ("ann/nets", "A new transformer architecture", ["vision"], True, None, None, "exclude", "fork", False, "fork"),
    ("ann/hw", "Homework 3 on transformers", [], False, None, None, "exclude", "explicit-noncontribution", False, "not-selected-or-reviewable"),
    ("bob/list", "A survey of diffusion models", [], False, None, None, "exclude", "survey-or-paper-list-repository", False, "not-selected-or-reviewable"),
    ("bob/learn", "A tutorial on transformers", [], False, ["original-tooling"], ["results"], "exclude", "tutorial-repository", True, "probable-original-content:readme:original-tooling"),
    ("cy/filters", "Digital filter design in C", [], False, None, None, "exclude", "non-ml-utility", False, "not-selected-or-reviewable"),
    ("cy/cy", "Hello there", [], False, None, None, "exclude", "owner-profile-repository", False, "not-selected-or-reviewable"),
    ("dee/bt", "Backtesting of strategies", [], False, None, None, "exclude", "non-ml-utility", False, "not-selected-or-reviewable"),
    ("dee/bt2", "Backtesting with a new transformer model", [], False, None, None, "review", "non-ml-utility-with-ml-contribution-cue", True, "probable-original-content:description:original-implementation"),
    ("eve/c1", "Course materials on neural nets", [], False, None, None, "exclude", "course-or-utility-repository", False, "not-selected-or-reviewable"),
    ("eve/c2", "Bootcamp with a novel transformer architecture", [], False, None, None, "review", "course-or-utility-with-novel-method-cue", True, "probable-original-content:description:original-implementation"),
    ("fay/d1", "A novel diffusion model", [], False, ["course-cue"], None, "review", "course-readme-without-official-paper-evidence", True, "probable-original-content:description:original-implementation"),
    ("fay/d2", "A novel diffusion model", [], False, None, None, "include", "specific-method-with-novelty-claim", True, "selected-by-current-rule"),
    ("gus/r", "Reproduction of a transformer", [], False, None, None, "review", "overview-reproduction-or-dataset", False, "insufficient-repository-evidence"),
    ("gus/o", "Official implementation of our NeurIPS 2023 paper on transformers", [], False, None, None, "include", "official-paper-method-implementation", True, "selected-by-current-rule"),
    ("hal/s", "Something", [], False, ["method-contribution", "ml-method-context", "paper-code-relationship"], None, "include", "readme-supported-paper-method-implementation", True, "selected-by-current-rule"),
    ("hal/m", "We train a neural network model", [], False, None, None, "review", "ml-relevance-without-clear-contribution", True, "probable-original-content:description:original-implementation"),
    ("ida/p", "transformer paper and code", [], False, None, None, "review", "ml-relevance-without-clear-contribution", True, "review-with-repository-evidence"),
    ("ida/c", "A calendar app", [], False, None, None, "review", "insufficient-repository-evidence", False, "insufficient-repository-evidence"),
]

#: (sentence, cues joined by |)
CONTENT = [
    ("We train a neural network model.", "original-implementation"),
    ("Fine-tuned BERT adapter", "adaptation-or-fine-tuning"),
    ("Pruning trees in the garden with ai", ""),
    ("Pruning of a neural network", "adaptation-or-fine-tuning"),
    ("We evaluate transformers on accuracy for medical text.", "substantive-application-or-experiments"),
    ("We collected a dataset with labels for machine learning.", "original-dataset-or-benchmark"),
    ("Builds a training pipeline for neural networks", "original-implementation|original-tooling"),
    ("A tutorial to train a neural network model", ""),
    ("This repository will train a neural network model", ""),
    ("An api wrapper for ai", ""),
    ("A novel deep learning architecture", "original-implementation"),
    ("Gardening", ""),
]

#: (README, signals joined by |, sections joined by |)
READMES = [
    ("# Thing\nWe propose a transformer in a paper, with code.\n", "method-contribution|ml-method-context|paper-code-relationship|paper-reference", "other"),
    ("A dataset.\n\nThe dataset again.\n", "dataset-only-cue", ""),
    ("## Method ##\nPlain words\n\n## Results\nmore\n", "", "method|other"),
    ("# Course\n<p>homework</p><p>of courses</p>\n", "course-cue", "course"),
    ("```\nsurvey of transformers\n```\n[neural network](https://doi.org/1)\n", "ml-method-context|paper-reference", ""),
    ("# About\nA faithful reimplementation of BERT\n", "ml-method-context|reproduction-cue", "overview"),
]

#: Plain phrases for labels and relevance; ASCII.
PHRASES = [
    "deep learning for cats", "a calendar app", "graph neural networks and k means", "LLMs for law", "text-to-image diffusion model", "image classification with mamba",
    "time series forecasting", "protein folding tools", "rag and dragons", "reinforcement learning with ppo", "a compiler", "storage engine", "embeddings and classifiers",
    "federated learning and differential privacy", "ml", "speech recognition", "knowledge distillation, pruning", "recommender things", "climate and chemistry", "xgboost on tabular data",
    "robot control policy", "training a model", "optimizer zoo", "notes",
]

#: (address, strict name or "", loose name or "")
ADDRESSES = [
    ("https://github.com/ann/nets", "ann/nets", "ann/nets"), ("https://github.com/ann/nets.git", "ann/nets", "ann/nets"), ("https://www.github.com/ann/nets/tree/main/src", "ann/nets", "ann/nets"),
    ("http://github.com/ann/nets", "", "ann/nets"), ("git@github.com:ann/nets.git", "", "ann/nets"), ("github.com/ann/nets/issues/3", "", "ann/nets"), ("https://github.com/ann/nets?tab=readme", "", "ann/nets"),
    ("https://github.com/ann", "", ""), ("https://example.com/ann/nets", "", ""), ("https://github.com/ann/nets/issues", "", "ann/nets"), ("https://github.com/-ann/nets", "", "-ann/nets"),
    ("https://user@github.com/ann/nets", "", "ann/nets"), ("https://github.com/ann/.hidden", "", "ann/.hidden"), ("ssh://git@github.com/ann/nets.git", "", "ann/nets"), ("https://github.com/ann/nets/blob/main/../x", "", "ann/nets"),
    ("ftp://github.com/ann/nets", "", ""),
]
