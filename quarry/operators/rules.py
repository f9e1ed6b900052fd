"""Rule operators: columns in, columns out, no shuffle and no Python on the executors.

Every function takes a DataFrame with the columns it names (others pass through) and adds its results. Texts are
folded once into helper columns, which are dropped again. Missing columns count as null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quarry.functions import patterns as P, text as X

_TEXT = {"name": "string", "full_name": "string", "description": "string", "homepage": "string", "readme": "string", "license": "string", "pushed_at": "string", "updated_at": "string", "default_branch": "string"}
_TEXT |= {"fork": "boolean", "topics": "array<string>", "readme_status": "string", "readme_evidence_version": "string", "readme_signals": "array<string>", "readme_sections": "array<string>"}
_TEXT |= {"evidence_tier": "string", "paper_ids": "array<string>", "selection_status": "string", "selection_reason": "string", "selection_signals": "array<string>", "methods": "array<string>"}


def _complete(df: DataFrame, *names: str) -> DataFrame:
    """df with the named columns, null where it has none."""
    return df.withColumns({n: F.lit(None).cast(_TEXT[n]) for n in names if n not in df.columns})


def _tags(*pairs: tuple[Column, str]) -> Column:
    """The labels whose conditions hold."""
    return F.array_compact(F.array(*[F.when(c, F.lit(label)) for c, label in pairs]))


def _any(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _text(*names: str) -> Column:
    return F.concat_ws(" ", *[F.col(n) for n in names])


def _in(label: str, values: Column) -> Column:
    return F.coalesce(F.array_contains(values, label), F.lit(False))


def _once(df: DataFrame, had: list[str], *columns: Column) -> DataFrame:
    """The columns had and some more. These leave as a generator's, so that a filter on them is not pushed into their
    rules, which would then run once for every place that names them."""
    return df.select(*had, F.inline(F.array(F.struct(*columns))))


def relevance(df: DataFrame) -> DataFrame:
    """evidence_version, evidence_tier and evidence_signals from name, description and topics."""
    had = df.columns
    df = _complete(df, "name", "description", "topics").withColumn("_t", F.concat_ws("\n", "name", "description", "topics"))
    pick = lambda rules: F.array_sort(_tags(*[(X.has(F.col("_t"), p), k) for k, p in rules.items()]))
    df = df.withColumns({"_d": pick(P.DIRECT_TEXT), "_r": pick(P.RELATED_TEXT)})
    tier = F.when(F.size("_d") > 0, "direct_ml_text").when(F.size("_r") > 0, "ml_related_text").otherwise("no_text_signal")
    return df.select(*had, F.lit(P.RELEVANCE_VERSION).alias("evidence_version"), tier.alias("evidence_tier"), F.concat("_d", "_r").alias("evidence_signals"))


def term_pattern(term: str) -> str:
    """A method term as a pattern: any white space between words, no letter or digit around it, plural networks."""
    return r"(?<![a-z0-9])" + term.replace(" ", r"\s+") + ("s?" if term.endswith("network") else "") + r"(?![a-z0-9])"


def _slug(term: str) -> str:
    return term.replace(" ", "-")


def _domains(corpus: Column) -> Column:
    return _tags(*[(X.has(corpus, "|".join(f"(?:{p})" for p in some)), label) for label, some in P.DOMAINS.items()])


_ANY_TERM = "(?<![a-z0-9])(?:" + "|".join(t.replace(" ", r"\s+") for t in P.METHOD_TERMS) + ")"


def _methods(corpus: Column) -> Column:
    """One search tells whether any term is there; only then each is looked for."""
    each = _tags(*[(X.has(corpus, term_pattern(t)), _slug(t)) for t in P.METHOD_TERMS])
    return F.when(X.has(corpus, _ANY_TERM), each).otherwise(F.array().cast("array<string>"))


def labels(df: DataFrame, spec_domains: str | None = None, spec_methods: str | None = None, matched: str | None = None) -> DataFrame:
    """domains, methods and novelty_signals of a repository, with the labels of the queries that found it.

    spec_domains and spec_methods name array columns, matched a boolean one.
    """
    had = [c for c in df.columns if c not in ("domains", "methods", "novelty_signals")]
    given = lambda c, f: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), f) if c else F.array().cast("array<string>")
    extra_d = F.filter(given(spec_domains, lambda x: X.strip(X.casefold(x))), lambda x: x.isNotNull())
    extra_m = F.filter(given(spec_methods, lambda x: X.method_slug(X.strip(x))), lambda x: x.isNotNull() & (x != ""))
    hit = F.col(matched) if matched else F.lit(False)
    df = df.withColumns({"_ed": extra_d, "_em": extra_m, "_hit": F.coalesce(hit, F.lit(False))})
    df = _complete(df, "name", "full_name", "description", "homepage", "readme", "topics", "license", "pushed_at", "updated_at", "default_branch")
    df = df.withColumn("_c", X.fold(_text("topics", "name", "full_name", "description", "readme", "homepage")))
    filled = lambda c: F.coalesce(F.length(c) > 0, F.lit(False))
    signals = _tags(
        (F.col("_hit"), "query-match"), (filled("description"), "description"), (F.coalesce(F.size("topics") > 0, F.lit(False)), "github-topics"), (filled("readme"), "readme"),
        (X.has(F.col("_c"), P.PAPER_LINK), "paper-reference"), (filled("license"), "license-metadata"), (filled("default_branch") | filled("pushed_at") | filled("updated_at"), "repository-metadata"),
        (X.has(F.col("_c"), P.WEIGHT_FILES), "model-weights"),
    )
    out = {"domains": X.sorted_set(F.concat(_domains(F.col("_c")), "_ed")), "methods": X.sorted_set(F.concat(_methods(F.col("_c")), "_em")), "novelty_signals": F.array_sort(signals)}
    return df.select(*had, *[v.alias(k) for k, v in out.items()])


def decision(df: DataFrame, enrichment: str | None = None) -> DataFrame:
    """candidate_status (candidate, unknown, not_candidate) and candidate_evidence by the permissive rule.

    With enrichment, a status column, rows of another status than "enriched" are unknown.
    """
    had = df.columns
    df = _complete(df, "name", "full_name", "description", "homepage", "topics")
    words = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in ("name", "full_name", "description", "homepage")], F.col("topics"))
    df = df.withColumns({"_p": F.translate(words, "_-", "  "), "_c": X.fold(_text("topics", "name", "full_name", "description", "homepage"))})
    df = df.withColumns({"_dom": _domains(F.col("_c")), "_met": _methods(F.col("_c")), "_term": X.has(F.col("_p"), P.CANDIDATE_TERMS)})
    bare = X.strip(F.col("_p"))
    rule = F.array(F.lit("census-rule:" + P.DECISION_VERSION))
    found = F.col("_term") | (F.size("_dom") > 0) | (F.size("_met") > 0)
    thin = (F.length(bare) < 12) | X.has(F.col("_p"), P.BARE_ABBREVIATION)
    evidence = F.array_sort(
        F.concat(rule, _tags((F.col("_term"), "generic-ml-ai-term")), F.transform("_dom", lambda x: F.concat(F.lit("classifier-domain:"), x)), F.transform("_met", lambda x: F.concat(F.lit("classifier-method:"), x)))
    )
    none = F.array().cast("array<string>")
    status = F.when(bare.isNull(), "unknown").when(found, "candidate").when(thin, "unknown").otherwise("not_candidate")
    proof = F.when(bare.isNull(), none).when(found, evidence).when(thin, F.array(F.lit("insufficient-or-ambiguous-text"))).otherwise(rule)
    if enrichment:
        missed = ~F.col(enrichment).eqNullSafe(F.lit("enriched"))
        status = F.when(missed, "unknown").otherwise(status)
        proof = F.when(missed, F.array(F.concat(F.lit("enrichment-"), F.coalesce(F.col(enrichment), F.lit("none"))))).otherwise(proof)
    return df.select(*had, status.alias("candidate_status"), proof.alias("candidate_evidence"))


_METHOD = "|".join(f"(?:{p})" for p in P.SELECTOR_METHODS)


def _names_method(s: Column) -> Column:
    return X.has(s, _METHOD) | ((X.has(s, P.AMBIGUOUS_METHOD) | X.has(s, P.DOMAIN_METHOD)) & X.has(s, P.ML_WORDS))


def _novel(s: Column) -> Column:
    """A new or novel method near a method's name, in a sentence that does not just explore known models."""
    claim = F.regexp_substr(s, F.lit(X.FLAGS + P.NOVEL_METHOD))
    start = X.first_at(s, P.NOVEL_METHOD) - 1
    low, high = start - 48, start + F.length(claim) + 48
    near = X.span_touches(s, _METHOD, low, high)
    context = X.has(s, P.ML_WORDS) & (X.span_touches(s, P.AMBIGUOUS_METHOD, low, high) | X.span_touches(s, P.DOMAIN_METHOD, low, high))
    return claim.isNotNull() & ~X.has(s, P.EXPLORES_MODELS) & (near | context)


def _close(*places: Column) -> Column:
    """All found, and their starts within 180 characters."""
    return (F.least(*places) > 0) & (F.greatest(*places) - F.least(*places) <= 180)


def _paper_at(s: Column, more: bool = False) -> Column:
    paper, venue = X.first_at(s, P.PAPER), X.first_at(s, P.VENUE_YEAR)
    last = X.first_at(s, P.SIGGRAPH_YEAR) if more else F.lit(0)
    return F.when(paper > 0, paper).when(venue > 0, venue).otherwise(last)


def _claims_paper(s: Column, more: bool) -> Column:
    return _close(X.first_at(s, P.OFFICIAL_PAPER), _paper_at(s, more), X.first_at(s, P.CODE))


def select(df: DataFrame) -> DataFrame:
    """selection_version, _status (include, review, exclude), _reason and sorted _signals by the strict rule.

    The first of fourteen exits that applies decides. Signals are those that are known where it leaves.
    """
    had = df.columns
    df = _complete(df, "name", "full_name", "description", "topics", "fork", "readme_status", "readme_signals")
    none = F.array().cast("array<string>")
    topics = F.concat_ws(" ", F.col("topics"))
    some_topics = F.when(F.size("topics") > 0, topics)
    desc = F.coalesce(F.col("description"), F.lit(""))
    df = df.withColumns({
        "_name": F.coalesce("full_name", "name", F.lit("")), "_desc": desc, "_topics": topics,
        "_text": X.fold(F.concat_ws(" ", F.coalesce("full_name", "name", F.lit("")), desc, topics)),
        "_active": F.coalesce(F.col("readme_status").isin("ok", "unchanged"), F.lit(False)),
        "_rs": F.coalesce("readme_signals", none), "_fields": F.array_compact(F.array("name", "full_name", "description", some_topics)),
    })
    df = df.withColumns({
        "_sent": F.flatten(F.transform("_fields", X.sentences)), "_dsent": X.sentences(F.col("_desc")), "_gsent": X.guarded_sentences(F.col("_desc")),
        "_nsent": F.flatten(F.transform(F.array_compact(F.array("name", "full_name")), X.sentences)), "_parts": F.split(F.coalesce(X.strip(F.col("_name")), F.lit("")), "/"),
    })
    t = F.col("_text")
    named, titled = _text("name", "full_name", "topics"), _text("name", "full_name", "description")
    df = df.withColumns({
        "_method": F.exists("_sent", _names_method), "_mlc": X.has(t, P.ML_WORDS), "_paper": X.has(t, P.PAPER), "_venue": X.has(t, P.VENUE_YEAR),
        "_nonoff": F.exists("_gsent", lambda s: X.has(s, P.NON_OFFICIAL) & (X.has(s, P.PAPER) | X.has(s, P.VENUE_YEAR))),
        "_novelty": F.exists("_dsent", _novel) | (F.exists("_nsent", _novel) & ~F.exists("_dsent", lambda s: X.has(s, P.EXPLORES_MODELS))),
        "_claim1": F.exists("_gsent", lambda s: _claims_paper(s, False) & (_names_method(s) | (X.has(s, P.ML_WORDS) & X.has(s, P.MODEL_NOUNS_NEAR_ML)))),
        "_claim2": F.exists("_gsent", lambda s: _claims_paper(s, True)) & X.has(named, _METHOD),
        "_tutorial": X.has(named, P.TUTORIAL) | X.has(F.col("_desc"), P.TUTORIAL), "_utility": X.has(t, P.UTILITY_CUE),
        "_review": X.has(t, P.REVIEW_ONLY) | X.has(titled, P.DATASET_WORD), "_back": X.has(t, P.BACKTESTING), "_nonml": X.has(t, P.NON_ML),
        "_explicit": X.has(t, P.EXPLICIT_EXCLUDE), "_survey": X.has(t, P.SURVEY_CUE), "_fork": F.coalesce("fork", F.lit(False)),
    })
    last, before = X.casefold(F.element_at("_parts", -1)), X.casefold(F.try_element_at("_parts", F.lit(-2)))
    same = F.coalesce(last == before, F.lit(False))
    df = df.withColumns({
        "_official": ~F.col("_nonoff") & (F.col("_claim1") | F.col("_claim2")),
        "_course": X.has(t, P.COURSE_CUE) | (X.has(t, P.WORKSHOP) & ~(F.col("_paper") | F.col("_venue") | F.col("_method"))),
        "_same": same, "_dotgithub": (last == ".github") & (F.size("_parts") <= F.when(F.size("_parts") == 1, 1).otherwise(1_000_000)),
    })
    profile = F.col("_dotgithub") | (F.col("_same") & X.has(F.col("_desc"), P.EXPLICIT_PROFILE)) | (F.col("_same") & ~X.has(t, P.SAME_NAME_TECHNICAL) & ~F.col("_official"))
    df = df.withColumns({"_profile": profile, "_aid": F.col("_course") | F.col("_utility"), "_strong": F.col("_novelty") | F.col("_official")})
    sig = lambda label: _in(label, F.col("_rs"))
    relation = sig("paper-code-relationship") | sig("official-implementation-claim")
    negative = sig("course-cue") | sig("reproduction-cue") | sig("survey-cue") | sig("dataset-only-cue")
    fields = F.concat_ws(" ", "_fields")
    topic_text, desc_text = F.translate("_topics", "-_", "  "), X.fold(F.col("_desc"))
    near_code = lambda s: F.coalesce((X.first_at(s, P.CODE_CLAIM) > 0) & (_paper_at(s, True) > 0) & (F.abs(X.first_at(s, P.CODE_CLAIM) - _paper_at(s, True)) <= 180), F.lit(False))
    unguarded = lambda x: F.split(X.fold(x), r"(?<!\d)\.(?!\d)|[!?;\n]+")
    df = df.withColumns({
        "_codepaper": F.exists(F.flatten(F.transform("_fields", unguarded)), near_code), "_topicmethod": X.has(topic_text, _METHOD) | X.has(topic_text, P.GAN_TOPIC),
        "_offimpl": X.has(fields, P.OFFICIAL_IMPLEMENTATION), "_codebase": X.has(fields, P.OFFICIAL_CODEBASE),
        "_codebasepaper": X.has(desc_text, P.OFFICIAL_CODEBASE) & (X.has(desc_text, P.PAPER) | X.has(desc_text, P.VENUE_YEAR)) & X.has(desc_text, _METHOD), "_rel": relation,
    })
    open_ = (~F.col("_nonoff") | F.col("_novelty")) & F.col("_active") & sig("ml-method-context") & ~negative
    paper_support = open_ & sig("paper-reference") & (
        (F.col("_codepaper") & F.col("_topicmethod") & (~F.col("_codebase") | F.col("_rel"))) | (F.col("_codepaper") & F.col("_rel"))
        | (F.col("_offimpl") & sig("method-contribution")) | (F.col("_codebasepaper") & F.col("_rel"))
    )
    alone = open_ & sig("method-contribution") & F.col("_rel")
    course_readme = F.col("_novelty") & F.col("_active") & sig("course-cue") & ~F.col("_official") & ~(sig("paper-reference") | F.col("_rel"))
    why = (
        F.when(F.col("_fork"), "exclude:fork").when(F.col("_explicit"), "exclude:explicit-noncontribution").when(F.col("_survey"), "exclude:survey-or-paper-list-repository")
        .when(F.col("_tutorial"), "exclude:tutorial-repository").when(F.col("_nonml"), "exclude:non-ml-utility").when(F.col("_profile"), "exclude:owner-profile-repository")
        .when(F.col("_back") & F.col("_strong"), "review:non-ml-utility-with-ml-contribution-cue").when(F.col("_back"), "exclude:non-ml-utility")
        .when(F.col("_aid") & ~F.col("_novelty"), "exclude:course-or-utility-repository").when(F.col("_aid"), "review:course-or-utility-with-novel-method-cue")
        .when(course_readme, "review:course-readme-without-official-paper-evidence").when(F.col("_review"), "review:overview-reproduction-or-dataset")
        .when(F.col("_official"), "include:official-paper-method-implementation").when(F.col("_novelty"), "include:specific-method-with-novelty-claim")
        .when(paper_support | alone, "include:readme-supported-paper-method-implementation")
        .when(F.col("_method") | F.col("_mlc") | X.has(t, P.GENERIC_AI), "review:ml-relevance-without-clear-contribution").otherwise("review:insufficient-repository-evidence")
    )
    df = df.withColumn("_why", why)
    early = {"exclude:fork": "fork", "exclude:explicit-noncontribution": "explicit-noncontribution", "exclude:survey-or-paper-list-repository": "survey-or-taxonomy-cue", "exclude:tutorial-repository": "tutorial-cue"}
    own = _tags(*[(F.col("_why") == k, v) for k, v in early.items()])
    late = _tags(
        (F.col("_method"), "ml-method-cue"), (~F.col("_method") & F.col("_mlc"), "ml-context-only"), (X.has(t, P.CONTRIBUTION), "contribution-language"), (F.col("_novelty"), "method-tied-novelty-claim"),
        (F.col("_paper") & X.has(t, P.CODE), "paper-and-code-cue"), (F.col("_official"), "official-paper-implementation-cue"), (F.col("_nonoff"), "non-official-paper-implementation-cue"),
        (F.col("_review"), "overview-reproduction-or-dataset-cue"), (F.col("_course"), "course-cue"), (F.col("_utility"), "workflow-or-index-cue"), (F.col("_back"), "backtesting-utility-cue"),
        (F.col("_nonml"), "non-ml-utility-cue"), (F.col("_why") == "exclude:owner-profile-repository", "owner-profile-repository"),
    )
    signals = F.concat(F.when(F.col("_active"), F.col("_rs")).otherwise(none), F.when(F.col("_why").isin(*early), own).otherwise(late))
    parts = F.split("_why", ":")
    kept = [c for c in had if not c.startswith("selection_")]
    return _once(df, kept, F.lit(P.SELECTION_VERSION).alias("selection_version"), parts[0].alias("selection_status"), parts[1].alias("selection_reason"), X.sorted_set(signals).alias("selection_signals"))


def probable_content(text: Column) -> Column:
    """Sorted cues of probable original content in a text, sentence by sentence; none for null."""
    h = X.has

    def passes(s: Column) -> Column:
        wrapper = h(s, P.P_WRAPPER) & ~h(s, P.P_SUBSTANCE)
        negative = _any(h(s, P.P_NONASSERTION), h(s, P.P_NEGATIVE) & ~h(s, P.P_ADDITION), h(s, P.P_TUTORIAL) & ~h(s, P.P_AUTHORED_TUTORIAL), h(s, P.P_COURSE) & ~h(s, P.P_AUTHORED))
        return h(s, P.P_ML) & ~wrapper & ~negative

    def cues(s: Column) -> Column:
        adapted = F.regexp_substr(s, F.lit(X.FLAGS + P.P_ADAPT))
        makes = h(s, P.P_CREATE)
        return _tags(
            (adapted.isNotNull() & (~h(adapted, P.P_COMPRESS) | h(s, P.P_TARGET)), "adaptation-or-fine-tuning"),
            ((makes & h(s, P.P_MODEL)) | h(s, P.P_NEW_MODEL) | (h(s, P.P_EXTENSION) & h(s, P.P_MODEL)), "original-implementation"),
            (h(s, P.P_APPLY) & h(s, P.P_SUBSTANCE) & h(s, P.P_RELATION), "substantive-application-or-experiments"),
            (h(s, P.P_DATASET) & h(s, P.P_PROTOCOL), "original-dataset-or-benchmark"), (h(s, P.P_TOOL) & h(s, P.P_PURPOSE) & makes, "original-tooling"),
        )

    head = F.substring(F.coalesce(text, F.lit("")), 1, 200_000)
    found = F.flatten(F.transform(F.filter(F.split(head, "(?U)" + P.P_SENTENCES), passes), cues))
    return F.when(h(head, P.P_PROFILE), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(found)))


def readme_blocks(text: Column) -> Column:
    """(blocks: array of (section, paragraph), sections: array) of a cleaned README, in one fold over its lines."""
    lines = F.concat(F.split(text, r"\R|[\x1c-\x1e]"), F.array(F.lit("")))
    heading = r"\A\s*#{1,6}\s+(.+?)\s*#*\s*\z"
    empty = "array<struct<section:string,paragraph:string>>"
    start = F.struct(F.lit("other").alias("now"), F.lit("").alias("para"), F.array().cast(empty).alias("blocks"), F.array().cast("array<string>").alias("sections"))

    def step(a: Column, line: Column) -> Column:
        title = F.regexp_extract(line, heading, 1)
        is_head = line.rlike(heading)
        bare = F.regexp_replace(line, r"(?U)\A\s+|\s+\z", "")
        label = F.lit("other")
        for name, pattern in reversed(P.R_SECTIONS.items()):
            label = F.when(X.has(title, pattern), name).otherwise(label)
        ends = is_head | (bare == "")
        flushed = F.when(ends & (a["para"] != ""), F.concat(a["blocks"], F.array(F.struct(a["now"].alias("section"), a["para"].alias("paragraph"))))).otherwise(a["blocks"])
        para = F.when(ends, "").when(a["para"] == "", bare).otherwise(F.concat_ws(" ", a["para"], bare))
        return F.struct(F.when(is_head, label).otherwise(a["now"]).alias("now"), para.alias("para"), flushed.alias("blocks"), F.when(is_head, F.array_union(a["sections"], F.array(label))).otherwise(a["sections"]).alias("sections"))

    return F.aggregate(lines, start, step)


def readme_evidence(df: DataFrame, text: str = "text") -> DataFrame:
    """readme_evidence_version, readme_signals and readme_sections of README texts; cues must share a paragraph."""
    had = df.columns
    df = df.withColumn("_clean", X.clean_markdown(F.coalesce(F.col(text), F.lit("")))).withColumn("_b", readme_blocks(F.col("_clean")))
    h = X.has

    def cues(b: Column) -> Column:
        p = b["paragraph"]
        ml, paper, code = h(p, P.R_ML) | h(p, P.R_FRAMEWORK), h(p, P.R_PAPER), h(p, P.R_CODE)
        course, again, survey = h(p, P.R_COURSE), h(p, P.R_REPRODUCTION), h(p, P.R_SURVEY)
        own = ml & ~(course | again | survey)
        local = _tags(
            (paper, "paper-reference"), (ml, "ml-method-context"), (course, "course-cue"), (again, "reproduction-cue"), (survey, "survey-cue"), (h(p, P.R_ARTIFACT) & ml, "model-training-artifact"),
            (own & paper & code, "paper-code-relationship"), (own & h(p, P.R_CONTRIBUTION), "method-contribution"), (own & code & h(p, P.R_OFFICIAL), "official-implementation-claim"),
        )
        return F.concat(local, F.when(b["section"].isin("references", "citation"), F.array().cast("array<string>")).otherwise(probable_content(p)))

    blocks = F.col("_b.blocks")
    only = (F.size(blocks) > 0) & F.forall(blocks, lambda b: h(b["paragraph"], P.R_DATASET))
    found = F.concat(F.flatten(F.transform(blocks, cues)), _tags((only, "dataset-only-cue")))
    return df.select(*had, F.lit(P.README_VERSION).alias("readme_evidence_version"), X.sorted_set(found).alias("readme_signals"), F.array_sort("_b.sections").alias("readme_sections"))


def candidate(df: DataFrame) -> DataFrame:
    """candidate_rule_version, _eligible, _reason and _evidence by the broad rule; needs the selector's columns."""
    had = [c for c in df.columns if c not in ("candidate_rule_version", "candidate_eligible", "candidate_reason", "candidate_evidence")]
    df = _complete(df, "description", "fork", "readme_status", "readme_evidence_version", "readme_signals", "readme_sections", "selection_status", "selection_reason", "selection_signals", "evidence_tier", "paper_ids")
    none = F.array().cast("array<string>")
    filled = F.coalesce(X.strip(F.col("description")).isNotNull(), F.lit(False))
    active = F.coalesce(F.col("readme_status").isin("ok", "unchanged") & (F.col("readme_evidence_version") == P.README_VERSION), F.lit(False))
    own = F.transform(probable_content(F.col("description")), lambda x: F.concat(F.lit("description:"), x))
    read = F.transform(F.filter(F.coalesce("readme_signals", none), lambda x: x.isin(*P.PROBABLE)), lambda x: F.concat(F.lit("readme:"), x))
    df = df.withColumns({"_filled": filled, "_active": active, "_ev": F.array_sort(F.array_distinct(F.concat(F.when(filled, own).otherwise(none), F.when(active, read).otherwise(none))))})
    status, reason = F.coalesce("selection_status", F.lit("")), F.coalesce("selection_reason", F.lit(""))
    fork = F.coalesce("fork", F.lit(False)) | (reason == "fork")
    read_section = F.arrays_overlap(F.coalesce("readme_sections", none), F.array(F.lit("method"), F.lit("results")))
    from_readme = F.exists("_ev", lambda x: x.startswith("readme:"))
    excluded = (status == "exclude") & reason.isin(*P.RESCUABLE) & F.when(reason == "non-ml-utility", _in("description:substantive-application-or-experiments", F.col("_ev"))).otherwise(F.col("_active") & read_section & from_readme)
    route = (F.size("_ev") > 0) & (((status == "review") & reason.isin(*P.REVIEWABLE)) | excluded)
    cue = lambda label: _in(label, F.col("selection_signals"))
    papers = F.coalesce((F.size("paper_ids") > 0) & F.forall("paper_ids", lambda x: X.strip(x).isNotNull()), F.lit(False))
    legacy = (
        (status == "review") & (F.size("_ev") == 0) & (reason == "ml-relevance-without-clear-contribution") & F.col("_filled") & cue("ml-method-cue")
        & (cue("paper-and-code-cue") | papers) & F.coalesce(F.col("evidence_tier").isin("direct_ml_text", "ml_related_text"), F.lit(False))
    )
    case = (
        F.when(fork, "fork").when(reason.isin(*P.NEVER_CANDIDATE), "never").when(status == "include", "include").when(~status.isin("review", "exclude"), "none")
        .when(route, "route").when(legacy, "legacy").when(status == "exclude", "left").otherwise("weak")
    )
    df = df.withColumn("_case", case)
    c = F.col("_case")
    said = (
        F.when(c == "fork", "fork").when(c.isin("never", "left"), "not-selected-or-reviewable").when(c == "include", "selected-by-current-rule")
        .when(c == "route", F.concat(F.lit("probable-original-content:"), F.get("_ev", F.lit(0)))).when((c == "legacy") & cue("paper-and-code-cue"), "review-with-repository-evidence")
        .when(c == "legacy", "review-with-unverified-paper-link").otherwise("insufficient-repository-evidence")
    )
    old = F.transform(F.array_intersect(F.coalesce("selection_signals", none), F.array(F.lit("ml-method-cue"), F.lit("paper-and-code-cue"))), lambda x: F.concat(F.lit("selection:"), x))
    proof = F.when(c.isin("route", "left", "weak"), F.col("_ev")).when(c == "legacy", F.array_sort(old)).otherwise(none)
    return _once(df, had, F.lit(P.CANDIDATE_VERSION).alias("candidate_rule_version"), c.isin("include", "route", "legacy").alias("candidate_eligible"), said.alias("candidate_reason"), proof.alias("candidate_evidence"))


def queue_tier(df: DataFrame, prior_signals: str | None = None) -> DataFrame:
    """queue_tier 0 to 5 of the reading queue, or null for rows that are not read.

    prior_signals names an array of signals from an earlier reading of the same name and version.
    """
    had = df.columns
    df = _complete(df, "name", "full_name", "description", "topics", "methods", "fork", "selection_status", "selection_reason", "selection_signals", "evidence_tier")
    none = F.array().cast("array<string>")
    prior = F.coalesce(F.col(prior_signals), none) if prior_signals else none
    probable = F.size(F.array_union(probable_content(F.col("description")), F.array_intersect(prior, F.array(*map(F.lit, P.PROBABLE))))) > 0
    text = X.casefold(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in ("name", "full_name", "description")]))
    owner = F.split(F.coalesce(X.strip(F.coalesce(F.nullif("full_name", F.lit("")), "name")), F.lit("")), "/")
    df = df.withColumns({"_probable": probable, "_text": text, "_parts": owner, "_sig": F.coalesce("selection_signals", none), "_topics": F.coalesce("topics", none)})
    last, before = X.casefold(F.element_at("_parts", -1)), X.casefold(F.try_element_at("_parts", F.lit(-2)))
    profile = F.coalesce((F.size("_parts") >= 2) & ((last == before) | (last == ".github")), F.lit(False))
    some = lambda labels: F.arrays_overlap("_sig", F.array(*map(F.lit, labels)))
    reason = F.coalesce("selection_reason", F.lit(""))
    out = F.coalesce("fork", F.lit(False)) | profile | some(["fork", "owner-profile-repository"]) | reason.isin("fork", "owner-profile-repository")
    negative = (some(P.HARD_NEGATIVE) | reason.isin(*P.HARD_NEGATIVE) | X.has(F.col("_text"), P.QUEUE_NEGATIVE)) & ~F.col("_probable")
    topic = F.exists("_topics", lambda x: X.has(F.replace(x, F.lit("_"), F.lit("-")), P.QUEUE_TOPIC))
    context = F.coalesce(F.col("evidence_tier").isin("direct_ml_text", "ml_related_text"), F.lit(False)) | some(["ml-context-only", "ml-method-cue"]) | topic
    methods = F.coalesce(F.size("methods") > 0, F.lit(False))
    tier = (
        F.when(out | negative, F.lit(None).cast("int")).when(some(["official-paper-implementation-cue", "paper-and-code-cue"]), 0).when(F.col("selection_status") == "include", 1)
        .when(some(P.QUEUE_TARGETS), 2).when(F.col("_probable"), 4).when(X.has(F.col("_text"), P.QUEUE_CODE) & (context | methods), 3)
        .when(context | X.has(F.col("_text"), P.QUEUE_TOPIC) | methods, 5)
    )
    return df.select(*had, tier.alias("queue_tier"))
