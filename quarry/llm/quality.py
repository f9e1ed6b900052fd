"""Quality rules: per-document rules, and verdicts on hosts from their documents' failures.

Two scans of the texts and no shuffle of them: the first counts failures by host (partial sums, so one hot host
is a row a task), the second applies the rules again together with the hosts' verdicts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm import common as C

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
#: A host's documents all fail if more than this share of them is expected to, after shrinking.
HOST_LIMIT = 0.8
#: Up to so many rejected hosts are broadcast; beyond that the join is dealt out with salted keys.
BROADCAST_HOSTS, SALTS = 100_000, 32


def _repeats(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each (doc, h) occurs more than once, and whether it is not the first such; doc ascends."""
    order = np.lexsort((h, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (h[order][1:] == h[order][:-1])
    twice, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    later[order[1:]] = same
    return np.stack((twice, later))


def document_stats(texts: pa.Array) -> pa.RecordBatch:
    """The columns of STATS for each text; a null text has no words, lines or symbols and fails."""
    out = []
    for c in C.chunks(texts):
        doc = c.doc_of_word()
        h, at = C.grams(c.hashes(), c.word_at, WINDOW)
        cover = np.zeros(len(c.starts) + WINDOW + 1, np.int32)
        hit = at[_repeats(doc[at], h)[0]]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
        covered = np.cumsum(cover)[: len(c.starts)] > 0
        # lines: cut at \n and at documents' ends; those without a word don't count
        cuts = np.unique(np.concatenate((np.flatnonzero(c.data == 10) + 1, c.at)))
        s, e = cuts[:-1], cuts[1:].copy()
        e -= (c.data[e - 1] == 10) if len(e) else 0
        some = np.searchsorted(c.starts, e) > np.searchsorted(c.starts, s)
        s, e = s[some], e[some]
        line_doc = np.searchsorted(c.at, s, side="right") - 1
        later = _repeats(line_doc, C.hash_spans(c.data, s, e))[1]
        inside = np.zeros(len(c.data) + 1, np.int8)
        inside[c.starts] += 1
        np.add.at(inside, c.ends, -1)
        chars = (np.cumsum(inside)[:-1] > 0) & ((c.data & 0xC0) != 0x80)
        n, rep = c.n_words, c.per_doc(covered, c.word_at)
        lines = np.bincount(line_doc[later], minlength=c.last - c.first)
        bad = (n < MIN_WORDS) | (100 * rep > MAX_REPEAT_PERCENT * n)
        out.append([n, c.per_doc(chars, c.at), c.per_doc(_SYMBOL[c.data], c.at), lines, rep, bad])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[]] * 6
    kinds = [pa.int64()] * 5 + [pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)


def host_verdicts(tallies: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, docs, failed, expected, rejected) from (host, docs, failed).

    A beta prior over the hosts' rates comes from their mean and variance (method of moments, unweighted over
    hosts with more than one document). Where the variance leaves no prior (one host, or all alike), it counts
    as two documents at the mean rate. A host is rejected if its posterior mean exceeds the limit, so that few
    failures of a small host do not condemn it.
    """
    rate = F.col("failed") / F.col("docs")
    several = F.when(F.col("docs") > 1, rate)
    prior = tallies.agg(F.coalesce(F.avg(several), F.sum("failed") / F.sum("docs")).alias("m"), F.var_samp(several).alias("v")).first()
    m = min(max(prior.m or 0.0, 1e-6), 1 - 1e-6)
    strength = m * (1 - m) / prior.v - 1 if prior.v else 2.0
    strength = min(max(strength, 2.0), 1000.0)
    posterior = (F.col("failed") + F.lit(m * strength)) / (F.col("docs") + F.lit(strength))
    return tallies.withColumn("expected", posterior).withColumn("rejected", posterior > F.lit(limit))


def tally(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    def count(batches):
        for b in batches:
            bad = document_stats(b.column(1)).column(5).cast(pa.int64())
            t = pa.table({"host": b.column(0).cast(pa.string()), "failed": bad, "docs": pa.array(np.ones(len(b), np.int64))})
            t = t.group_by("host").aggregate([("docs", "sum"), ("failed", "sum")])
            yield from t.select(["host", "docs_sum", "failed_sum"]).rename_columns(["host", "docs", "failed"]).to_batches()

    some = docs.select(F.col(host).cast("string"), F.col(text)).mapInArrow(count, "host string, docs long, failed long")
    return some.groupBy("host").agg(F.sum("docs").alias("docs"), F.sum("failed").alias("failed"))


def annotate(docs: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None) -> DataFrame:
    """The columns in carry (all, if None) of each row, then struct quality with STATS, host_rejected and kept.

    Null or empty texts fail the base rules; rows without a host form one host; repeated rows each count; an
    empty table gives no rows. A column quality of docs is replaced; all others may have any names.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() != "quality"]
    return _annotated(docs, text, host, carry).select("row.*", "quality")


def _annotated(docs: DataFrame, text: str, host: str, carry: list[str]) -> DataFrame:
    """(row, quality): the columns in carry as one, and the verdict."""
    bad = C.materialise(host_verdicts(C.materialise(tally(docs, text, host))).where("rejected").select(F.struct("host").alias("h")))
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(host).cast("string").alias("host"), F.col(text).alias("text"))

    def stats(batches):
        for b in batches:
            q = document_stats(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("host"), pa.StructArray.from_arrays(q.columns, q.schema.names)], ["row", "host", "q"])

    scored = source.mapInArrow(stats, C.schema_of(source, ["row", "host"], f"q struct<{STATS.replace(' long', ':long').replace(' boolean', ':boolean')}>"))
    if bad.count() <= BROADCAST_HOSTS:
        joined = scored.join(F.broadcast(bad), scored.host.eqNullSafe(F.col("h.host")), "left")
    else:
        salted = bad.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = scored.withColumn("salt", F.pmod(F.xxhash64("row", "host"), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, (dealt.salt == salted.salt) & dealt.host.eqNullSafe(salted.h.host), "left")
    rejected = F.col("h").isNotNull()
    quality = F.struct(F.col("q.*"), rejected.alias("host_rejected"), (~F.col("q.base_failed") & ~rejected).alias("kept"))
    return joined.select("row", quality.alias("quality"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows that pass, with their own columns, whatever their names; for odd rows see annotate."""
    return _annotated(docs, text, host, docs.columns).where("quality.kept").select("row.*")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The statistics and verdicts of all documents: (doc_id, STATS..., host_rejected, kept); see annotate.

    Null and empty texts have no words and fail; rows without a source form one host; repeated rows each count; an empty table gives no rows.
    """
    return annotate(C.small(C.table(spark, sf_dir, "documents").select("doc_id", "text", "source")), carry=["doc_id"]).select("doc_id", "quality.*")
