"""SQL that another engine runs to the rows of this subpackage's queries, stage by stage as named sub-selects.

Each function gives sub-selects whose names begin with a prefix, reading a relation with the columns of documents; the
last of them, named like the prefix, has the answer. It is brute force: all windows, all pairs that share anything.
"""

from __future__ import annotations

from quarry.llm import decontamination as D, mixing, quality as Q, sharding, substrings

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _grams(p: str, k: int) -> str:
    """{p}_g: (rid, i, g), the windows of k words of {p}_w (rid, w), from 1."""
    return f"{p}_g AS MATERIALIZED (SELECT rid, i, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {k - 2})) AS i FROM {p}_w))"


def quality(p: str, src: str) -> str:
    """doc_id, the statistics and verdicts; rid and the columns of src besides."""
    return rf"""
{p}_d AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM {src}),
{p}_w AS MATERIALIZED (SELECT rid, {_WORDS.format("text")} AS w FROM {p}_d), {_grams(p, Q.WINDOW)},
{p}_c AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM {p}_g), range({Q.WINDOW}) r(o) WHERE n > 1 GROUP BY rid),
{p}_l AS (SELECT rid, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM {p}_d),
{p}_s AS MATERIALIZED (SELECT d.*, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM {p}_d d JOIN {p}_w USING (rid) JOIN {p}_l USING (rid) LEFT JOIN {p}_c USING (rid)),
{p}_b AS MATERIALIZED (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM {p}_s),
{p}_h AS (SELECT source, count(*) AS docs, sum(base_failed::INT) AS failed FROM {p}_b GROUP BY source),
{p}_m AS (SELECT least(greatest(coalesce(avg(failed / docs) FILTER (docs > 1), sum(failed) / sum(docs)), 1e-6), 1 - 1e-6) AS m, var_samp(failed / docs) FILTER (docs > 1) AS v FROM {p}_h),
{p}_k AS (SELECT m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 2 END, 2), 1000) AS k FROM {p}_m),
{p}_r AS (SELECT source, (failed + m * k) / (docs + k) > {Q.HOST_LIMIT} AS host_rejected FROM {p}_h, {p}_k),
{p} AS MATERIALIZED (SELECT b.*, host_rejected, NOT base_failed AND NOT host_rejected AS kept FROM {p}_b b JOIN {p}_r r ON b.source IS NOT DISTINCT FROM r.source)"""


def near_copies(p: str, src: str, k: int, percent: int) -> str:
    """doc_id, n_shingles, component_id; rid and the columns of src besides. All pairs that share a shingle."""
    return f"""
{p}_d AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM {src}),
{p}_w AS MATERIALIZED (SELECT rid, {_WORDS.format(_ASCII_LOWER.format("text"))} AS w FROM {p}_d), {_grams(p, k)},
{p}_s AS MATERIALIZED (SELECT DISTINCT rid, g FROM {p}_g UNION SELECT rid, array_to_string(w, ' ') FROM {p}_w WHERE len(w) BETWEEN 1 AND {k - 1}),
{p}_n AS MATERIALIZED (SELECT rid, count(*) AS n FROM {p}_s GROUP BY rid),
{p}_p AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM {p}_s x JOIN {p}_s y ON x.g = y.g AND x.rid <> y.rid GROUP BY ALL),
{p}_e AS MATERIALIZED (SELECT a, b FROM {p}_p JOIN {p}_n x ON x.rid = a JOIN {p}_n y ON y.rid = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
{p}_t(rid, other) AS (SELECT a, b FROM {p}_e UNION SELECT t.rid, e.b FROM {p}_t t JOIN {p}_e e ON t.other = e.a),
{p}_o AS (SELECT t.rid, min(doc_id) AS low FROM {p}_t t JOIN {p}_d d ON d.rid = t.other GROUP BY t.rid),
{p} AS MATERIALIZED (SELECT d.*, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(low, doc_id), doc_id) AS component_id FROM {p}_d d LEFT JOIN {p}_n USING (rid) LEFT JOIN {p}_o USING (rid))"""


def leaks(p: str, src: str) -> str:
    """doc_id, item_id, similarity, start: the first best window of each leaked item, over all windows of the item's size."""
    k = D.SHINGLE
    words = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    return f"""
{p}_d AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM (SELECT DISTINCT doc_id, text FROM {src})),
{p}_w AS MATERIALIZED (SELECT rid, {words} AS w FROM {p}_d), {_grams(p, k)},
{p}_i_w AS MATERIALIZED (SELECT row_number() OVER () AS rid, item_id, w FROM (SELECT DISTINCT item_id, {words} AS w FROM benchmark)), {_grams(f"{p}_i", k)},
{p}_ig AS MATERIALIZED (SELECT rid AS item, g, count(*) AS n FROM {p}_i_g GROUP BY ALL),
{p}_hits AS MATERIALIZED (SELECT d.rid, item, d.g, d.i - 1 AS pos, n FROM {p}_g d JOIN {p}_ig USING (g)),
{p}_at AS (SELECT h.*, len(b.w) AS size, len(w.w) AS words, unnest(range(greatest(0, pos - len(b.w) + {k}), least(pos, greatest(0, len(w.w) - len(b.w))) + 1)) AS start
  FROM {p}_hits h JOIN {p}_i_w b ON b.rid = item JOIN {p}_w w ON w.rid = h.rid),
{p}_c AS (SELECT rid, item, start, size, words, least(count(*), any_value(n)) AS c FROM {p}_at GROUP BY rid, item, start, size, words, g),
{p}_j AS (SELECT rid, item, start, sum(c)::BIGINT AS c, any_value(least(words, size) - {k - 1} + size - {k - 1}) AS sizes FROM {p}_c GROUP BY rid, item, start),
{p}_good AS (SELECT rid, item, start, c / (sizes - c) AS similarity FROM {p}_j WHERE 100 * c >= {D.PERCENT} * (sizes - c)),
{p}_all AS (SELECT d.doc_id, d.rid, b.item_id, similarity, start FROM {p}_good g JOIN {p}_d d USING (rid) JOIN {p}_i_w b ON b.rid = item),
{p} AS MATERIALIZED (SELECT doc_id, item_id, max(similarity) AS similarity, arg_max(start, [similarity, -start])::INT AS start FROM {p}_all GROUP BY doc_id, rid, item_id)"""


def _shard(key: str, n: int) -> str:
    """The shard of a key among n of equal weight: the largest of their scores, the first on a tie."""
    digest = f"('0x' || substr(md5(coalesce({key}::VARCHAR, 'null') || '#' || i), 1, 13))::BIGINT"
    return f"list_extract(list_sort(list_transform(range({n}), lambda i: {{'s': ln(({digest} + 0.5) / {1 << 52}), 'i': -i}}), 'DESC'), 1)"


def sharded(key: str, n: int) -> str:
    return f"(-({_shard(key, n)}).i)::INT"


def sharding_sql() -> str:
    """Shards, slots and checksums; the checksum goes byte by byte with a table from its polynomial."""
    n = sharding.SHARDS
    return f"""
WITH t AS (SELECT list(c ORDER BY k) AS t FROM (SELECT k, list_reduce(list_prepend(k, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) AS c FROM (SELECT unnest(range(256)) AS k))),
d AS (SELECT doc_id, coalesce(text, '') AS text, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size FROM documents),
b AS (SELECT d.*, t, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM d, t),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM b),
s AS (SELECT *, {sharded("doc_id", n)} AS shard, {sharded("doc_id", n + 1)} AS grown_shard FROM c)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard FROM s"""


def substrings_sql() -> str:
    k = substrings.WINDOW
    return f"""
WITH x_w AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("text")} AS w FROM documents), {_grams("x", k)},
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS n FROM x_g) WHERE n > 1),
gone AS MATERIALIZED (SELECT DISTINCT rid, i + o AS j FROM r, range({k}) q(o)),
words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM x_w),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY j) AS text FROM words ANTI JOIN gone USING (rid, j) GROUP BY rid),
n AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM x_w LEFT JOIN n USING (rid) LEFT JOIN kept USING (rid)"""


ORACLES = {
    "op4_ngram_jaccard_join": f"WITH RECURSIVE {near_copies('x', 'documents', 4, 85)} SELECT doc_id, n_shingles, component_id FROM x",
    "op5_quality_rules": f"WITH {quality('x', 'documents')} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected, kept FROM x",
    "op6_sharding": sharding_sql(),
    "op7_mixing": mixing.ORACLE_SQL,
    "op9_substring_dedup": substrings_sql(),
    "op10_decontamination": f"WITH {leaks('x', 'documents')} SELECT doc_id, item_id, similarity, start FROM x",
}

_DOC = "doc_id, text, lang, source, n_chars"
PIPELINE = f"""WITH RECURSIVE {quality('q', 'documents')}, q_kept AS MATERIALIZED (SELECT {_DOC} FROM q WHERE kept),
{near_copies('c', 'q_kept', 5, 80)}, c_kept AS MATERIALIZED (SELECT {_DOC} FROM c WHERE doc_id = component_id),
{leaks('l', 'c_kept')}, l_kept AS MATERIALIZED (SELECT {_DOC} FROM c_kept WHERE doc_id NOT IN (SELECT doc_id FROM l)),
{mixing.sql('l_kept', 80, 1)}
SELECT {_DOC}, {sharded('doc_id', sharding.SHARDS)} AS shard FROM l_kept JOIN (SELECT DISTINCT doc_id FROM mixed) USING (doc_id)"""
