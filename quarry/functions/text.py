"""Text, time and link functions as columns; all of them run on the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Ignore case and read \w, \b and \s as Unicode does; "." stops at \n alone.
FLAGS = "(?iuUd)"


def has(text: Column, pattern: str) -> Column:
    """Whether the pattern occurs; false for null."""
    return F.coalesce(text.rlike(FLAGS + pattern), F.lit(False))


def casefold(text: Column) -> Column:
    """Lower case, with the letters that fold to others: sharp s and final sigma."""
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def fold(text: Column) -> Column:
    """Lower case with hyphens and underscores as spaces."""
    return F.translate(casefold(text), "-_", "  ")


def strip(text: Column) -> Column:
    """Without Unicode white space at the ends; empty becomes null."""
    return F.nullif(F.regexp_replace(text, r"(?U)\A\s+|\s+\z", ""), F.lit(""))


def method_slug(text: Column) -> Column:
    """Lower case, runs of other than letters and digits as one hyphen, none at the ends."""
    dashed = F.replace(F.regexp_replace(casefold(text), r"(?U)[^\w]+", "-"), F.lit("_"), F.lit("-"))
    return F.trim(dashed, F.lit("-"))


def sorted_set(values: Column) -> Column:
    """Distinct values in code point order; null members dropped; null array as empty."""
    return F.array_sort(F.array_distinct(F.array_compact(F.coalesce(values, F.array().cast("array<string>")))))


def sentences(text: Column) -> Column:
    return F.split(fold(text), r"[.!?;\n]+")


def guarded_sentences(text: Column) -> Column:
    """Split at full stops too, but not in numbers or after impl., e.g. and i.e."""
    return F.split(F.regexp_replace(fold(text), r"(?U)\b(impl|e\.g|i\.e)\.", "$1"), r"(?<!\d)\.(?!\d)|[!?;\n]+")


def first_at(text: Column, pattern: str) -> Column:
    """Where the pattern first occurs, from 1; 0 if nowhere."""
    return F.regexp_instr(text, F.lit(FLAGS + pattern))


def span_touches(text: Column, pattern: str, low: Column, high: Column) -> Column:
    """Whether any match of the pattern starts at high or before and ends at low or after (from 0, in code points).

    Matches are marked, the text is cut at the marks, and one fold adds the lengths up.
    """
    parts = F.split(F.regexp_replace(text, FLAGS + "(" + pattern + ")", "\u0001$0\u0002"), "\u0001")
    start = F.struct(F.length(F.element_at(parts, 1)).alias("at"), F.lit(False).alias("hit"))

    def step(acc: Column, part: Column) -> Column:
        size = F.instr(part, "\u0002") - 1
        touch = (acc["at"] <= high) & (acc["at"] + size >= low)
        return F.struct((acc["at"] + F.length(part) - 1).alias("at"), (acc["hit"] | touch).alias("hit"))

    return F.coalesce(F.aggregate(F.slice(parts, 2, F.size(parts)), start, step)["hit"], F.lit(False))


def clean_markdown(text: Column, limit: int = 200_000) -> Column:
    """Markup removed, link texts and targets kept, block tags as line breaks."""
    steps = [
        (r"(?s)```.*?```|~~~.*?~~~", "\n"),
        (r"(?is)<a\b[^>]*href\s*=\s*(['\"])(.*?)\1[^>]*>(.*?)</a>", "$3 $2"),
        (r"(?i)</?(?:p|div|h[1-6]|br|li|tr)\b[^>]*>", "\n"),
        (r"(?s)<[^>]+>", " "),
        (r"(?md)^\s*<[^>]+>\s*$", "\n"),
        (r"!\[([^]]*)\]\([^)]*\)", "$1"),
        (r"\[([^]]+)\]\(([^)]+)\)", "$1 $2"),
        (r"<((?:https?://)[^>]+)>", "$1"),
        (r"(?md)^\s*>\s?", ""),
    ]
    out = F.substring(text, 1, limit)
    for pattern, replacement in steps:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def unix_micros(stamp: Column, naive: str = "reject") -> Column:
    """An ISO time as UTC microseconds; null if it is none. naive: "reject", or "utc" for times without a zone."""
    zone = r"(?:[zZ]|[+-]\d{2}:?\d{2})" + ("?" if naive == "utc" else "")
    shape = r"\A\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?" + zone + (r")?\z" if naive == "utc" else r")\z")
    return F.when(stamp.rlike(shape), F.unix_micros(F.try_to_timestamp(F.replace(stamp, F.lit(","), F.lit(".")))))


def end_of_day(bound: Column) -> Column:
    """A date as the last second of its day, a time as it is."""
    day = bound.rlike(r"\A\d{4}-\d{2}-\d{2}\z")
    return F.when(day, F.try_to_timestamp(F.concat(bound, F.lit(" 23:59:59")))).otherwise(F.try_to_timestamp(bound))


def page_cap(total: Column, per_page: int, most: int = 1000) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.least(total, F.lit(most)) / per_page)).cast("int")


def halves(start: Column, end: Column) -> Column:
    """A date range as its two halves, or as it is if it is one day."""
    middle = F.date_add(start, F.floor(F.datediff(end, start) / 2).cast("int"))
    pair = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    return F.when(start < end, F.array(pair(start, middle), pair(F.date_add(middle, 1), end))).otherwise(F.array(pair(start, end)))


def case_id(seed: Column, kind: Column, key: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", seed.cast("string"), kind, key.cast("string")), 256), 1, 20)


# The forms of owner and repository names.
OWNER, REPOSITORY, COMPONENT = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,37}[A-Za-z0-9])?", r"[A-Za-z0-9_.-]+", r"[A-Za-z0-9_.-]+"


def strict_repository(url: Column, host: str = r"(?:www\.)?github\.com") -> Column:
    """owner/repository of an https address of a repository root, tree or blob; else null."""
    shape = rf"\A(?i:https)://(?i:{host})/({OWNER})/({REPOSITORY})(?:/(?:tree|blob)(?:/(?!\.{{1,2}}(?:/|\z))[A-Za-z0-9._-]+)+)?/?\z"
    raw = F.regexp_extract(url, shape, 2)
    name = F.regexp_replace(raw, r"\.git\z", "")
    good = lambda c: (c != "") & ~c.rlike(r"\A\.|\.\z")
    return F.when(url.rlike(shape) & good(raw) & good(name), F.concat_ws("/", F.regexp_extract(url, shape, 1), name))


def loose_repository(url: Column, host: str = r"(?:www\.)?github\.com") -> Column:
    """owner/repository of any common address or clone form, whatever follows; else null."""
    text = strip(url)
    ssh = r"\Agit@github\.com:(.*)\z"
    http = rf"\A(?:(?i:https?|ssh|git)://)?(?:[^/@?#]*@)?(?i:{host})(?::\d*)?(/[^?#]*)?(?:[?#].*)?\z"
    path = F.when(text.rlike(ssh), F.regexp_extract(text, ssh, 1)).when(text.rlike(http), F.regexp_extract(text, http, 1))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    part = lambda i: F.try_url_decode(F.replace(F.get(parts, F.lit(i)), F.lit("+"), F.lit("%2B")))
    owner, name = part(0), F.regexp_replace(part(1), r"(?i)\.git\z", "")
    good = lambda c: c.rlike(rf"\A{COMPONENT}\z") & ~c.isin(".", "..")
    return F.when(good(owner) & good(name), F.concat_ws("/", owner, name))


def evidence_url(url: Column, denied: tuple[str, ...] = ("paperswithcode.com",)) -> Column:
    """Whether an address is absolute, http or https, without user info and not on a denied host."""
    host = F.regexp_extract(url, r"\A(?i:https?)://([^/?#@:]+)(?::\d+)?(?:[/?#].*)?\z", 1)
    name = F.regexp_replace(F.lower(host), r"\.+\z", "")
    bad = F.lit(False)
    for d in denied:
        bad = bad | (name == d) | name.endswith("." + d)
    return F.coalesce((host != "") & ~bad, F.lit(False))


def decoded_size(content: Column) -> Column:
    """Bytes of a base64 text; null if it is none."""
    return F.length(F.try_to_binary(F.regexp_replace(content, r"\s", ""), F.lit("base64")))
