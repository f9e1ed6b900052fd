"""HTML extraction with a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags. A block is described by the hashed names
on its tag path (tags, words of class, id and role), the hashed words of its text, and a few counts. A
bidirectional LSTM in numpy reads the page's blocks in order and labels each as main text or not, so every
label depends on the whole page. It is trained when first needed, on TRAIN_PAGES invented pages of
known structure (a documented bound; there are no labels for real pages), always the same way.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm import common as C

TRAIN_PAGES, EPOCHS, SEED = 2500, 8, 11
PATHS, WORDS, PATH_DIM, WORD_DIM, COUNTS, HIDDEN = 2048, 4096, 16, 4, 8, 20

_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html label legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead tr ul video audio iframe input".split()
)
_VOID = {"hr", "br", "input", "img", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track"}
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = _BLOCK - {"button", "label", "option", "input", "select", "textarea", "video", "audio", "iframe"}
#: Elements whose contents are no text of the page. The text of noscript and math is.
_RAW = {"script", "style", "template", "title", "iframe", "svg"}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRS = re.compile(r"(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
#: After so many quotes that nothing closes, a page's tags end at the next ">", so that the scan stays linear.
OPEN_QUOTES = 32
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PART = re.compile(r"[a-z0-9]+")


@lru_cache(maxsize=100_000)
def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % PATHS


@lru_cache(maxsize=50_000)
def _own_names(tag: str, attrs: str) -> tuple[str, ...]:
    parts = [p for m in _NAMES.finditer(attrs) for p in _PART.findall(m[2].lower())]
    return (f"t:{tag}", *(f"c:{p.rstrip('s') or p}" for p in parts if not p.isdigit()))


@lru_cache(maxsize=16)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.I)


def tokens(page: str):
    """(kind, name, text): "text", or "open" and "close" with the tag's lower-case name and its attributes, in one pass.

    Comments, declarations and the contents of raw elements are left out; a self-closed svg has none. What is never
    closed ends with the page; "<" that begins no tag is text.
    """
    at, n, quotes = 0, len(page), 0
    last = page.rfind(">")  # no tag ends behind it
    while at < n:
        cut = page.find("<", at)
        if cut < 0:
            yield "text", "", page[at:]
            return
        if cut > at:
            yield "text", "", page[at:cut]
        if page.startswith("<!--", cut):
            end = page.find("-->", cut + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith("<![CDATA[", cut):
            end = page.find("]]>", cut)
            yield "text", "", page[cut + 9 : n if end < 0 else end]
            at = n if end < 0 else end + 3
            continue
        shut = page.startswith("/", cut + 1)
        name = _NAME.match(page, cut + 1 + shut) if last > cut else None
        if not name:
            end = page.find(">", cut) if last > cut and page[cut + 1 : cut + 2] in ("!", "?", "/") else -1
            if end < 0:
                yield "text", "", "<"
            at = cut + 1 if end < 0 else end + 1
            continue
        begin = name.end()
        found = _ATTRS.match(page, begin) if quotes < OPEN_QUOTES else None
        quotes += found is None
        end = found.end() if found else page.find(">", begin) + 1
        tag, attrs = name[0].lower(), page[begin : end - 1]
        at = end
        if not shut and tag in _RAW and not (tag == "svg" and attrs.endswith("/")):
            over = _end_of(tag).search(page, end)
            at = over.end() if over else n
        if shut or tag != "svg" and tag not in _RAW or tag == "iframe":
            yield "close" if shut else "open", tag, attrs


def blocks(page: str) -> list[tuple[str, frozenset, float]]:
    """(text, slots of the path's names, share of its characters in links) of each block that has text.

    Character references are decoded, white space is one space. Whatever the markup, nothing is lost but tags,
    comments, and the contents of script, style, title, svg and the like (a self-closed svg has none; formulas of math
    elements and what noscript shows are text). Tags that are not closed end with their parent.
    """
    out, stack, run, in_link, depth_a = [], [("", ())], [], 0, 0

    def flush():
        nonlocal in_link
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                names = {_slot(n) for _, some in stack for n in some} | {_slot("l:" + stack[-1][0])}
                out.append((text, frozenset(names), min(1.0, in_link / len(text))))
            run.clear()
        in_link = 0

    for kind, tag, text in tokens(page):
        if kind == "text":
            run.append(text)
            if depth_a:
                in_link += len(text.strip())
            continue
        if tag == "a":
            depth_a = 1 if kind == "open" else 0
        if tag == "br":
            run.append(" ")
        if tag not in _BLOCK:
            continue
        flush()
        depth_a = 0
        if kind == "close":
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        else:
            shut = _CLOSES.get(tag, {"p"} if tag in _ENDS_P else set())
            while len(stack) > 1 and stack[-1][0] in shut:
                stack.pop()
            if tag not in _VOID and tag != "iframe":
                stack.append((tag, _own_names(tag, text)))
    flush()
    return out


# Invented pages of known structure.

_ROLES = {
    "nav": (["nav", "ul", "div"], ["nav", "navbar", "menu", "navigation", "breadcrumb", "topbar", "links", "main-menu"]),
    "header": (["header", "div"], ["header", "masthead", "site-header", "banner", "branding", "logo", "topbar"]),
    "footer": (["footer", "div"], ["footer", "copyright", "colophon", "bottom", "site-footer", "legal"]),
    "side": (["aside", "div", "section"], ["sidebar", "aside", "widget", "related", "rail", "secondary", "recommended", "trending", "more-stories", "tags", "share", "social"]),
    "ad": (["div", "aside", "section", "ins"], ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "ad-slot", "adbox"]),
    "notice": (["div", "section", "dialog"], ["cookie", "notice", "consent", "alert", "gdpr", "popup", "modal", "cookie-banner", "disclaimer", "warning", "paywall"]),
    "form": (["form", "div"], ["form", "search", "newsletter", "subscribe", "login", "signup", "contact-form"]),
    "comments": (["div", "section", "ol"], ["comments", "comment-list", "discussion", "replies", "respond", "reader-comments", "feedback", "reviews", "thread"]),
}
#: Words that tell a role when they are there.
_TOLD = {
    "nav": "home about contact menu news", "header": "welcome home", "footer": "copyright rights reserved terms privacy", "side": "related popular trending tags share more", "ad": "sponsored advertisement buy offer sale",
    "notice": "cookies cookie consent accept policy notice enable javascript browser", "form": "subscribe newsletter email login search send", "comments": "comment comments reply said posted replies",
}
_MAIN = ["content", "main", "post", "article", "entry", "entry-content", "body", "story", "article-body", "post-content", "text", "page-content"]
_PLAIN = ["wrap", "container", "row", "col", "inner", "page", "layout", "grid", "box", "x1", "section"]
_SYLLABLES = "an ba che de el fi gra ho in ka lo mer no op que ri son tu ver wi zo é ü ción sch".split()


def _say(rng: random.Random, low: int, high: int) -> str:
    words = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
    if rng.random() < 0.15:  # junk marks say nothing about a block's role
        mark = rng.choice(["!!", "***", "###", "&amp;&amp;", ",", "|", ":"])
        words = [w + mark for w in words]
    return " ".join(words).capitalize() + rng.choice(["", ".", ".", "!", "&amp;", " &middot; x"])


def invented_page(rng: random.Random) -> tuple[str, list[str]]:
    """A page and the texts of its main blocks, in order."""
    main: list[str] = []

    def attr(names):
        kind = rng.random()
        return "" if kind < 0.25 else f' {rng.choice(["class", "class", "id"])}="{rng.choice(names)}{rng.choice(["", "", " " + rng.choice(_PLAIN), "-1"])}"'

    def keep(tag, low, high, extra=""):
        text = _say(rng, low, high)
        if rng.random() < 0.2:  # an article may speak of cookies
            text = " ".join([*rng.choices(" ".join(_TOLD.values()).split(), k=rng.randint(1, 3)), text] if rng.random() < 0.5 else [text, rng.choice(" ".join(_TOLD.values()).split())])
        main.append(" ".join(entities.unescape(text).split()))
        cut = text.find(" ")
        shown = text if cut < 0 or rng.random() < 0.6 else f"<b>{text[:cut]}</b>{text[cut:]}" if rng.random() < 0.5 else f'<a href="/q">{text[:cut]}</a>{text[cut:]}'
        if rng.random() < 0.1:
            return f"<{tag}{extra}><b>{text}<br>"
        return f"<{tag}{extra}>{shown}" + ("" if tag in ("p", "li") and rng.random() < 0.2 else f"</{tag}>")

    def article():
        parts = [keep("h1", 2, 12)] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, rng.choice([2, 6, 6, 12, 12, 25, 80]))):
            kind = rng.random()
            if kind < 0.68:
                parts.append(keep("p", rng.choice([1, 5, 20]), 60))
            elif kind < 0.76:
                parts.append(keep(rng.choice(["h2", "h3", "h4"]), 1, 8))
            elif kind < 0.84:
                parts.append("<ul>" + "".join(keep("li", 1, 12) for _ in range(rng.randint(1, 4))) + "</ul>")
            elif kind < 0.88:
                parts.append("<blockquote>" + keep("p", 4, 30) + "</blockquote>")
            elif kind < 0.91:
                parts.append(keep("pre", 2, 20))
            elif kind < 0.94:
                parts.append("<table><tr>" + keep("td", 1, 6) + keep("td", 1, 6) + "</tr></table>")
            else:
                parts.append(noise(rng.choice(["ad", "ad", "side", "notice", "form"])))
        if rng.random() < 0.25:
            parts.append(noise("comments"))
        body = "".join(parts)
        kind = rng.random()
        if kind < 0.5:
            return f"<article{attr(_MAIN)}>{body}</article>"
        if kind < 0.68:
            return f"<main{attr(_MAIN)}>{body}</main>"
        if kind < 0.9:
            tag = "div" if kind < 0.82 else "section"
            return f'<{tag} {rng.choice(["class", "id"])}="{rng.choice(_MAIN)}">{body}</{tag}>'
        return f"<div>{body}</div>" if kind < 0.93 else body

    def noise(role):
        tags, names = _ROLES[role]
        tag = rng.choice(tags)
        named = tag in ("nav", "header", "footer", "aside", "form")
        name = f' {rng.choice(["class", "class", "id"])}="{rng.choice(names)}"' if not named or rng.random() < 0.4 else ""
        told = _TOLD[role].split()

        def say(low, high):
            words = _say(rng, low, high).split(" ")
            for _ in range(rng.choice([0, 0, 1, 2])):
                words.insert(rng.randint(0, len(words)), rng.choice(told))
            return " ".join(words)

        link = lambda low, high: f'<a href="/{rng.randint(1, 99)}">{say(low, high)}</a>'
        if role in ("nav", "side") and rng.random() < 0.8:
            items = "".join(f"<li>{link(1, 3 if role == 'nav' else 9)}</li>" for _ in range(rng.randint(2, 8)))
            inner = items if tag == "ul" else f"<ul>{items}</ul>" if rng.random() < 0.7 else "".join(link(1, 3) + " " for _ in range(4))
            inner = (f"<h3>{say(1, 4)}</h3>" if role == "side" else "") + inner
        elif role == "form":
            inner = f"<label>{say(1, 4)}</label><input type=text><select><option>{say(1, 2)}<option>{say(1, 2)}</select><button>{say(1, 3)}</button>" + (f"<p>{say(3, 14)}</p>" if rng.random() < 0.5 else "")
        elif role == "comments":
            item, kind = rng.choice(["div", "li", "article"]), rng.choice(["comment", "reply", "comment-body", "review"])
            inner = f"<h3>{say(1, 4)}</h3>" + "".join(f'<{item} class="{kind}"><p>{say(3, 40)}</p></{item}>' for _ in range(rng.randint(1, 5)))
        elif role == "footer":
            inner = f"&copy; {say(1, 4)} &middot; {say(1, 12)}" if rng.random() < 0.6 else f"<p>{say(2, 20)}</p>" + link(1, 3)
        elif role == "header":
            inner = f"<h1>{say(1, 4)}</h1>" * (rng.random() < 0.3) + f"<p>{say(1, 8)}</p>" * (rng.random() < 0.5) + link(1, 3)
        else:
            inner = f"<p>{say(2, 25)}</p>" * rng.randint(1, 2) if rng.random() < 0.5 else say(2, 25)
            if role == "notice" and rng.random() < 0.15:
                return f"<noscript>{inner}</noscript>" if rng.random() < 0.5 else f"<noscript><{tag}{name}>{inner}</{tag}></noscript>"
        return f"<{tag}{name}>{inner}</{tag}>"

    before = [noise(r) for r in ("nav", "header", "ad", "notice", "form", "side") if rng.random() < 0.5]
    after = [noise(r) for r in ("side", "ad", "comments", "form", "footer", "notice") if rng.random() < 0.5]
    rng.shuffle(before)
    if rng.random() < 0.08:
        before, after = [], []
    middle = article()
    if rng.random() < 0.06:  # columns of a table
        role = rng.choice(["nav", "side", "ad"])
        beside = f'<td class="{rng.choice(_ROLES[role][1])}">{noise(role)}</td>' if rng.random() < 0.5 else f'<td class="{rng.choice(_ROLES[role][1])}"><a href="/1">{_say(rng, 1, 4)}</a><br><a href="/2">{_say(rng, 1, 4)}</a></td>'
        middle = f'<table><tr>{beside}<td class="{rng.choice(_MAIN)}">{middle}</td></tr></table>'
    body = "<!-- x -->".join([*before, middle, *after])
    for _ in range(rng.choice([0, 0, 1, 2])):
        body = f"<div{attr(_PLAIN)}>{body}</div>"
    return f"<!DOCTYPE html><html><head><title>{_say(rng, 2, 6)}</title><script>var a='</p>';</script></head><body>{body}</body></html>", main


# The network.


def describe(pages: list[list[tuple]]) -> list[tuple]:
    """(slots, where they begin, word rows, counts) of each page's blocks."""
    texts = pa.array([t for p in pages for t, _, _ in p], pa.large_string())
    rows = []
    for c in C.chunks(texts, lower=True):
        h = (c.hashes() % C.U64(WORDS)).astype(np.int64)
        rows.append((h, c.n_words))
    flat = np.concatenate([h for h, _ in rows]) if rows else np.zeros(0, np.int64)
    n = np.concatenate([k for _, k in rows]) if rows else np.zeros(0, np.int64)
    at = np.concatenate(([0], np.cumsum(n)))
    out, i = [], 0
    for p in pages:
        k = len(p)
        lens = np.array([len(t) for t, _, _ in p], float)
        marks = np.array([sum(map(t.count, ".,;:!?")) for t, _, _ in p], float)
        links = np.array([x for _, _, x in p])
        place = np.arange(k) / max(1, k)
        counts = np.stack([np.log1p(lens) / 8, np.log1p(n[i : i + k]) / 6, links, (links > 0.8).astype(float), place, 1 - place, np.minimum(marks, 20) / 20, (lens > 200).astype(float)], 1)
        out.append(([sorted(s) for _, s, _ in p], flat[at[i] : at[i + k]], n[i : i + k], counts.astype(np.float32)))
        i += k
    return out


def _slots_of(words: str) -> np.ndarray:
    return np.concatenate([c.hashes() % C.U64(WORDS) for c in C.chunks(pa.array([words]))]).astype(np.int64)


def renamed(page: tuple, r: np.random.Generator) -> tuple:
    """The page with other invented words in place of its own; words that tell a role stay."""
    slots, words, n, counts = page
    return slots, np.where(np.isin(words, _slots_of(" ".join(_TOLD.values()))), words, r.integers(0, WORDS, len(words))), n, counts


def wordless(page: tuple) -> tuple:
    slots, words, n, counts = page
    return slots, words[:0], np.zeros_like(n), counts


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs over a page's blocks, one from either end, and a logistic unit on both states."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + COUNTS
        g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"path": (r.standard_normal((PATHS, PATH_DIM)) * 0.1).astype(np.float32), "word": (r.standard_normal((WORDS, WORD_DIM)) * 0.1).astype(np.float32), "out": g(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for way in "fb":
            self.p |= {f"x{way}": g(d, 4 * HIDDEN), f"h{way}": g(HIDDEN, 4 * HIDDEN), f"c{way}": np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)}

    def inputs(self, page: tuple) -> np.ndarray:
        slots, words, n, counts = page
        x = np.zeros((len(slots), PATH_DIM + WORD_DIM + COUNTS), np.float32)
        if len(slots):
            lens = [len(s) for s in slots]
            x[:, :PATH_DIM] = np.add.reduceat(self.p["path"][np.concatenate(slots)], np.concatenate(([0], np.cumsum(lens)[:-1])))
            some = n > 0
            if some.any():
                sums = np.add.reduceat(self.p["word"][words], np.concatenate(([0], np.cumsum(n[some])[:-1])))
                x[some, PATH_DIM : PATH_DIM + WORD_DIM] = sums / n[some][:, None]
            x[:, PATH_DIM + WORD_DIM :] = counts
        return x

    def padded(self, pages: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        xs = [self.inputs(p) for p in pages]
        t = max(map(len, xs))
        x, mask = np.zeros((t, len(xs), xs[0].shape[1]), np.float32), np.zeros((t, len(xs), 1), np.float32)
        for i, one in enumerate(xs):
            x[: len(one), i], mask[: len(one), i] = one, 1
        return x, mask

    def run(self, x: np.ndarray, mask: np.ndarray, way: str, tape: list | None = None) -> np.ndarray:
        wx, wh, b = self.p[f"x{way}"], self.p[f"h{way}"], self.p[f"c{way}"]
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        out = np.zeros((*x.shape[:2], HIDDEN), np.float32)
        pre = x @ wx + b
        for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
            z = pre[t] + h @ wh
            s = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            c2 = f * c + i * g
            tc = np.tanh(c2)
            h2 = o * tc
            if tape is not None:
                tape.append((t, h, c, i, f, o, g, tc))
            m = mask[t]
            c, h = c2 * m + c * (1 - m), h2 * m + h * (1 - m)
            out[t] = h
        return out

    def scores(self, pages: list[tuple]) -> list[np.ndarray]:
        x, mask = self.padded(pages)
        z = np.concatenate([self.run(x, mask, "f"), self.run(x, mask, "b")], 2) @ self.p["out"] + self.p["bias"]
        return [z[: len(p[0]), i] for i, p in enumerate(pages)]

    def gradients(self, pages: list[tuple], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        x, mask = self.padded(pages)
        tapes = {"f": [], "b": []}
        hs = np.concatenate([self.run(x, mask, way, tapes[way]) for way in "fb"], 2)
        y = np.zeros(x.shape[:2], np.float32)
        for i, one in enumerate(labels):
            y[: len(one), i] = one
        dz = (_sigmoid(hs @ self.p["out"] + self.p["bias"]) - y) * mask[:, :, 0] / mask.sum()
        grads = {"out": np.einsum("tbh,tb->h", hs, dz), "bias": np.array([dz.sum()])}
        dhs, dx = dz[:, :, None] * self.p["out"], np.zeros_like(x)
        for k, way in enumerate("fb"):
            wx, wh = self.p[f"x{way}"], self.p[f"h{way}"]
            gx, gh, gc = np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN, np.float32)
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tc in reversed(tapes[way]):
                m = mask[t]
                dh = dh + dhs[t, :, k * HIDDEN : (k + 1) * HIDDEN]
                d2h, d2c = dh * m, dc * m
                d2c = d2c + d2h * o * (1 - tc * tc)
                z = np.concatenate([d2c * g * i * (1 - i), d2c * c * f * (1 - f), d2h * tc * o * (1 - o), d2c * i * (1 - g * g)], 1)
                gx += x[t].T @ z
                gh += h.T @ z
                gc += z.sum(0)
                dx[t] += z @ wx.T
                dh, dc = z @ wh.T + dh * (1 - m), d2c * f + dc * (1 - m)
            grads |= {f"x{way}": gx, f"h{way}": gh, f"c{way}": gc}
        gp, gw = np.zeros_like(self.p["path"]), np.zeros_like(self.p["word"])
        for b, (slots, words, n, _) in enumerate(pages):
            if slots:
                np.add.at(gp, np.concatenate(slots), np.repeat(dx[: len(slots), b, :PATH_DIM], [len(s) for s in slots], axis=0))
                np.add.at(gw, words, np.repeat(dx[: len(slots), b, PATH_DIM : PATH_DIM + WORD_DIM] / np.maximum(n, 1)[:, None], n, axis=0))
        return grads | {"path": gp, "word": gw}

    def train(self, pages: list[tuple], labels: list[np.ndarray], epochs: int, seed: int = SEED, rate: float = 0.01) -> None:
        r = np.random.default_rng(seed)
        m, v, step, steps = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0, epochs * -(-len(pages) // 24)
        for _ in range(epochs):
            order = np.argsort([len(y) + r.random() * 9 for y in labels])  # pages of like length together
            for i in r.permutation(range(0, len(order), 24)):
                some = order[i : i + 24]
                step += 1
                self.p["word"] *= np.float32(0.98)  # words are weak evidence
                seen = [renamed(pages[j], r) if r.random() < 0.4 else wordless(pages[j]) for j in some]  # invented words decide nothing
                for k, g in self.gradients(seen, [labels[j] for j in some]).items():
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (1 - 0.95 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def labelled(rng: random.Random) -> tuple[list[tuple], np.ndarray]:
    """An invented page's blocks and their labels."""
    page, main = invented_page(rng)
    found, labels = blocks(page), []
    left = list(main)
    for text, _, _ in found:
        hit = bool(left) and left[0] == text
        labels.append(hit)
        if hit:
            left.pop(0)
    return found, np.array(labels, np.float32)


@lru_cache(maxsize=1)
def trained() -> Labeller:
    rng = random.Random(SEED)
    some = [labelled(rng) for _ in range(TRAIN_PAGES)]
    model = Labeller()
    model.train(describe([b for b, _ in some]), [y for _, y in some], EPOCHS)
    return model


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    """The main text of each page, its blocks joined by line breaks; "" for null and for pages without any."""
    found = [blocks(p or "") for p in pages]
    out = [""] * len(pages)
    some = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
    start = 0
    while start < len(some):  # pages of like length together, a bounded number of blocks
        longest = len(found[some[min(len(some), start + 64) - 1]])
        size = max(1, min(64, 20_000 // longest))
        group = some[start : start + size]
        for i, z in zip(group, model.scores(describe([found[i] for i in group])), strict=True):
            out[i] = "\n".join(t for (t, _, _), s in zip(found[i], z.tolist(), strict=True) if s > 0)
        start += size
    return out


def extract(pages: DataFrame, html: str = "html", carry: list[str] | None = None) -> DataFrame:
    """The columns in carry (page_id and url), then text and n_chars, its code points.

    Each row on its own, so hot hosts and repeated rows do not matter; the model is broadcast (under 300 kB).
    Null and empty pages and pages without main text have an empty text; null ids stay; an empty table gives no
    rows; only the columns named are read, so others may have any names.
    """
    carry = carry or ["page_id", "url"]
    weights = pages.sparkSession.sparkContext.broadcast(trained().p)
    source = pages.select(*[f"`{c}`" for c in carry], f"`{html}`")

    def work(batches):
        model = Labeller()
        model.p = weights.value
        for b in batches:
            for i in range(0, len(b), 128):
                part = b.slice(i, 128)
                texts = main_texts(part.column(len(carry)).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carry)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*carry, "text", "n_chars"])

    return source.mapInArrow(work, C.schema_of(source, carry, "text string, n_chars long"))


def op8_html_extraction(spark, sf_dir: str) -> DataFrame:
    """The main text of all pages: (page_id, url, text, n_chars); see extract."""
    return extract(C.small(C.table(spark, sf_dir, "pages")))
