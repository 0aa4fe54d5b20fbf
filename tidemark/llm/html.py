"""Main text of web pages from flat text blocks and a small decision tree.

A page is cut into flat blocks at block-level tags. Each block has its word count, its link density (words
inside links per word), the same two figures of the block before and after it, and a region hint from the
elements around it: -1 inside menus, headers, footers, side bars, notices, adverts, forms or comments, 1
inside an article or main element, else 0. A CART tree trained on the small labelled table below
(``LABELLED``) decides which blocks are main text; those are joined in page order.

A page is parsed in one task; its cost is linear in its length for well-formed markup. No rows are
exchanged.

Defined results: null or empty html gives an empty text; unclosed elements, comments and scripts end with
the page, but embedded ones (svg, iframe, select and the like) that close themselves or are never closed hold nothing; character references are decoded once, after markup is removed; white space (including no-break
spaces) inside a block becomes one space, a single ``br`` is white space and two break the block; repeated
rows are extracted alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Their content is never text; unclosed, they take the rest of the page.
RAW = "script style title template noscript textarea".split()
#: Neither is theirs, but where they close themselves or are never closed they hold nothing.
EMBEDDED = "iframe svg math object select canvas audio video".split()
_ATTRS = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?"
    rf"|<(?P<hidden>{'|'.join(RAW)})\b{_ATTRS}>(?:.*?</(?P=hidden)\b[^>]*+(?:>|\Z)|.*\Z)"
    rf"|<(?P<embedded>{'|'.join(EMBEDDED)})\b{_ATTRS}>(?:(?<=/>)|.*?</(?P=embedded)\b[^>]*+(?:>|\Z)|)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.S | re.I,
)
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
REGION_TAGS = set("nav aside footer form dialog menu button".split())
MAIN = set("article main content post entry story".split())
ASIDE = set(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert newsletter subscribe subscription"
    " sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer comment comments disqus reply replies share sharing social related recommended widget popup modal"
    " overlay login signup search form toolbar pagination pager copyright skip".split()
)
WORDS_IN = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _hint(tag: str, attrs: str) -> str:
    """``main``, ``aside``, ``header`` or nothing for an element that opens."""
    if tag in ("html", "body"):
        return ""
    values = [CAMEL.sub("-", m[2] or m[3] or m[4] or "").lower() for m in NAMED.finditer(attrs)] if attrs else []
    names = {w for v in values for w in WORDS_IN.findall(v)}
    if tag in REGION_TAGS or names & ASIDE:
        # a name of its own outweighs a word inside a longer name: "share-price-news article" is an article
        whole = {w for v in values for w in v.split()}
        return "main" if tag not in REGION_TAGS and whole & MAIN and not whole & ASIDE else "aside"
    if tag in ("article", "main") or names & MAIN:
        return "main"
    return "header" if tag == "header" or names & {"header", "masthead"} else ""


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words inside links, hint) of every block with text."""
    out: list[tuple[str, int, int, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, str]] = []
    open_hints = {"main": 0, "aside": 0, "header": 0}
    linked = words_linked = breaks = 0

    def hint() -> int:
        if open_hints["aside"]:
            return -1
        return 1 if open_hints["main"] else -1 if open_hints["header"] else 0

    def flush() -> None:
        nonlocal words_linked
        if parts:
            words = entities.unescape("".join(parts)).split()
            if words:
                out.append((" ".join(words), len(words), min(words_linked, len(words)), hint()))
        parts.clear()
        words_linked = 0

    def text(s: str) -> None:
        nonlocal words_linked, breaks
        if s:
            parts.append(s)
            if linked:
                words_linked += len(s.split())
            if not s.isspace():
                breaks = 0

    at = 0
    for m in TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            text(entities_safe(m["cdata"]))
            continue
        tag = m["tag"] or m["tag2"]
        if tag is None:
            if m["hidden"] and m["hidden"].lower() == "title":
                flush()
            continue
        tag = tag.lower()
        closing = bool(m["close"] or m["close2"])
        if tag == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                flush()
            continue
        if tag == "a":
            linked = 0 if closing else 1
            continue
        if tag in INLINE:
            if not closing and tag not in VOID and (m["attrs"] or m["attrs2"] or "").strip() and (h := _hint(tag, m["attrs"] or m["attrs2"])) == "aside":
                flush()
                stack.append((tag, h))
                open_hints[h] += 1
            elif closing and stack and stack[-1][0] == tag:
                flush()
                open_hints[stack.pop()[1]] -= 1
            continue
        flush()
        if closing:
            if any(t == tag for t, _ in stack):
                while True:
                    t, h = stack.pop()
                    if h:
                        open_hints[h] -= 1
                    if t == tag:
                        break
        elif tag not in VOID and tag not in ("p", "html", "body", "head"):
            h = _hint(tag, m["attrs"] or m["attrs2"] or "")
            if tag == "li" and stack and stack[-1][0] == "li":
                stack.pop()
            stack.append((tag, h))
            if h:
                open_hints[h] += 1
        if not closing and tag == "p" and (m["attrs"] or m["attrs2"]) and _hint("p", m["attrs"] or m["attrs2"]) == "aside":
            stack.append(("p", "aside"))
            open_hints["aside"] += 1
    text(page[at:])
    flush()
    return out


def entities_safe(s: str) -> str:
    return s.replace("&", "&amp;")


def features(found: list[tuple[str, int, int, int]]) -> np.ndarray:
    """Per block: words, link density (percent), both of the previous and next block, hint."""
    words = np.array([b[1] for b in found], float)
    links = np.array([100.0 * b[2] / b[1] for b in found])
    before = lambda x: np.append(0.0, x[:-1])
    after = lambda x: np.append(x[1:], 0.0)
    return np.stack([words, links, before(words), before(links), after(words), after(links), np.array([b[3] for b in found], float)], axis=1)


#: Labelled by hand: words, link density, previous words and density, next words and density, hint, main text.
LABELLED = [
    # regions that never hold the article, of any length
    (1, 100, 0, 0, 1, 100, -1, 0), (1, 100, 1, 100, 1, 100, -1, 0), (2, 100, 1, 100, 9, 0, -1, 0), (8, 0, 1, 100, 12, 0, -1, 0),
    (45, 0, 1, 100, 12, 0, -1, 0), (14, 0, 80, 0, 0, 0, -1, 0), (30, 10, 60, 0, 25, 0, -1, 0), (120, 0, 40, 0, 90, 0, -1, 0),
    (6, 50, 90, 0, 0, 0, -1, 0), (25, 0, 200, 5, 30, 0, -1, 0), (60, 0, 60, 0, 60, 0, -1, 0), (3, 0, 150, 0, 2, 100, -1, 0),
    (75, 0, 40, 0, 0, 0, -1, 0), (52, 0, 9, 0, 6, 0, -1, 0), (140, 3, 30, 0, 11, 0, -1, 0), (61, 0, 0, 0, 2, 100, -1, 0),
    (90, 0, 90, 0, 12, 0, -1, 0), (33, 0, 30, 0, 45, 0, -1, 0), (200, 0, 5, 0, 150, 0, -1, 0), (18, 0, 25, 0, 70, 0, -1, 0),
    (55, 12, 3, 100, 40, 0, -1, 0), (7, 0, 40, 0, 35, 0, -1, 0), (27, 0, 22, 0, 80, 0, -1, 0), (110, 0, 70, 0, 30, 0, -1, 0),
    # inside the article
    (12, 0, 8, 0, 40, 0, 1, 1), (1, 0, 1, 100, 60, 0, 1, 1), (3, 0, 45, 0, 50, 0, 1, 1), (60, 0, 12, 0, 45, 0, 1, 1),
    (40, 5, 60, 0, 70, 0, 1, 1), (9, 0, 70, 0, 14, 0, 1, 1), (150, 2, 20, 0, 14, 0, 1, 1), (5, 0, 9, 0, 14, 0, 1, 1),
    (30, 40, 60, 0, 30, 0, 1, 1), (6, 0, 6, 0, 6, 0, 1, 1), (4, 100, 60, 0, 50, 0, 1, 1), (2, 0, 0, 0, 0, 0, 1, 1),
    (7, 100, 6, 100, 8, 100, 1, 1), (3, 100, 14, 0, 2, 100, 1, 1), (5, 100, 3, 100, 4, 0, 1, 1), (25, 0, 40, 0, 0, 0, 1, 1),
    (11, 0, 2, 0, 7, 0, 1, 1), (14, 0, 9, 0, 1, 100, 1, 1), (45, 0, 30, 0, 9, 0, 1, 1), (21, 0, 12, 0, 13, 0, 1, 1),
    (8, 20, 5, 0, 3, 100, 1, 1), (70, 0, 35, 0, 12, 0, 1, 1), (16, 0, 0, 0, 30, 0, 1, 1), (3, 0, 0, 0, 90, 0, 1, 1),
    # pages without marked regions: length and links of the neighbourhood decide
    (40, 0, 35, 0, 50, 0, 0, 1), (60, 5, 3, 0, 45, 0, 0, 1), (25, 0, 80, 0, 60, 0, 0, 1), (90, 3, 10, 0, 8, 0, 0, 1),
    (18, 0, 45, 0, 60, 0, 0, 1), (120, 0, 0, 0, 0, 0, 0, 1), (33, 10, 2, 100, 30, 0, 0, 1), (8, 0, 50, 0, 70, 0, 0, 1),
    (10, 0, 4, 0, 60, 0, 0, 1), (55, 0, 60, 0, 5, 100, 0, 1), (12, 0, 40, 0, 35, 0, 0, 1), (22, 0, 20, 0, 22, 0, 0, 1),
    (1, 100, 1, 100, 1, 100, 0, 0), (2, 100, 0, 0, 3, 100, 0, 0), (4, 0, 2, 100, 2, 100, 0, 0), (5, 60, 40, 0, 3, 100, 0, 0),
    (6, 0, 4, 0, 5, 0, 0, 0), (3, 0, 0, 0, 4, 0, 0, 0), (9, 80, 10, 90, 12, 70, 0, 0), (30, 90, 20, 80, 25, 95, 0, 0),
    (7, 0, 3, 100, 6, 0, 0, 0), (12, 50, 6, 100, 8, 40, 0, 0), (5, 0, 6, 0, 0, 0, 0, 0), (20, 60, 40, 0, 15, 70, 0, 0),
]


def train(rows=LABELLED, depth: int = 6, least: int = 1):
    """CART with Gini impurity: nested (feature, threshold, low, high) with leaf labels."""
    x, y = np.array([r[:-1] for r in rows], float), np.array([r[-1] for r in rows])

    def grow(at: np.ndarray, left: int):
        ones = y[at].mean()
        if left == 0 or ones in (0.0, 1.0):
            return int(ones >= 0.5)
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[at, f])
            for t in (values[:-1] + values[1:]) / 2:
                low = x[at, f] <= t
                n, m = low.sum(), (~low).sum()
                if min(n, m) < least:
                    continue
                p, q = y[at][low].mean(), y[at][~low].mean()
                cost = n * p * (1 - p) + m * q * (1 - q)
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, f, t, low)
        if best is None:
            return int(ones >= 0.5)
        _, f, t, low = best
        return (f, t, grow(at[low], left - 1), grow(at[~low], left - 1))

    return grow(np.arange(len(y)), depth)


def classify(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), bool(tree))
    f, t, low, high = tree
    return np.where(x[:, f] <= t, classify(low, x), classify(high, x))


def main_text(page: str | None, tree) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    keep = classify(tree, features(found))
    return "\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, labelled=LABELLED) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    tree = train(labelled)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(p, tree) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
