"""Main text of web pages from flat text blocks.

A page is read once into blocks of text between block-level tags. Every block has its word count and link density and those
of its neighbours, whether it stands in an article element, and how much better text the page holds elsewhere: a block in an
element that its tag or name makes a suspect is measured against the plain text outside of that element, a block beside an article
against the article. A suspect is no verdict: an element that holds most of the page's plain text is what the page is about,
whatever it is called. A decision tree trained on the small labelled table below tells article text from the rest.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the HTML standard by what they do to text.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "canvas", "object", "select", "title", "xmp", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SHELLS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
#: Shells that never hold the article of a page that has one: their text counts less against it.
FIRM, FIRM_SHARE = {"nav", "footer", "aside", "menu", "dialog"}, 0.1
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in a class, id or role that name a page's furniture, and those that name reader comments.
SHELL_WORDS = {"ad", "ads", "advert", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "complementary", "contentinfo", "cookie", "cookies", "consent", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promotion", "related", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "teaser", "toolbar", "widget"}
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "replies", "reply", "respond", "discussion"}
SUSPECT_WORDS = SHELL_WORDS | COMMENT_WORDS
ARTICLES = {"article", "main"}
WHOLE = {"html", "body"} | ARTICLES

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.DOTALL)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
MAIN = re.compile(r"""\brole\s*=\s*["']?main\b""", re.IGNORECASE)
HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?until)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in RAW}


class Block(NamedTuple):
    """A stretch of text and how much of it is linked; the article and the suspect element (negative: a firm one) around it, and the article around that (0: none)."""

    text: str
    words: int
    links: float
    heading: int
    article: int
    suspect: int
    scope: int


def is_suspect(name: str, attributes: str, article: int) -> bool:
    """Whether an element may be a page's furniture by its tag, its name or for being hidden; never the page or an article as a whole."""
    if name in SHELLS or name == "header" and not article or HIDDEN.search(attributes):
        return True
    if name in WHOLE or not attributes:
        return False
    named = " ".join(x for m in NAMED.findall(attributes) for x in m).lower()
    return not SUSPECT_WORDS.isdisjoint(re.split(r"[^a-z]+", named))


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; unclosed and stray tags are taken as browsers would, broken tags at the end are dropped."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, int, int]]] = []  # open elements with the article, suspect and scope within
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked: list[str] = []
    in_link = heading = False
    at = 0

    def around() -> tuple[int, int, int]:
        return stack[-1][1] if stack else (0, 0, 0)

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            words = text.count(" ") + 1
            out.append(Block(text, words, min(1.0, len(html.unescape("".join(linked)).split()) / words), int(heading), *around()))
        parts.clear()
        linked.clear()

    def add(text: str) -> None:
        parts.append(text)
        if in_link:
            linked.append(text)

    while True:
        token = TOKEN.search(page, at)
        add(page[at : token.start()] if token else page[at:])
        if not token:
            break
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        closing, attributes = token[1] or token[4], token[3] or token[6] or ""
        if not name:
            continue
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = ENDS[name].search(page, at)
                at = end.end() if end else len(page)
                if name in ("title", "textarea", "select"):
                    close()
            continue
        if name == "a":
            in_link = not closing
            continue
        if name == "br":
            add(" ")
            continue
        if name in INLINE:
            continue
        close()
        if name in HEADINGS:
            heading = not closing
        elif not closing:
            heading = False
        in_link = False
        if closing:
            if opened[name]:
                while True:
                    opened[left := stack.pop()[0]] -= 1
                    if left == name:
                        break
        elif name not in VOID and name not in ("p", "li", "html", "body") and not attributes.endswith("/"):
            article, suspect, scope = around()
            if not suspect and is_suspect(name, attributes, article):
                suspect, scope = -at if name in FIRM else at, article
            if not article and (name in ARTICLES or "main" in attributes and MAIN.search(attributes)):
                article = at
            stack.append((name, (article, suspect, scope)))
            opened[name] += 1
        elif name == "body":
            stack.clear()
            opened.clear()
    close()
    return out


FEATURES = ("links", "words", "heading", "inside", "better", "words_before", "links_before", "words_after", "links_after")
#: The labelled table: features in the order above, then 1 for article text.
LABELLED = (
    # items of menus and lists of links, by far the most frequent furniture
    (1.0, 1, 0, 0, 0.99, 1, 1.0, 1, 1.0, 0), (1.0, 1, 0, 0, 0.98, 0, 0.0, 1, 1.0, 0), (1.0, 2, 0, 0, 0.99, 1, 1.0, 6, 0.0, 0), (1.0, 2, 0, 0, 0.97, 2, 1.0, 3, 1.0, 0), (1.0, 1, 0, 0, 0.0, 0, 0.0, 1, 1.0, 0), (1.0, 4, 0, 0, 0.0, 2, 1.0, 3, 1.0, 0),
    (1.0, 3, 0, 0, 0.96, 4, 1.0, 2, 1.0, 0), (1.0, 1, 0, 0, 0.0, 1, 1.0, 9, 0.0, 0), (1.0, 5, 0, 1, 0.0, 4, 1.0, 6, 1.0, 0), (1.0, 3, 0, 1, 0.0, 90, 0.0, 4, 1.0, 0), (1.0, 8, 0, 1, 0.0, 5, 1.0, 10, 0.0, 0), (1.0, 7, 0, 0, 0.95, 30, 0.0, 5, 1.0, 0),
    (0.9, 14, 0, 1, 0.0, 60, 0.0, 12, 1.0, 0), (0.8, 15, 0, 0, 0.0, 6, 1.0, 20, 0.6, 0), (0.7, 30, 0, 0, 0.0, 10, 0.5, 5, 1.0, 0), (0.9, 20, 0, 0, 0.9, 9, 1.0, 4, 1.0, 0),
    # text beside an article or in a suspect element, with better text elsewhere
    (0.0, 6, 0, 0, 0.98, 1, 1.0, 12, 0.0, 0), (0.0, 8, 0, 0, 0.97, 1, 1.0, 12, 0.0, 0), (0.0, 25, 0, 0, 0.9, 40, 0.0, 0, 0.0, 0), (0.0, 60, 0, 0, 0.8, 30, 0.0, 45, 0.0, 0), (0.2, 6, 0, 0, 0.99, 80, 0.0, 0, 0.0, 0), (0.0, 3, 1, 0, 0.85, 20, 0.0, 15, 0.5, 0),
    (0.02, 120, 0, 0, 0.6, 3, 0.0, 90, 0.0, 0), (0.0, 4, 0, 0, 0.99, 60, 0.0, 2, 0.0, 0), (0.4, 18, 0, 0, 0.7, 2, 1.0, 50, 0.0, 0), (0.0, 12, 1, 0, 0.5, 0, 0.0, 100, 0.0, 0), (0.0, 7, 0, 1, 0.95, 70, 0.0, 60, 0.0, 0), (0.0, 40, 0, 1, 0.4, 2, 0.0, 30, 0.0, 0),
    (0.0, 30, 0, 1, 0.3, 5, 0.0, 70, 0.0, 0), (0.1, 16, 0, 1, 0.8, 20, 0.0, 3, 1.0, 0), (0.0, 2, 1, 1, 0.9, 50, 0.0, 7, 0.0, 0), (0.0, 90, 0, 0, 0.35, 60, 0.0, 80, 0.0, 0),
    # text of an article
    (0.0, 7, 1, 1, 0.0, 10, 0.0, 80, 0.0, 1), (0.0, 12, 1, 1, 0.0, 8, 0.0, 45, 0.0, 1), (0.0, 80, 0, 1, 0.0, 12, 0.0, 3, 0.0, 1), (0.0, 1, 0, 1, 0.0, 80, 0.0, 60, 0.0, 1), (0.0, 2, 0, 1, 0.0, 40, 0.0, 9, 0.0, 1), (0.0, 3, 0, 1, 0.0, 2, 0.0, 14, 0.0, 1),
    (0.01, 300, 0, 1, 0.0, 90, 0.0, 120, 0.0, 1), (0.1, 45, 0, 1, 0.0, 30, 0.0, 6, 0.0, 1), (0.3, 20, 0, 1, 0.0, 60, 0.0, 70, 0.0, 1), (0.2, 9, 0, 1, 0.0, 4, 0.0, 5, 0.0, 1), (0.0, 55, 0, 1, 0.0, 70, 0.0, 10, 0.0, 1), (0.5, 4, 0, 1, 0.0, 60, 0.0, 50, 0.0, 1),
    (0.0, 50, 0, 1, 0.0, 30, 0.0, 0, 0.0, 1), (0.0, 5, 0, 1, 0.0, 80, 0.0, 0, 0.0, 1), (0.0, 10, 0, 1, 0.0, 0, 0.0, 0, 0.0, 1), (0.0, 2, 0, 1, 0.0, 1, 0.0, 1, 0.0, 1), (0.0, 6, 1, 1, 0.0, 0, 0.0, 1, 0.0, 1), (0.0, 20, 0, 1, 0.0, 60, 0.0, 5, 1.0, 1),
    (0.0, 1, 0, 1, 0.0, 6, 1.0, 2, 1.0, 1), (0.6, 35, 0, 1, 0.0, 50, 0.0, 2, 0.0, 1), (1.0, 6, 0, 1, 0.0, 60, 0.0, 70, 0.0, 1), (1.0, 2, 0, 1, 0.0, 30, 0.0, 40, 0.0, 1), (0.0, 9, 0, 1, 0.0, 4, 1.0, 1, 0.0, 1), (0.0, 3, 0, 1, 0.0, 2, 0.0, 2, 1.0, 1),
    # text of a suspect element, or beside an article, that outweighs all other text
    (0.0, 80, 0, 0, 0.05, 6, 0.0, 40, 0.0, 1), (0.0, 4, 0, 1, 0.1, 60, 0.0, 30, 0.0, 1), (0.02, 120, 0, 0, 0.15, 30, 0.0, 90, 0.0, 1), (0.0, 9, 1, 0, 0.08, 2, 1.0, 70, 0.0, 1), (0.0, 35, 0, 1, 0.12, 3, 0.0, 50, 0.0, 1),
    # text of a page without article and suspects: by words and links alone
    (0.0, 50, 0, 0, 0.0, 0, 0.0, 0, 0.0, 1), (0.0, 35, 0, 0, 0.0, 40, 0.0, 0, 0.0, 1), (0.0, 3, 0, 0, 0.0, 0, 0.0, 0, 0.0, 1), (0.0, 45, 0, 0, 0.0, 30, 0.0, 1, 0.0, 1), (0.0, 40, 0, 0, 0.0, 60, 0.0, 50, 0.0, 1), (0.05, 120, 0, 0, 0.0, 10, 0.0, 80, 0.0, 1),
    (0.1, 22, 0, 0, 0.0, 45, 0.0, 30, 0.0, 1), (0.0, 16, 0, 0, 0.0, 70, 0.0, 25, 0.1, 1), (0.0, 8, 1, 0, 0.0, 3, 1.0, 60, 0.0, 1), (0.0, 5, 1, 0, 0.0, 50, 0.0, 70, 0.0, 1), (0.0, 3, 0, 0, 0.0, 60, 0.0, 40, 0.0, 1), (0.0, 6, 0, 0, 0.0, 35, 0.0, 55, 0.0, 1),
    (0.0, 5, 0, 0, 0.0, 3, 1.0, 4, 1.0, 0), (0.0, 4, 0, 0, 0.0, 3, 0.0, 2, 0.0, 0), (0.0, 2, 0, 0, 0.0, 0, 0.0, 1, 1.0, 0), (0.0, 7, 0, 0, 0.0, 60, 0.0, 0, 0.0, 0), (0.0, 6, 0, 0, 0.0, 1, 1.0, 5, 0.0, 0),
)


def grow(rows: list[tuple], depth: int = 7):
    """A decision tree by Gini impurity: a class, or (feature, threshold, tree up to it, tree above it)."""
    ones = sum(r[-1] for r in rows)
    if not depth or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))
    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            sides = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            impurity = sum(2 * p * (len(s) - p) / len(s) for s in sides for p in [sum(r[-1] for r in s)])
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, cut, sides
    if best is None:
        return int(2 * ones >= len(rows))
    _, f, cut, (low, high) = best
    return f, cut, grow(low, depth - 1), grow(high, depth - 1)


@cache
def tree():
    """The tree of the labelled table."""
    return grow(list(LABELLED))


def features(found: list[Block]) -> list[tuple]:
    """Every block's row of FEATURES."""
    plain = [b.words * (1 - b.links) for b in found]
    clear: Counter[int] = Counter()  # plain words without suspects, by article
    within: Counter[int] = Counter()  # plain words, by suspect
    for b, n in zip(found, plain):
        if b.suspect:
            within[b.suspect] += n
        else:
            clear[b.article] += n
    page = sum(n for article, n in clear.items() if article)
    rows = []
    for k, b in enumerate(found):
        if b.suspect:
            rest, own = (clear[b.scope] if b.scope else page or clear[0]), within[b.suspect]
            if b.suspect < 0:
                rest, own = rest or sum(n for suspect, n in within.items() if suspect > 0), own * FIRM_SHARE
        else:
            rest, own = (0, 1) if b.article else (page, clear[0])
        before, after = found[k - 1] if k else None, found[k + 1] if k + 1 < len(found) else None
        rows.append((b.links, b.words, b.heading, int(b.article > 0), rest / (rest + own) if rest else 0.0, *((before.words, before.links) if before else (0, 0.0)), *((after.words, after.links) if after else (0, 0.0))))
    return rows


def classify(found: list[Block]) -> list[int]:
    """1 for every block that is article text."""
    out = []
    for row in features(found):
        node = tree()
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        out.append(node)
    return out


def main_text(page: str) -> str:
    """A page's article blocks, joined by line feeds."""
    found = blocks(page)
    return "\n".join(b.text for b, kept in zip(found, classify(found)) if kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; no shuffle.

    Null and empty html, and pages without article text, give an empty text; repeated rows are extracted each; an empty table
    gives no rows; null ids and urls stay null; further columns are ignored; very long pages are read whole, in one pass.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page.as_py() or "") for page in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return source.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
