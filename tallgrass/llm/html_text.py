"""Main text of HTML pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks, cut at block-level tags; the text
of scripts, styles and other invisible elements never enters.  A block's
features are its own, its predecessor's and its successor's word count and
link density, plus where it stands: inside an article or main element, inside
an element for navigation, notes or forms (by tag, or by a word of its class,
id or role), and whether it is a heading.  A decision tree over these decides
block by block.  It is grown here by Gini impurity from the small labelled
pages below.

Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by line feeds in page order; nothing
else is dropped.

Defined results: null and empty pages give an empty text; a page without any
tag is text like any other (one block); unclosed and stray tags are taken as
browsers do for blocks (an element that is never closed ends with the page, a
stray end tag is ignored); repeated rows give equal results; page_id and url
may be null; extra columns are ignored; an empty table gives an empty result.
Pages of any length are handled in time proportional to their length.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallgrass.llm.common import few_arrow_rows

# HTML element names by role, and words of class or id names.
INVISIBLE = frozenset("script style noscript template svg math iframe object head title canvas audio video select "
                      "textarea option datalist".split())
RAW_TEXT = frozenset("script style textarea title noscript iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SIDE_TAGS = frozenset("nav footer aside form header menu dialog button fieldset".split())
MAIN_TAGS = frozenset("article main".split())
SIDE_WORDS = frozenset("ad ads banner consent copyright footer gdpr header login masthead menu modal nav notice "
                       "pagination popup promo promoted related reply replies respond share sharing signup skip social "
                       "tags toolbar topbar widget".split())
SIDE_STEMS = ("advert", "breadcrumb", "comment", "cookie", "disqus", "navbar", "navigation", "newsletter", "sidebar",
              "sponsor", "subscri")
MAIN_WORDS = frozenset("article content entry main post story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>"
                    r"|<[!?][^>]*>", re.S)
_UNSEEN = re.compile(r"display\s*:\s*none|\shidden(?=[\s=/]|$)", re.I)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

FEATURES = ("words", "links", "before_words", "before_links", "after_words", "after_links", "in_main", "in_side",
            "heading")


def _role(tag: str, attributes: str, in_main: bool) -> int:
    """1: main text, -1: beside it, 0: neither."""
    named = _words_of(attributes)
    beside = bool(named & SIDE_WORDS) or any(w.startswith(SIDE_STEMS) for w in named)
    if tag in MAIN_TAGS:
        return -1 if beside else 1
    if tag in SIDE_TAGS:
        # an article's own header holds its title
        return 0 if tag == "header" and in_main else -1
    if not attributes or tag in ("html", "body"):
        return 0
    if beside:
        return 0 if in_main and "header" in named and len(named & SIDE_WORDS) == 1 else -1
    return 1 if named & MAIN_WORDS else 0


def _words_of(attributes: str) -> set[str]:
    return {w for m in _NAMES.finditer(attributes) for w in _PARTS.findall((m[1] or m[2] or m[3] or "").lower())}


class Block:
    __slots__ = ("text", "words", "links", "in_main", "in_side", "heading")

    def __init__(self, text: str, linked: int, in_main: bool, in_side: bool, heading: bool) -> None:
        self.text = text
        self.words = text.count(" ") + 1
        self.links = linked / self.words
        self.in_main, self.in_side, self.heading = in_main, in_side, heading


def blocks(page: str) -> list[Block]:
    """The visible text blocks of a page, in order."""
    out: list[Block] = []
    open_tags: list[tuple[str, int]] = []   # block-level elements with a role or that hide their text
    text: list[str] = []
    linked = mains = sides = hidden = headings = anchor = 0

    def close() -> None:
        nonlocal linked
        whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        if whole:
            out.append(Block(whole, min(linked, whole.count(" ") + 1), mains > 0, sides > 0, headings > 0))
        text.clear()
        linked = 0

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece and not hidden:
            text.append(piece)
            if anchor:
                linked += len(piece.split())
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                anchor = 0
            elif tag not in INLINE:
                close()
            if any(t == tag for t, _ in open_tags):
                while open_tags:
                    t, role = open_tags.pop()
                    mains -= role == 1
                    sides -= role == -1
                    hidden -= role == 2
                    headings -= role == 3
                    if t == tag:
                        break
            continue
        if tag in RAW_TEXT:
            close()
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "a":
            anchor = 1
            continue
        if tag in ("br", "hr", "img", "wbr"):
            text.append(" ")
        if tag in INLINE:
            role = _role(tag, m[3], mains > 0)
            if role == -1 and not m[3].rstrip().endswith("/") and tag not in VOID:
                close()
                open_tags.append((tag, -1))
                sides += 1
            continue
        close()
        if tag in VOID or m[3].rstrip().endswith("/"):
            continue
        role = 2 if tag in INVISIBLE or _UNSEEN.search(m[3]) else 3 if tag in HEADINGS else _role(tag, m[3], mains > 0)
        if role or any(t == tag for t, _ in open_tags):
            open_tags.append((tag, role))
            mains += role == 1
            sides += role == -1
            hidden += role == 2
            headings += role == 3
    close()
    return out


def features(found: list[Block]) -> np.ndarray:
    own = np.array([(b.words, b.links, b.in_main, b.in_side, b.heading) for b in found], float).reshape(-1, 5)
    none = np.zeros((1, 2))
    before, after = np.vstack([none, own[:-1, :2]]), np.vstack([own[1:, :2], none])
    return np.hstack([own[:, :2], before, after, own[:, 2:]])[:len(found)]


# -- the labelled table: small pages, their main blocks marked by "+" -----------
_LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen " \
        "eighteen nineteen twenty"
_MENU = "<ul><li><a href=x>home</a></li><li><a href=x>about us</a></li><li><a href=x>news</a></li></ul>"
LABELLED = (
    # articles marked as such: everything in them is main text, short blocks too
    f"<nav>{_MENU}</nav><div class=ad>buy now and save money today</div><article><h1>+ a title</h1><p>+ {_LONG}"
    f"<p>+ short.<p>+ {_LONG} {_LONG}</article><footer>(c) the site <a href=x>imprint</a></footer>",
    f"<header>the site name</header><main><h1>+ another title here</h1><p>+ {_LONG}</p><ul><li>+ first point</li>"
    f"<li>+ second point</li></ul><p>+ see <a href=x>this page</a></p><div class=comments><p>{_LONG}</p></div></main>"
    "<aside><h2>related</h2><p>read this story too</p></aside><div id=cookie-notice>we use cookies on this site</div>",
    f"<div class=sidebar><p>{_LONG}</p></div><article><p>+ a</p><p>+ {_LONG}</p><form>your mail <button>send</button>"
    f"</form><p>+ b c</p></article><div class=newsletter>{_LONG}</div>",
    # pages without such marks: long text with few links is main text
    f"<div>{_MENU}</div><div><p>+ {_LONG}</p><p>+ {_LONG} <a href=x>with one link</a> {_LONG}</p><p>+ a short end.</p>"
    f"<p>+ {_LONG}</p></div><div><a href=x>privacy policy</a> | <a href=x>terms of use</a></div>",
    f"<table><tr><td><a href=x>start</a></td><td><a href=x>products</a></td></tr></table><h1>+ the plain old page</h1>"
    f"<p>+ {_LONG}</p><p>+ {_LONG}</p><div><a href=x>next</a> <a href=x>previous</a></div>",
    f"<div><a href=x>{_LONG}</a></div><div><p>+ {_LONG} {_LONG}</p></div><div><a href=x>top</a></div>",
    f"<h2>+ only a title</h2><p>+ {_LONG}</p>",
    "+ a page of plain text without any tag",
    "<p>+ one paragraph</p>",
    f"<div><a href=x>log in</a> <a href=x>sign up</a></div><p>+ {_LONG}</p><p>+ in short</p><p>+ {_LONG}</p>",
    f"<footer><p>{_LONG} {_LONG}</p></footer><nav><p>go to</p></nav><article><p>+ {_LONG}</p></article>",
    f"<article><h1>+ list of sources</h1><p>+ <a href=x>the first source</a></p><p>+ <a href=x>the second one</a></p>"
    f"<p>+ {_LONG}</p></article>",
    f"<div><a href=x>start</a></div><p>+ {_LONG}</p><p>+ {_LONG}</p><div><a href=x>imprint</a></div><div>all rights "
    "reserved</div><div><a href=x>contact</a></div>",
    f"<div><a href=x>a</a></div><div>our city site</div><div><a href=x>b</a></div><p>+ {_LONG} {_LONG}</p><p>+ {_LONG}</p>",
    f"<div class='post entry'><h1>+ title</h1><p>+ {_LONG}</p><p>+ so.</p></div><div class=share>share this with "
    f"<a href=x>friends</a></div><div class='related promo'><p>{_LONG}</p></div>",
)
MAX_DEPTH = 6


def labelled_rows() -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for page in LABELLED:
        found = blocks(page)
        marks = [b.text.startswith("+") for b in found]
        for b, m in zip(found, marks):
            if m:  # the mark is no word of the block
                b.links, b.words = min(1.0, b.links * b.words / (b.words - 1)), b.words - 1
        x.append(features(found))
        y += marks
    return np.vstack(x), np.array(y)


def grow(x: np.ndarray, y: np.ndarray, depth: int = MAX_DEPTH) -> tuple:
    """(feature, threshold, left, right) or a leaf's verdict; ties go to the first feature, the lowest threshold."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (bool(share >= 0.5),)
    best = None
    for f in (6, 7, *(k for k in range(x.shape[1]) if k not in (6, 7))):
        values = np.unique(x[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= t
            gini = sum(m.sum() * (p := y[m].mean()) * (1 - p) for m in (low, ~low))
            if best is None or gini < best[0] - 1e-9:
                best = (gini, f, t)
    if best is None:
        return (bool(share >= 0.5),)
    low = x[:, best[1]] <= best[2]
    return (best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


@lru_cache(maxsize=1)
def tree() -> tuple:
    return grow(*labelled_rows())


def classify(x: np.ndarray, node: tuple | None = None) -> np.ndarray:
    node = tree() if node is None else node
    if len(node) == 1:
        return np.full(len(x), node[0])
    low = x[:, node[0]] <= node[1]
    out = np.empty(len(x), bool)
    out[low] = classify(x[low], node[2])
    out[~low] = classify(x[~low], node[3])
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    if not found:
        return ""
    keep = classify(features(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def main_text_column(page: Column) -> Column:
    @F.pandas_udf(StringType())
    def extract(s: pd.Series) -> pd.Series:
        return s.map(main_text)
    return extract(F.coalesce(page, F.lit("")))


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    few_arrow_rows(pages.sparkSession)
    out = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                       main_text_column(F.col(page)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
