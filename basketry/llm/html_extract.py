"""Main-text extraction by line-block distribution.

Markup is stripped and cut into lines at block elements.  A line's weight is
its text length without link text; menus, page headers, footers, sidebars,
notices, adverts, forms and reader comments give no lines.  The block
distribution is the sum of weights over a sliding window of ``WINDOW`` lines.
The text surges where a block reaches the threshold and dives where the blocks
have fallen back to it; the stretch with the most text is the body.  The page's
own mark is a check after it: where most of the body's text is in marked
articles, or some of it in the main part, the body's edges are those of the
mark; else every line between surge and dive is kept.

Each page is one small computation on its own row (``mapInPandas``): no
shuffle, bounded by the largest page.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

WINDOW = 3
# A block of this many characters is text.
SURGE = 80
# Lines without text that a body may hold.
GAP = 6
# Share of a stretch's text that a neighbouring stretch needs to be joined with it.
JOIN_SHARE = 0.25
# Share of the body's text that marked articles need to set its edges: one may be a teaser.
MARK_SHARE = 0.5

# Elements of HTML and customary class words.
RAW = "script style noscript template svg iframe object canvas annotation-xml annotation select textarea head title"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
AUTO_CLOSED = set("p li dt dd tr td th option thead tbody tfoot".split())
DROPPED = set("nav footer aside form menu dialog button fieldset search".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
DROPPED_WORDS = set(
    "nav navbar navigation menu topbar breadcrumb breadcrumbs footer foot masthead sidebar side sidenav rail aside "
    "widget widgets related recommended recommendations share sharing social ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist "
    "respond replies disqus pagination pager skip form search tags copyright legal disclaimer".split())
# Inside a marked article: whole classes that name boilerplate and nothing an article may be about.
ARTICLE_DROPPED = set(
    "nav navbar breadcrumb breadcrumbs sidebar sidenav widget widgets share sharing share-buttons social-share "
    "social-links ad ads adv advert adverts advertisement advertising sponsored promo cookie-notice newsletter "
    "newsletter-signup related-posts related-articles comments commentlist comment-list respond disqus pagination "
    "pager".split())
# Parts of an id that say where a box is, not what it holds: with these alone beside it a word counts.
LAYOUT_WORDS = set(
    "site page main top bottom left right global primary secondary wrapper container box area block section inner outer "
    "bar panel list links buttons content body header head the my id".split())
HEADER_WORDS = set("header head site-header page-header".split())
COMMENT_WORDS = set("comment comments commentlist reply replies review reviews teaser card".split())
ARTICLE_PARTS = re.compile(
    r"(?:^|\s)(?:article|post|entry|story|main)[-_]?(?:content|body|text)(?:$|\s)|(?:^|\s)articlebody(?:$|\s)")

# Possessive repeats: a broken tag is given up in one step, so any page takes linear time.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:" + "|".join(RAW.split()) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+(?<=/)>|<(?P<raw>" + "|".join(RAW.split()) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+>"
    r".*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/<>]*+)"
    r"(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>", re.S | re.I)
# Whole name[=value] pairs, so that no name is found inside another one or in a value.
ATTRS = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+)))?")
READ_ATTRS = set("class id role itemprop hidden aria-hidden".split())


class _Page:
    """Lines of one page: text, weight without link text, and how closely the page marks it as article
    (2: an article, 1: the main part, 0: neither)."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.open: list[tuple[str, str]] = []  # element, and its kind: drop, article, main or ""
        self.at: dict[str, list[int]] = {}  # places of the open elements of a name, and of blocks but paragraphs
        self.count = {"drop": 0, "article": 0, "main": 0, "": 0}
        self.links = 0

    @property
    def mark(self) -> int:
        return 2 if self.count["article"] else int(self.count["main"] > 0)

    def flush(self) -> None:
        text = " ".join(_html.unescape("".join(self.parts)).split())
        if text:
            self.lines.append((text, max(0, len(text) - self.linked), self.mark))
        self.parts, self.linked = [], 0

    def text(self, piece: str) -> None:
        if self.count["drop"] or not piece:
            return
        self.parts.append(piece)
        if self.links:
            self.linked += len(" ".join(_html.unescape(piece).split()))

    def kind(self, name: str, attrs: str) -> str:
        if name in DROPPED:
            return "drop"
        if name in ("html", "body"):
            return ""
        if name == "main":
            return "main"
        if name == "header" and not self.mark:
            return "drop"
        words: set[str] = set()
        classes: set[str] = set()
        for key, a, b, c in ATTRS.findall(attrs) if attrs.strip(" /") else ():
            value, key = (a or b or c).lower(), key.lower()
            if key not in READ_ATTRS:
                continue
            if key == "role" and value in DROPPED_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
                return "drop"
            if key == "role" and value == "article" or key == "itemprop" and value == "articlebody":
                return "article"
            if key == "role" and value == "main":
                return "main"
            if key in ("class", "id"):
                if ARTICLE_PARTS.search(value):
                    return "article"
                classes.update(value.split() if key == "class" else ())
                words.update(value.split())
                parts = set(re.split(r"[\s_-]+", value))
                if key == "class" or parts <= DROPPED_WORDS | HEADER_WORDS | LAYOUT_WORDS:
                    words.update(parts)
        if self.count["article"]:
            return "drop" if classes & (ARTICLE_DROPPED | COMMENT_WORDS if name == "article" else ARTICLE_DROPPED) else (
                "article" if name == "article" else "")
        if words & DROPPED_WORDS and not (words & {"article", "post", "entry", "story"} and not words & {
                "comment", "comments", "nav", "footer", "related", "share", "ad", "ads", "sidebar"}):
            return "drop"
        if words & HEADER_WORDS and not self.mark and not name.startswith("h"):
            return "drop"
        if name == "article":
            return "drop" if words & COMMENT_WORDS else "article"
        return ""

    def start(self, name: str, attrs: str) -> None:
        if name in BLOCKS:
            self.flush()
        if name in VOID or attrs.endswith("/") and name not in BLOCKS:
            return
        if name in AUTO_CLOSED and self.open and self.open[-1][0] == name:
            self.close(len(self.open) - 1)
        if name in BLOCKS and self.open and self.open[-1][0] == "p":
            self.close(len(self.open) - 1)
        kind = self.kind(name, attrs)
        if name != "a" and name not in BLOCKS and not kind:
            return
        self.links += name == "a"
        for key in self._keys(name):
            self.at.setdefault(key, []).append(len(self.open))
        self.open.append((name, kind))
        self.count[kind] += 1

    @staticmethod
    def _keys(name: str) -> tuple[str, ...]:
        return (name, "#block") if name in BLOCKS and name != "p" else (name,)

    def close(self, at: int) -> None:
        """Close the open elements from position ``at`` on."""
        for name, kind in self.open[at:]:
            self.count[kind] -= 1
            self.links -= name == "a"
            for key in self._keys(name):
                self.at[key].pop()
        del self.open[at:]

    def end(self, name: str) -> None:
        """Close the last open element of the name; found without a search, so stray end tags cost nothing."""
        if name in BLOCKS:
            self.flush()
        mine, blocks = self.at.get(name), self.at.get("#block")
        if not mine or name not in BLOCKS and blocks and blocks[-1] > mine[-1]:
            return  # an inline end tag closes nothing beyond its block
        self.close(mine[-1])


def page_lines(page: str) -> _Page:
    out, at = _Page(), 0
    for token in TOKEN.finditer(page):
        out.text(page[at:token.start()])
        at = token.end()
        name = token["name"]
        if name and token["end"]:
            out.end(name.lower())
        elif name:
            out.start(name.lower(), token["attrs"] or "")
    out.text(page[at:])
    out.flush()
    return out


def stretches(weights: list[int], threshold: int, window: int = WINDOW, gap: int = GAP) -> list[tuple[int, int]]:
    """(surge, dive) line intervals: block sums at or over the threshold, joined over short gaps."""
    blocks = [sum(weights[i:i + window]) for i in range(len(weights))]
    found: list[list[int]] = []
    for i, block in enumerate(blocks):
        if block < threshold:
            continue
        first = next(j for j in range(i, len(weights)) if weights[j])
        last = max(j for j in range(i, min(i + window, len(weights))) if weights[j])
        if found and first <= found[-1][1] + gap:
            found[-1][1] = max(found[-1][1], last)
        else:
            found.append([first, last])
    return [(a, b + 1) for a, b in found]


def main_text(page: str | None) -> str:
    """The text of the page's main stretch, to the edges of its mark where that agrees; empty if there is none."""
    if not page:
        return ""
    lines = page_lines(page).lines
    weights = [w for _, w, _ in lines]
    if not any(weights):  # links alone: only a marked body can be made of them
        weights = [len(text) * (mark > 0) for text, _, mark in lines]
    found = stretches(weights, SURGE)
    if not found and any(weights):
        found = stretches(weights, max(sum(weights[i:i + WINDOW]) for i in range(len(weights))))
    if not found:
        return ""
    mass = [sum(weights[a:b]) for a, b in found]
    top = max(range(len(found)), key=lambda i: mass[i])
    first, last = top, top
    while first and mass[first - 1] >= JOIN_SHARE * mass[top]:
        first -= 1
    while last + 1 < len(found) and mass[last + 1] >= JOIN_SHARE * mass[top]:
        last += 1
    kept = range(found[first][0], found[last][1])
    # Inside the main part, articles are weighed against its own text.
    if any(lines[i][2] and weights[i] for i in kept):
        inside = [i for i in kept if lines[i][2]]
        article = sum(weights[i] for i in inside if lines[i][2] == 2)
        if article >= MARK_SHARE * sum(weights[i] for i in (inside if any(lines[i][2] == 1 for i in inside) else kept)):
            return " ".join(text for text, _, mark in lines if mark == 2)
        if any(lines[i][2] == 1 for i in inside):
            return " ".join(text for text, _, mark in lines if mark)
    return " ".join(lines[i][0] for i in kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: one row per input row.

    A null or empty page, or one without content, has an empty text.  Repeated
    rows are extracted one by one, other columns are not read, and an empty
    table gives no rows.  Very long pages are read whole, in linear time.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [main_text(h) for h in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": text,
                                "n_chars": [len(t) for t in text]})

    page_id = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(
        run, f"page_id {page_id}, url string, text string, n_chars long")
