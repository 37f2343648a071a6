"""Main text of web pages by scoring the tree of elements.

Paragraphs pass points for their length and commas to their ancestors, less with distance; a
container's points are discounted by the share of its text that lies in links. The container with
the most points is kept, with those siblings that score well themselves or hold long text with few
links, and it is widened to the ``article`` or ``main`` element around it. Navigation, page headers and
footers, sidebars, notices, adverts, forms, comments of readers, scripts and styles never count. Words in
class, id and role name such parts only where the element holds neither the article with the most text,
nor ``main``, ``h1`` or most of the page's text, and so do forms: many pages are one; comments stay comments however long they are, and so
does all that lies beside an ``article`` or ``main`` with text.

Inside a kept ``article`` or ``main`` a block of links goes only when its whole list is a menu: all in links,
and short ones. Tables of links stay.

Defined results: null or empty markup gives an empty text; unclosed and stray tags are repaired in
passing; a page without any scoring paragraph gives all text outside the parts named above; long
pages are read whole; repeated pages are treated alike.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm import words as W

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*+>?|</?[a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-zA-Z][^>]*+>?|[^<]++|<",
    re.S,
)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""")
TELLING = re.compile("class|id|role|hidden|style", re.I)  # without these, attributes tell nothing
UNSEEN = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)

# Elements of HTML, and words that name parts outside the main text
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "annotation", "annotation-xml", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
OUTSIDE = {"nav", "footer", "aside", "button", "select", "menu", "head", "dialog", "fieldset"}
OUTSIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer",
    "form", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notices", "pagination", "popup", "promo", "promotion", "recommended", "related", "remark",
    "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget", "contentinfo", "complementary", "search", "alert",
}
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "remark", "replies", "reply", "respond"}
SEMANTIC = {"article", "main"}
LISTS = {"ul", "ol", "dl", "menu"}
CLOSES = {  # an opening tag ends an open element of these names
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPES = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "aside", "nav", "td", "th"}
SCORED = {"p", "pre", "td", "blockquote", "div", "section", "article", "main", "body", "li", "dd"}

LEAST_PARAGRAPH = 25  # characters
SIBLING_SHARE = 0.2
LINKED = 0.5  # a block with more of its text in links is a menu, outside article and main
MENU_LINKED = 0.9  # so much of a whole list in links makes it a menu, if they are short
MOST = 0.5


class _Page:
    """Elements as parallel lists, and blocks of text in page order."""

    def __init__(self):
        self.tags, self.parents, self.outside = ["#root"], [0], [False]
        self.words: list[set[str]] = [set()]  # of OUTSIDE_WORDS, the element's own
        self.marked = [False]  # outside, or in an element with such words
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.chars, self.linked, self.anchors = [0], [0], [0]
        self.stack = [0]
        self.pieces: list[str] = []
        self.links: list[str] = []
        self.depth_of_links = 0

    def flush(self) -> None:
        """End the block of text that is open."""
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            if text:
                self._block(text)
            self.pieces.clear()
            self.links.clear()

    def _block(self, text: str) -> None:
        owner = next(i for i in reversed(self.stack) if i == 0 or self.tags[i] in BLOCKS)
        if self.outside[owner]:
            return
        linked = len(" ".join(html.unescape("".join(self.links)).split()))
        self.blocks.append((owner, text, linked))

    def settle(self) -> None:
        """Decide what lies outside, now that all elements are known, and sum up the rest."""
        n = len(self.tags)
        total, holds = [0] * n, [False] * n
        for owner, text, _ in self.blocks:
            total[owner] += len(text)
        for i in range(n - 1, 0, -1):  # parents come before their children
            total[self.parents[i]] += total[i]
        articles = [i for i in range(n) if self.tags[i] == "article" and not self.outside[i] and not self.words[i]]
        longest = max(articles, key=lambda i: total[i], default=0)
        mains = [i for i in range(n) if self.tags[i] == "main" and not self.outside[i]]
        known = {i for i in (longest, *mains) if i and total[i]}  # parts that need no guess by length
        for i in range(n - 1, 0, -1):
            holds[i] |= i == longest or self.tags[i] in ("main", "h1") and not self.outside[i]
            holds[self.parents[i]] |= holds[i]
        within = [False] * n
        for i in range(1, n):
            within[i] = i in known or within[self.parents[i]]
            most = total[i] > MOST * total[0] and self.words[i].isdisjoint(COMMENT_WORDS) and (within[i] or not known)
            named = bool(self.words[i]) and self.tags[i] not in SEMANTIC and not holds[i] and not most
            self.outside[i] |= self.outside[self.parents[i]] or named
        self.blocks = [x for x in self.blocks if not self.outside[x[0]]]
        self.chars, self.linked = [0] * n, [0] * n
        self.anchors = [int(x == "a" and not out) for x, out in zip(self.tags, self.outside)]
        for owner, text, linked in self.blocks:
            self.chars[owner] += len(text)
            self.linked[owner] += linked
        for i in range(n - 1, 0, -1):
            for sums in (self.chars, self.linked, self.anchors):
                sums[self.parents[i]] += sums[i]

    def text(self, data: str) -> None:
        self.pieces.append(data)
        if self.depth_of_links:
            self.links.append(data)

    def pop_to(self, place: int) -> None:
        """Close the elements from this place of the stack on."""
        if any(self.tags[i] in BLOCKS for i in self.stack[place:]):
            self.flush()
        self.depth_of_links -= sum(self.tags[i] == "a" for i in self.stack[place:])
        del self.stack[place:]

    def close(self, name: str) -> None:
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[place]]
            if tag == name:
                self.pop_to(place)
                return
            if tag in SCOPES and name not in BLOCKS:
                return  # an inline end tag does not reach beyond its container

    def open(self, name: str, token: str) -> None:
        if name in BLOCKS:
            self.flush()
            self._imply("p", {"p"})
        if name in CLOSES:
            self._imply(name, CLOSES[name])
        if name in VOID:
            self.pieces.append(" ")
            return
        parent = self.stack[-1]
        outside, words = self._named(name, token)
        marked = self.marked[parent] or outside or bool(words) and name not in SEMANTIC
        if marked and not self.marked[parent]:
            self.flush()
        self.tags.append(name)
        self.parents.append(parent)
        self.outside.append(outside or self.outside[parent])
        self.words.append(words)
        self.marked.append(marked)
        self.stack.append(len(self.tags) - 1)
        self.depth_of_links += name == "a"

    def _imply(self, name: str, ended: set[str]) -> None:
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[place]]
            if tag in ended:
                self.pop_to(place)
                return
            if tag in SCOPES:
                return

    def _named(self, name: str, token: str) -> tuple[bool, set[str]]:
        """Whether the element lies outside by itself, and its words that name such parts."""
        if name in OUTSIDE:
            return True, set()
        if name == "header":  # of the page, not of the article
            return not any(self.tags[i] in SEMANTIC for i in self.stack), set()
        if name in ("body", "html"):
            return False, set()
        # a form is one only where it does not hold the article
        words = {"form"} if name == "form" else set()
        marks = attributes(name, token) if TELLING.search(token) else {}
        unseen = "hidden" in marks or marks.get("aria-hidden", "").strip().lower() == "true"
        if name not in SEMANTIC and (unseen or UNSEEN.search(marks.get("style", ""))):
            return True, set()
        named = " ".join(marks.get(x, "") for x in ("class", "id", "role"))
        parts = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower())
        return False, words | OUTSIDE_WORDS.intersection(parts)


def attributes(name: str, token: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for key, *values in ATTRIBUTE.findall(token, len(name) + 1):
        found.setdefault(key.lower(), "".join(values))
    return found


def parse(markup: str) -> _Page:
    page, at = _Page(), 0
    while found := TOKEN.match(markup, at):
        token, at = found[0], found.end()
        if token[0] != "<" or token == "<":
            page.text(token)
            continue
        named = NAME.match(token)
        if not named:
            continue
        name = named[1].lower()
        if token[1] == "/":
            page.close(name)
        elif name in RAW:
            if not token.endswith("/>"):
                end = re.compile(rf"</{name}\s*>", re.I).search(markup, at)
                at = end.end() if end else len(markup)
        else:
            page.open(name, token)
    page.flush()
    page.settle()
    return page


def _scores(page: _Page) -> list[float]:
    points = [0.0] * len(page.tags)
    for owner, text, linked in page.blocks:
        if page.tags[owner] not in SCORED or len(text) < LEAST_PARAGRAPH or linked > LINKED * len(text):
            continue
        gained = 1 + text.count(",") + min(len(text) // 100, 3)
        # text straight in a container counts for itself, a paragraph for its ancestors
        node = page.parents[owner] if page.tags[owner] in ("p", "pre", "td", "blockquote", "li", "dd") else owner
        for level in range(5):
            points[node] += gained / (1 if level == 0 else 2 if level == 1 else level * 3)
            if not node:
                break
            node = page.parents[node]
    return [
        x * (1 - page.linked[i] / page.chars[i]) if page.chars[i] else 0.0 for i, x in enumerate(points)
    ]


def _is_menu(page: _Page, owner: int) -> bool:
    """Whether the whole list around a block of links is a menu; a block in no list is one by itself."""
    whole, node = owner, owner
    while node and page.tags[node] not in SEMANTIC:
        if page.tags[node] == "table":
            return False
        if page.tags[node] in LISTS:
            whole = node
        node = page.parents[node]
    short = page.chars[whole] < LEAST_PARAGRAPH * page.anchors[whole]
    return short and page.linked[whole] >= MENU_LINKED * page.chars[whole]


def main_text(markup: str) -> str:
    """Text of the best container and its fitting siblings, one line per block."""
    page = parse(markup)
    if not page.blocks:
        return ""
    scores = _scores(page)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    kept = {best}
    if scores[best] > 0:
        node = best
        while node:
            if page.tags[node] in SEMANTIC:
                kept = {node}
            node = page.parents[node]
        if kept == {best} and page.tags[best] not in SEMANTIC and best:
            for i in range(1, len(scores)):
                if page.parents[i] == page.parents[best] and not page.outside[i] and page.chars[i]:
                    few_links = page.linked[i] <= 0.25 * page.chars[i]
                    heading = page.tags[i] in ("h1", "h2", "h3")
                    if scores[i] >= SIBLING_SHARE * scores[best] or few_links and (page.chars[i] > 80 or heading):
                        kept.add(i)
    else:
        kept = {0}
    inside = [False] * len(page.tags)  # parents come before their children
    for i in range(len(page.tags)):
        inside[i] = i in kept or (i > 0 and inside[page.parents[i]])
    whole = kept == {0} or any(page.tags[i] in SEMANTIC for i in kept)
    lines = []
    for owner, text, linked in page.blocks:
        links = linked > LINKED * len(text) and page.tags[owner] in ("li", "td", "dd", "div", "ul")
        if inside[owner] and not (links and (not whole or _is_menu(page, owner))):
            lines.append(text)
    return "\n".join(lines)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in W.groups(batches, "html"):
        found = [main_text(x or "") for x in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(found, pa.string()),
             pa.array(map(len, found), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, without a shuffle."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
