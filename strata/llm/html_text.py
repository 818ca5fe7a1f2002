"""Main text of web pages by composite text density over the document tree."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements that never hold article text.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input label fieldset "
    "iframe object embed svg canvas math audio video map dialog menu".split()
)
# Words of class and id attributes, and roles, that mark such parts in other elements.
NOISE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar "
    "cookie cookies consent gdpr notice notification alert popup modal overlay disclaimer "
    "comment comments commentlist reply replies respond disqus discussion "
    "share sharing social related recommended newsletter subscribe signup login search pagination pager widget "
    "hidden".split()
)
# What long threads of readers are marked with: much text does not make them the article.
TALK_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
# Words that say, before one of those words, that the element is not such a part.
NEGATING = frozenset("no not non with without has have overflow".split())
CONTENT_WORDS = frozenset("article content entry main page post story text".split())
#: Share of a page's text outside links from which on a class or id word alone does not drop an element.
LEAST_SHARE = 0.5
#: Text in articles and main parts, as a share of a marked element's outside them, from which on these are the page's text.
LEAST_ROOTED = 0.1
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ROOTS = frozenset(("article", "main"))
# Elements that may stand in a head; any other start tag ends it.
IN_HEAD = frozenset("head base basefont bgsound link meta title style script noscript noframes template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
BLOCKS = HEADINGS | frozenset(
    "html body p div section article main header footer nav aside blockquote pre ul ol li dl dt dd table caption thead tbody "
    "tfoot tr figure figcaption address hr form fieldset details summary center hgroup".split()
)
SPACED = frozenset("br td th".split())
# A start tag that ends an open element of the second kind, up to an element of the third.
ENDED_BY = {
    **{t: ({"p"}, frozenset(("table", "td", "th", "li", "article", "main", "body", "div", "section"))) for t in BLOCKS - {"html", "body"}},
    "li": ({"li", "p"}, frozenset(("ul", "ol"))),
    "dt": ({"dt", "dd", "p"}, frozenset(("dl",))), "dd": ({"dt", "dd", "p"}, frozenset(("dl",))),
    "tr": ({"tr", "td", "th", "p"}, frozenset(("table",))),
    "td": ({"td", "th", "p"}, frozenset(("tr", "table"))), "th": ({"td", "th", "p"}, frozenset(("tr", "table"))),
    "option": ({"option"}, frozenset(("select",))),
}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_MARKED = re.compile(r"<!\[[^>]*>")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Tree(HTMLParser):
    """Elements in page order with their parents, and the page's text as (element, text) with None at block ends."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.dropped = ["#"], [-1], [False]
        # Inside a part that is marked by a class or id word, whatever comes of it; roots that such parts don't take along.
        self.doubtful, self.freed = [False], [False]
        self.suspects: dict[int, set[str]] = {}
        self.contents: set[int] = set()
        self.flow: list[tuple[int, str] | None] = []
        self.open: list[int] = [0]
        self.counts: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        if self.counts.get("head") and tag not in IN_HEAD and (
            tag == "body" or not self.counts.get("template") and not self.counts.get("title")
        ):
            self._end_head()
        if tag in ENDED_BY:
            ended, until = ENDED_BY[tag]
            if any(self.counts.get(t) for t in ended):
                for at in range(len(self.open) - 1, 0, -1):
                    name = self.tags[self.open[at]]
                    if name in until:
                        break
                    if name in ended:
                        self._close(at)
                        # A table cell may end with its row: go on outward.
        parent = self.open[-1]
        attrs = dict(attrs)
        node = len(self.tags)
        marked, words = tag not in DROPPED and self._marked(tag, attrs), self._noise_words(tag, attrs)
        freed = tag in ROOTS and not marked and not words  # an article is read even where an element before it was left open
        dropped = tag in DROPPED or not freed and (self.dropped[parent] or marked)
        if words:
            self.suspects[node] = words
        self.doubtful.append(dropped or bool(words) or not freed and self.doubtful[parent])
        self.freed.append(freed)
        self.tags.append(tag)
        self.parents.append(parent)
        self.dropped.append(dropped)
        if tag in BLOCKS:
            self.flow.append(None)
        elif tag in SPACED:
            self.flow.append((parent, " "))
        if tag not in VOID:
            self.open.append(node)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        # In HTML a slash does not close an element, except in drawings and formulas, which are dropped anyway.
        if tag not in VOID and (tag in DROPPED or self.doubtful[self.open[-1]]):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.counts.get(tag):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[at]] == tag:
                self._close(at)
                return

    def _close(self, at):
        for node in self.open[at:]:
            self.counts[self.tags[node]] -= 1
            if self.tags[node] in BLOCKS:
                self.flow.append(None)
        del self.open[at:]

    def _end_head(self):
        at = next(i for i in range(len(self.open) - 1, 0, -1) if self.tags[self.open[i]] == "head")
        self._close(at)

    def _marked(self, tag, attrs):
        if tag in ("html", "body"):
            return False
        if (tag == "header" or attrs.get("role") == "banner") and not self._in_root():
            return True
        if not attrs:
            return False
        if attrs.get("role") in NOISE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        return bool(_HIDDEN.search(attrs.get("style") or ""))

    def _noise_words(self, tag, attrs):
        """Words of class and id that mark the element, unless a word before them negates them."""
        if tag in ("html", "body") or not attrs:
            return set()
        found, words, clean = set(), set(), False
        for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
            own = [w.lower() for w in _WORDS.findall(name)]
            words |= set(own)
            noise = {w for i, w in enumerate(own) if (w in NOISE_WORDS or w == "header") and (not i or own[i - 1] not in NEGATING)}
            found |= noise
            clean = clean or not noise and bool(CONTENT_WORDS & set(own))
        if "header" in found and (words & {"article", "entry", "post", "content"} or tag in HEADINGS or self._in_root()):
            found.discard("header")
        if clean and found:
            self.contents.add(len(self.tags))
        return found

    def settle(self):
        """Drop the marked elements that hold little of the page's text outside links or stand beside an article, and readers' threads."""
        if not self.suspects:
            return
        n = len(self.tags)
        linked, held = [False] * n, [0] * n
        for i in range(1, n):
            linked[i] = self.tags[i] == "a" or linked[self.parents[i]]
        for piece in self.flow:
            if piece and not linked[piece[0]] and not self.dropped[piece[0]]:
                held[piece[0]] += len(piece[1].strip())
        least = sum(held) * LEAST_SHARE
        for i in range(n - 1, 0, -1):
            if not self.freed[i]:
                held[self.parents[i]] += held[i]
        rooted, in_root = sum(held[i] for i in range(n) if self.freed[i]), self.freed[:]
        for i in range(1, n):
            in_root[i] = in_root[i] or in_root[self.parents[i]]
            if i in self.suspects and not self.dropped[i]:
                talk = self.suspects[i] & TALK_WORDS and i not in self.contents
                beside = not in_root[i] and rooted and rooted >= held[i] * LEAST_ROOTED
                self.dropped[i] = bool(talk) or not held[i] or held[i] < least or bool(beside)
            if not self.freed[i] and self.dropped[self.parents[i]]:
                self.dropped[i] = True
        self.flow = [piece for piece in self.flow if piece is None or not self.dropped[piece[0]]]

    def _in_root(self):
        return self.counts.get("article", 0) + self.counts.get("main", 0) > 0

    def handle_data(self, data):
        if self.tags[self.open[-1]] == "head" and data.strip():
            self._end_head()
        node = self.open[-1]
        if not self.dropped[node]:
            self.flow.append((node, data))


def _densities(tree: _Tree) -> tuple[list[float], list[float]]:
    """Composite text density of each element, and the sum of its children's."""
    n = len(tree.tags)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = tree.tags[i] == "a" or linked[tree.parents[i]]
    for piece in tree.flow:
        if piece:
            size = len(piece[1].strip())
            chars[piece[0]] += size
            if linked[piece[0]]:
                link_chars[piece[0]] += size
    for i in range(n - 1, 0, -1):
        p = tree.parents[i]
        if tree.dropped[i] and not chars[i]:
            continue
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i] + (tree.tags[i] == "a")
    share = link_chars[0] / max(chars[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c = chars[i]
        if c:
            t, lc, lt = max(tags[i], 1), max(link_chars[i], 1), max(link_tags[i], 1)
            base = math.log(c / max(c - link_chars[i], 1) * link_chars[i] + share * c + math.e)
            # The base is 1 where a page has no link text: the logarithm is then to the base e.
            factor = math.log(c / lc * t / lt) / (math.log(base) if base > 1.0000001 else 1.0)
            density[i] = c / t * max(factor, 0.0)
        if i:
            sums[tree.parents[i]] += density[i]
    return density, sums


def _chosen(tree: _Tree) -> set[int]:
    """Roots of the subtrees that hold the article."""
    density, sums = _densities(tree)
    n = len(tree.tags)
    best = max(range(n), key=lambda i: (sums[i], -i))
    path = [best]
    while tree.parents[path[-1]] >= 0:
        path.append(tree.parents[path[-1]])
    root = next((i for i in path if tree.tags[i] == "article"), None)
    if root is None:
        root = next((i for i in path if tree.tags[i] == "main"), None)
    if root is not None:
        return {root}
    body = next((i for i in path if tree.tags[i] == "body"), 0)
    threshold = min(density[i] for i in path[:path.index(body) + 1])
    inside = [False] * n
    inside[best] = True
    on_path = set(path)
    chosen = {best}
    for i in range(1, n):
        p = tree.parents[i]
        if inside[p]:
            inside[i] = True
        elif not inside[i] and i not in on_path and p in on_path and not tree.dropped[i]:
            if density[i] >= threshold > 0 or tree.tags[i] in HEADINGS:
                inside[i] = True
                chosen.add(i)
    return chosen


def main_text(html: str | None) -> str:
    """Article text of one page: blocks in page order, joined by two line ends; empty if there is none."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(_MARKED.sub("", html))
    # What the end of the page cuts off within a comment or tag is neither text nor an element.
    if re.match(r"<[a-zA-Z/!?]", tree.rawdata):
        tree.rawdata = ""
    tree.close()
    tree.settle()
    chosen = _chosen(tree)
    inside = [i in chosen for i in range(len(tree.tags))]
    for i in range(1, len(inside)):
        inside[i] = inside[i] or inside[tree.parents[i]]
    blocks, held = [], []
    for piece in (*tree.flow, None):
        if piece is None:
            if held and (text := " ".join("".join(held).split())):
                blocks.append(text)
            held = []
        elif inside[piece[0]] and not tree.dropped[piece[0]]:
            held.append(piece[1])
    return "\n\n".join(blocks)


@F.pandas_udf(StringType())
def _texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text, na_action=None)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """Add the article's text to each row, without a shuffle.

    Null, empty and text-free pages give an empty text. Whole pages are read, in any nesting depth,
    without recursion. A column named ``into`` is replaced; other columns and repeated rows stay.
    """
    return pages.withColumn(into, _texts(F.coalesce(F.col(html), F.lit(""))))
