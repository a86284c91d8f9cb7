"""Main text of web pages by composite text density.

Every DOM node has a density: its characters per tag, raised or lowered by how much of it is link text.
A node's sum is that of its children's densities. The node with the largest sum is taken as the heart of
the page; the threshold is the smallest density on the path from it up to the body. Where the heart lies
in an ``article`` or ``main`` element, the outermost such element is the text; else the text is, of every
node that reaches the threshold, the descendant (or itself) with the largest sum.

Menus, footers, asides, scripts and styles are taken out of the tree first, by element and by ARIA role, as is
what is hidden. A header, a form and what the words of class and id name as a sidebar, notice, advert, reader
comments and the like are doubted only: such an element stays where it holds an article or main element of weight,
or most of the page's prose, so that a wrapper does not take the page with it. Where the name only contains such a
word (``related-work``, ``no-sidebar``), the element goes if a third of it is link text, and outside articles also
if it is half as dense as the page or less. A header inside an article is the article's own and stays.

Defined results: a null or empty page gives the empty text, as does a page without text outside what is
taken out; unclosed and stray tags are mended as browsers do (a new block ends an open paragraph); text
without a body element counts as in the body; deep nesting needs no recursion. Equal pages give equal
texts, nothing is cut, and further columns of the input are kept by ``extract``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.common import small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: An open element of the first kind ends where one of the second begins (not beyond the third).
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: A paragraph stays open inside these.
SCOPE = frozenset("button table td th caption object template html".split())

TAKEN_OUT = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video map nav footer aside "
    "button select textarea input dialog menu title".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets footer masthead related recommended recommendations share "
    "sharing social toolbar pagination pager".split()
)
NEVER = frozenset("html body main".split())
# A name is what its last word says, these left out; after one of the second kind it says how the page looks.
FILLING = frozenset(
    "area bar block body box button buttons col column container content form group holder icons id inner item items list message outer "
    "panel posts row section slot text unit wrap wrapper".split()
)
TURNED = frozenset("no not non without with has have hide show open close closed enabled disabled is".split())
#: What an element is doubted for: a word within its name, its name, reader comments, being a form.
WITHIN, NAMED, COMMENTS, FORM = 1, 2, 3, 4
#: Link text from this share on is a list of links; a doubted element with this share of the page's text holds the page
#: (the second, of comments and where an article or main is elsewhere); an article has weight from this share of the largest one's on; prose has so many characters a tag.
LINKS, HOLDS, ALL_BUT_ALL, WEIGHT, PROSE = 1 / 3, 1 / 2, 9 / 10, 1 / 3, 10
_WORD = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class _Tree(HTMLParser):
    """The page as lists in page order: a node's tag and parent, and the pieces of text with their node."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.out, self.doubt, self.in_article = ["body"], [-1], [False], [0], [False]
        self.pieces: list[tuple[int, str | None]] = []  # None: a block begins or ends here
        self.open = [0]

    def _boilerplate(self, tag: str, names: dict) -> bool:
        if tag in TAKEN_OUT:
            return True
        if tag in NEVER or tag == "article":
            return False
        if names.get("role", "").lower() in ROLES or "hidden" in names or names.get("aria-hidden") == "true":
            return True
        return bool(_HIDDEN.search(names.get("style", "")))

    def _doubt(self, tag: str, names: dict, in_article: bool) -> int:
        if tag in NEVER:
            return 0
        found = 0
        for name in f"{names.get('class', '')} {names.get('id', '')}".lower().split():
            parts = _WORD.findall(name)
            own = [w for w in parts if w not in FILLING and not w.isdigit()]
            if own and not TURNED.intersection(own):
                if own[-1] in COMMENT_WORDS and not (in_article and own[-1] == "discussion"):
                    return COMMENTS
                if own[-1] in OTHER_WORDS or own[-1] == "header" and not in_article and tag not in ("h1", "h2"):
                    found = NAMED
            if not found and (OTHER_WORDS | COMMENT_WORDS).intersection(parts):
                found = WITHIN
        if tag == "article":
            return 0
        if tag == "form" or names.get("role", "").lower() == "form":
            return FORM
        return NAMED if tag == "header" and not in_article else found

    def _break(self, node: int) -> None:
        self.pieces.append((node, None))

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            if self.tag[self.open[-1]] in BLOCK:
                self._break(self.open[-1])
            self.open.pop()

    def _close_open(self, names, scope) -> None:
        for d in range(len(self.open) - 1, 0, -1):
            t = self.tag[self.open[d]]
            if t in names:
                self._close_to(d)
                return
            if t in scope:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return  # one body for all
        if tag in IMPLIED_END:
            self._close_open(*IMPLIED_END[tag])
        if tag in BLOCK:
            self._close_open({"p"}, SCOPE)
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.tag[self.open[-1]] in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._close_to(len(self.open) - 1)
        node, up = len(self.tag), self.open[-1]
        self.tag.append(tag)
        self.parent.append(up)
        names = {k: (v or "") for k, v in attrs}
        self.out.append(self.out[up] or self._boilerplate(tag, names))
        self.in_article.append(self.in_article[up] or self.tag[up] == "article")
        self.doubt.append(0 if self.out[node] else self._doubt(tag, names, self.in_article[node]))
        if tag in BLOCK:
            self._break(node)
        if tag == "br":
            self.pieces.append((node, " "))
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # browsers ignore the slash, except on void elements

    def handle_endtag(self, tag):
        for d in range(len(self.open) - 1, 0, -1):
            t = self.tag[self.open[d]]
            if t == tag:
                self._close_to(d)
                return
            if tag not in BLOCK and t in BLOCK and tag not in TAKEN_OUT:
                return  # an inline end tag doesn't end the block it stands in

    def handle_data(self, data):
        if data:
            self.pieces.append((self.open[-1], data))


def _squeezed(text: str) -> str:
    return " ".join(text.split())


def judge(tree: _Tree) -> None:
    """Take out the doubted elements that neither hold the page nor read like it."""
    n = len(tree.tag)
    if not any(tree.doubt):
        return
    chars, links, tags = [0] * n, [0] * n, [1] * n
    article, has_main = [0] * n, [False] * n  # the prose of the largest article within, and whether a main is
    for node, text in tree.pieces:
        if text is not None and not tree.out[node]:
            chars[node] += len(_squeezed(text))
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        if tree.out[i]:
            tags[p] += not tree.out[p]
            continue
        if tree.tag[i] == "a":
            links[i] = chars[i]
        if tree.tag[i] == "article" and tree.doubt[i] != COMMENTS and links[i] < LINKS * chars[i]:
            article[i] = max(article[i], chars[i] - links[i])
        chars[p] += chars[i]
        links[p] += links[i]
        tags[p] += tags[i]
        article[p] = max(article[p], article[i])
        has_main[p] |= has_main[i] or tree.tag[i] == "main"
    inside = [False] * n
    for i in range(1, n):
        p = tree.parent[i]
        inside[i] = inside[p] or tree.tag[p] in ("article", "main")
        if tree.out[p]:
            tree.out[i] = True
        kind = tree.doubt[i]
        if tree.out[i] or not kind:
            continue
        few_links, dense = links[i] < LINKS * chars[i], (chars[i] - links[i]) / tags[i]
        if has_main[i] or article[i] and article[i] >= WEIGHT * article[0]:
            continue
        rival = not inside[i] and (article[0] or has_main[0])  # an article or main that it is neither in nor around
        if chars[i] >= (ALL_BUT_ALL if kind == COMMENTS or rival else HOLDS) * chars[0] and few_links and dense >= PROSE:
            continue
        if kind == WITHIN and few_links and (tree.in_article[i] or dense > (chars[0] - links[0]) / tags[0] / 2):
            continue
        tree.out[i] = True


def densities(tree: _Tree) -> tuple[list[float], list[float], list[int]]:
    """Per node: density, sum of the children's densities, characters."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in tree.pieces:
        if text is not None and not tree.out[node]:
            chars[node] += len(_squeezed(text))
    for i in range(n - 1, 0, -1):  # children come after their parents
        if tree.out[i]:
            continue
        if tree.tag[i] == "a":
            link_chars[i], link_tags[i] = chars[i], 1
        p = tree.parent[i]
        chars[p] += chars[i]
        tags[p] += tags[i] + 1
        link_chars[p] += link_chars[i]
        link_tags[p] += link_tags[i]
    share = link_chars[0] / max(1, chars[0])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        if tree.out[i] or not chars[i]:
            continue
        c, t, lc, lt = chars[i], max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
        # the logarithm of the base is kept above 1, since it is 0 on pages without links
        base = math.log(c / max(1, c - link_chars[i]) * link_chars[i] + share * c + math.e)
        density[i] = c / t * math.log(max(math.e, c / lc * t / lt)) / max(1e-9, math.log(max(base, 1.0 + 1e-9)) + 1)
        if i:
            total[tree.parent[i]] += density[i]
    for i in range(n):
        if not total[i]:
            total[i] = density[i]  # a node without element children stands for itself
    return density, total, chars


def main_text(html: str | None) -> str:
    """The main text of one page; blocks joined by a line feed."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    judge(tree)
    density, total, chars = densities(tree)
    n = len(tree.tag)
    if not chars[0]:
        return ""
    heart = max((i for i in range(n) if not tree.out[i]), key=lambda i: (total[i], -i))
    path, widest = [heart], None
    while path[-1] > 0:
        path.append(tree.parent[path[-1]])
    for i in path:
        if tree.tag[i] in ("article", "main"):
            widest = i
    threshold = min(density[i] for i in path)
    chosen = [False] * n
    if widest is not None:
        chosen[widest] = True
    else:
        best = list(range(n))  # of each node's subtree, the node with the largest sum
        for i in range(n - 1, 0, -1):
            if not tree.out[i] and total[best[i]] > total[best[tree.parent[i]]]:
                best[tree.parent[i]] = best[i]
        for i in range(n):
            if not tree.out[i] and chars[i] and density[i] >= threshold:
                chosen[best[i]] = True
    for i in range(1, n):
        chosen[i] = (chosen[i] or chosen[tree.parent[i]]) and not tree.out[i]
    blocks, run = [], []
    for node, text in tree.pieces:
        if text is None:
            if run:
                blocks.append(_squeezed("".join(run)))
                run = []
        elif chosen[node]:
            run.append(text)
    blocks.append(_squeezed("".join(run)))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the column ``into`` in place of ``html`` (replacing a column of that name)."""
    small_batches(pages.sparkSession, 256)
    others = [c for c in pages.columns if c not in (html, into)]
    schema = pages.select(*others, F.col(html).alias(into)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(h) for h in b.column(len(others)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], texts], names=[*others, into])

    return pages.select(*others, F.col(html).alias(into)).mapInArrow(run, schema)
