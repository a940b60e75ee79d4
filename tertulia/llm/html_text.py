"""Main text of web pages by composite text density.

A page becomes a tree of elements. An element's density is its characters per tag, adjusted for links: text inside links
counts against it, by the page's own share of linked text. The sum of the densities of its children says how much dense
text stands side by side below an element; the main text lies where that sum is largest. If that is inside an article (or,
without one, inside main), all of the article is taken: its headings and short sections, too. From there on the outermost
element is taken that adds hardly any links. The least density on the path from the densest part to the body is the page's
threshold, and other subtrees that reach it give their densest part too, with the article around it.

Elements that by their name, role or class are no article (menus, footers, sidebars, notices, adverts, forms, reader
comments) are taken out before. What only a class, id, role, ``hidden`` or a form says does not take out the article itself:
an element that holds an article or most of the page's text outside of links stays. Tags are read by one regular expression, from left to right; ends that are missing are
implied as browsers do for paragraphs, list items and table cells. Time and memory are linear in the page.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tertulia.llm.tables import box, unbox

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?", re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements that are never part of an article.
OUTSIDE = RAW | frozenset("head nav header footer aside button select option input menu dialog svg math canvas object video audio".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words of class and id attributes that name what is no article. A compound is named by its last part ("reader-comments") or
# by what a list or box of it holds ("comment-list"); others ("share-enabled", "has-sidebar") may just mention it.
NOTES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsored sponsor promo promoted promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside widget widgets related recommended footer header masthead cookie cookies consent notice notices popup modal overlay newsletter subscribe "
    "signup login share sharing social comment comments respond disqus form search pagination pager toolbar copyright".split()
)
BOXES = frozenset("list lists section area block box wrapper wrap container thread threads bar panel zone group holder item items feed".split())
MENTIONS = frozenset("has have with without no not is show shows hide hides enable enabled disable disabled before after".split())
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
# How much an element's marks say that it is no article.
PLAIN, HINTED, CALLED, NAMED = 0, 1, 2, 3
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
FEW_LINKS = 0.05  # share of linked characters
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("html body article section main div ul ol dl table td th blockquote".split())


def _mark(tag: str, attributes: str) -> int:
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return HINTED if tag == "form" else PLAIN
    mark, seen = HINTED if tag == "form" else PLAIN, set()
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if name in seen:  # the first of a name counts
            continue
        seen.add(name)
        if name == "role":
            if value.strip() in ROLES:
                return NAMED
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return NAMED
        elif name in ("class", "id"):
            mark = max([mark, *map(_name_mark, value.split())])
            if mark == NAMED:
                return NAMED
    return mark


def _name_mark(word: str) -> int:
    """What one word of a class or id attribute says."""
    parts = [p for p in re.split(r"[^a-z]+", word) if p]
    if word in NOTES:
        return NAMED
    if NOTES.isdisjoint(parts):
        return PLAIN
    outright = parts[-1] in NOTES or (len(parts) > 1 and parts[-1] in BOXES and parts[-2] in NOTES)
    return CALLED if outright and MENTIONS.isdisjoint(parts) else HINTED


class _Page:
    """Elements in page order; ``pieces`` are texts and breaks between blocks, each with its element."""

    def __init__(self, source: str):
        self.tags, self.parents, self.skipped, self.marks = ["#page"], [-1], [False], [PLAIN]
        self.pieces: list[tuple[int, str | None]] = []
        stack, at = [0], 0
        lowered: str | None = None  # made once, for pages with raw elements that do not end in the usual form
        while True:
            m = TAG.search(source, at)
            end = m.start() if m else len(source)
            if end > at:
                self._text(stack[-1], source[at:end])
            if not m:
                break
            at, tag = m.end(), (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                self._close(stack, tag)
                continue
            self._imply(stack, tag)
            node = self._open(stack[-1], tag, m[3])
            if tag in RAW:
                stop = source.find(f"</{tag}", at)
                if stop < 0:
                    lowered = source.lower() if lowered is None else lowered
                    stop = lowered.find(f"</{tag}", at) if len(lowered) == len(source) else -1
                at = len(source) if stop < 0 else source.find(">", stop) + 1 or len(source)
            elif tag not in VOID and not m[3].endswith("/"):
                stack.append(node)
        self._take_out()

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.skipped.append(self.skipped[parent] or tag in OUTSIDE)
        self.marks.append(PLAIN if self.skipped[-1] else _mark(tag, attributes))
        if tag not in INLINE:
            self.pieces.append((parent, None))
        return len(self.tags) - 1

    def _text(self, node: int, text: str) -> None:
        if not self.skipped[node]:
            self.pieces.append((node, html.unescape(text) if "&" in text else text))

    def _close(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tags[stack[k]] == tag:
                del stack[k:]
                break
            if tag in INLINE and self.tags[stack[k]] not in INLINE:
                return  # the end of something that began outside this block
        if tag not in INLINE:
            self.pieces.append((stack[-1], None))

    def _imply(self, stack: list[int], tag: str) -> None:
        """End what a new element ends without saying so."""
        ends = CLOSES.get(tag) or (() if tag in INLINE or tag in VOID else ("p",))
        for k in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[k]]
            if open_tag in ends:
                del stack[k:]
                return
            if open_tag in SCOPES:
                return


    def _unlinked(self) -> list[int]:
        """Characters outside of links in each element, without what is skipped."""
        n = len(self.tags)
        chars, in_link = [0] * n, [False] * n
        for i in range(1, n):
            in_link[i] = self.tags[i] == "a" or in_link[self.parents[i]]
        for node, text in self.pieces:
            if text and not in_link[node] and not self.skipped[node]:
                chars[node] += len("".join(text.split()))
        for i in range(n - 1, 0, -1):
            chars[self.parents[i]] += chars[i]
        return chars

    def _skip(self, mark: int, stays: list[bool]) -> None:
        for i in range(1, len(self.tags)):
            if self.skipped[self.parents[i]] or (self.marks[i] == mark and not stays[i]):
                self.skipped[i] = True

    def _take_out(self) -> None:
        """Skip marked elements, unless they hold an article or most of the text outside of links.

        What is named outright goes, too, where an article stands beside it (comments are often articles); so does what a
        compound names then, which is a hint otherwise. Where nothing would be left, hints count for nothing.
        """
        if not any(self.marks):
            return
        n = len(self.tags)
        holds, named, beside = [False] * n, [False] * n, False
        for i in range(1, n):
            named[i] = named[self.parents[i]] or self.marks[i] >= CALLED
            if self.tags[i] in ("article", "main") and not self.skipped[i]:
                holds[i] = True
                beside = beside or not named[i]
        for i in range(n - 1, 0, -1):
            holds[self.parents[i]] |= holds[i]
        self.marks = [(NAMED if beside else HINTED) if mark == CALLED else mark for mark in self.marks]
        chars = self._unlinked()
        self._skip(NAMED, [not beside and (h or 2 * c > chars[0]) for h, c in zip(holds, chars)])
        chars, before = self._unlinked(), list(self.skipped)
        self._skip(HINTED, [h or 2 * c > chars[0] for h, c in zip(holds, chars)])
        if not self._unlinked()[0]:
            self.skipped = before


def main_text(source: str | None) -> str:
    """The blocks of the main text in page order, white space in each turned into single blanks, joined by a blank."""
    if not source:
        return ""
    page = _Page(source)
    n = len(page.tags)
    chars, linked, tags, links = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in page.pieces:
        if text and not page.skipped[node]:
            chars[node] += len("".join(text.split()))
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = page.tags[i] == "a" or in_link[page.parents[i]]
        if in_link[i]:
            linked[i] = chars[i]
    for i in range(n - 1, 0, -1):
        if page.skipped[i]:
            continue
        p = page.parents[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        tags[p] += tags[i] + (page.tags[i] != "br")
        links[p] += links[i] + (page.tags[i] == "a")
    if not chars[0]:
        return ""
    body = next((i for i in range(n) if page.tags[i] == "body"), 0)
    if chars[body] < chars[0]:
        body = 0  # text outside of the body, as in broken pages
    share = linked[body] / chars[body]
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        if chars[i] and not page.skipped[i]:
            c, lc, t, lt = chars[i], linked[i], max(1, tags[i]), max(1, links[i])
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            density[i] = c / t * math.log(max(1.0, c / max(1, lc) * t / lt) + 1) / math.log(base + 1)
    for i in range(n - 1, 0, -1):
        sums[page.parents[i]] += density[i]
    best = list(range(n))  # the largest sum at or below each element; of equal ones the outermost
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        if sums[best[i]] >= sums[best[p]] and sums[best[i]] > sums[p]:
            best[p] = best[i]
    top = best[body]
    least, i = density[top], top
    while i > body:
        i = page.parents[i]
        least = min(least, density[i])
    # the outermost article around each element, or the outermost main if there is no article
    around, mains, articles, heads = [-1] * n, [-1] * n, [0] * n, [0] * n
    for i in range(1, n):
        p, tag = page.parents[i], page.tags[i]
        around[i] = i if around[p] < 0 and tag == "article" else around[p]
        mains[i] = i if mains[p] < 0 and tag == "main" else mains[p]
    for i in range(n - 1, 0, -1):
        if not page.skipped[i]:
            if page.tags[i] in HEADINGS:
                heads[i] = chars[i]
            articles[page.parents[i]] += articles[i] + (page.tags[i] == "article")
            heads[page.parents[i]] += heads[i]

    def whole(i: int) -> int:
        return around[i] if around[i] >= 0 else mains[i] if mains[i] >= 0 else i

    chosen = [False] * n
    main = i = whole(top)
    plain = around[top] < 0 and mains[top] < 0
    few = max(FEW_LINKS, linked[main] / max(1, chars[main]))
    while i > body:
        i = page.parents[i]
        added = chars[i] - chars[main]
        if linked[i] - linked[main] > few * added:
            continue
        # beside a marked article only what belongs to it: more articles, headings, the rest of main
        if plain or page.tags[i] == "main" or articles[i] > articles[main] + (page.tags[main] == "article") or heads[i] - heads[main] == added:
            main = i
    chosen[main] = True
    seen = [False] * n
    for i in range(body, n):
        p = page.parents[i]
        seen[i] = chosen[i] or (p >= 0 and seen[p])
        if not seen[i] and i != body and not page.skipped[i] and density[i] >= least and chars[i]:
            inside = best[i]
            if sums[inside] > 0 or page.tags[i] not in INLINE:
                chosen[whole(inside) if around[inside] >= 0 else inside] = True
                seen[i] = chosen[i]
    for i in range(body + 1, n):
        chosen[i] = chosen[i] or chosen[page.parents[i]]
    blocks, block = [], []
    for node, text in page.pieces:
        if text is None:
            blocks.append("".join(block))
            block = []
        elif chosen[node] and not page.skipped[node]:
            block.append(text)
    blocks.append("".join(block))
    return " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def extract_text(pages: DataFrame, source: str = "html", into: str = "text") -> DataFrame:
    """All columns of ``pages`` but the page source, plus the main text and its length in code points (``n_chars``).

    A null, empty or textless page has an empty text. Rows are treated one by one, so repeated rows give equal results.

    A ``header`` element goes wherever it stands, with a title in it; headings outside of one are text.
    """

    boxed = box(pages, source=pages[source]).withColumn("found", _main_texts("source"))
    found = unbox(boxed, added={into: F.col("found"), "n_chars": F.length("found").cast("long")})
    return found.drop(source) if source != into else found


@F.pandas_udf(T.StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(page) for page in pages], dtype=object)
