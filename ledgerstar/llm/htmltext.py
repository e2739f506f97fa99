"""Main text of HTML pages by composite text density.

Every element gets a density: characters per tag, adjusted by how much of its
text stands in links and by the page's share of link text. An element's
density sum adds up its children's densities; the element with the largest
sum is where dense blocks stand side by side, so it holds the article. The
smallest density on the path from it up to the body is the page's threshold:
blocks outside it that reach the threshold are content too. If the element
lies in an ``article`` or ``main``, that element is the article, and nothing
outside it is.

Menus, headers, footers, asides, controls, scripts, styles and what is hidden
are taken out of the tree beforehand. So are, whatever their size, elements
whose class, id or role names boilerplate, as long as text outside links is
left; never a heading or a paragraph, and never what wraps the page, that is,
holds its first main heading and its densest element. A form is taken out if it has a small share of
the page's text outside links, or is mostly links.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe title svg noembed noframes object canvas".split())
#: Its content is shown as it stands.
VERBATIM = "xmp"
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr output q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr "
                   # formulas
                   "math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot munder mover munderover mstyle mpadded mphantom "
                   "mfenced menclose mmultiscripts mprescripts none mtable mtr mtd".split())
DROPPED = frozenset("head nav header footer aside button select option datalist dialog menu audio video annotation annotation-xml".split())
#: Elements that may be boilerplate by their size, and those that no name takes out.
FORMS = frozenset(("form", "fieldset"))
KEPT = frozenset("html body p h1 h2 h3 h4 h5 h6".split())
#: A form goes with at most so much of the page's text outside links, or at least so much of its own text in links.
SMALL_SHARE, LINK_SHARE = 0.3, 0.5
#: What may stand in a head; anything else ends it.
HEAD_CONTENT = frozenset("html head title base link meta style script noscript template basefont bgsound noframes".split())
#: Elements that may close themselves.
FOREIGN = frozenset(("svg", "math"))
#: Words in class, id or role that name boilerplate.
BOILERPLATE = frozenset("ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
                        "cookies contentinfo complementary discussion disqus footer form gdpr header login masthead menu modal nav navbar navigation "
                        "newsletter notice notices popup promo promotion related replies respond search share sharing sidebar signup social sponsor sponsored "
                        "subscribe subscription toolbar widget alert".split())
LAYOUT = frozenset("has with no without".split())
ARTICLE = frozenset(("article", "main"))
#: Which open elements a start tag ends, and the elements that shield those outside.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "thead": ({"thead", "tbody", "tfoot", "tr"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"})}
SHIELD = frozenset("td th caption table button object body html".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)>|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Tree:
    """Elements in page order: tag, parent, attributes, and the pieces of the
    page: (element, text) or (element, None) where a block begins or ends.
    The content of ``raw`` elements is left out; ``inline`` ones part no blocks."""

    def __init__(self, page: str, raw: frozenset[str] = RAW, inline: frozenset[str] = INLINE):
        self.tag, self.parent, self.attr, self.pieces = ["#page"], [-1], [""], []
        stack, open_count = [0], {"#page": 1}

        def pop() -> None:
            e = stack.pop()
            open_count[self.tag[e]] -= 1
            if self.tag[e] not in inline:
                self.pieces.append((stack[-1], None))

        def close(names, shield) -> None:
            """End the nearest open element of ``names``, unless one of ``shield`` lies between."""
            if not any(open_count.get(n) for n in names):
                return
            for depth in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[depth]]
                if t in names:
                    while len(stack) > depth:
                        pop()
                    return
                if t in shield:
                    return

        at, end = 0, len(page)
        while at < end:
            m = _TOKEN.search(page, at)
            start = end if m is None else m.start()
            if start > at:
                if open_count.get("head") and self.tag[stack[-1]] == "head" and not page[at:start].isspace():
                    pop()
                self.pieces.append((stack[-1], page[at:start]))
            if m is None:
                break
            at = m.end()
            if m[2] is None:
                continue
            t = m[2].lower()
            if m[1]:
                if t not in VOID:
                    close({t}, ())
                elif t == "br":
                    self.pieces.append((stack[-1], None))
                continue
            if open_count.get("head") and t not in HEAD_CONTENT:
                close({"head"}, {"body"})
            if t not in inline:
                if t not in VOID or t == "hr":
                    close({"p"}, SHIELD)
                if t in CLOSES:
                    close(*CLOSES[t])
                self.pieces.append((stack[-1], None))
            e = len(self.tag)
            self.tag.append(t)
            self.parent.append(stack[-1])
            self.attr.append(m[3])
            if t in FOREIGN and m[3].endswith("/"):
                continue
            if t in raw or t == VERBATIM:  # its content is no markup
                stop = re.compile(f"</{re.escape(t)}\\s*>", re.I).search(page, at)
                if t == VERBATIM:
                    self.pieces.append((e, page[at:stop.start() if stop else end].replace("&", "&amp;")))
                    self.pieces.append((stack[-1], None))
                at = stop.end() if stop else (end if t in ("script", "style", "textarea", VERBATIM) else at)
            elif t not in VOID and not m[3].endswith("/"):
                stack.append(e)
                open_count[t] = open_count.get(t, 0) + 1


def _named(attributes: str) -> set[str]:
    words: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name in ("class", "id", "role"):
            value = m[2] or m[3] or m[4] or ""
            words.update(x.lower() for x in _NAME_PART.findall(value))
            words.update(re.split(r"[^a-z0-9]+", value.lower()))
        elif name == "hidden" or name == "style" and _HIDDEN.search(m[2] or m[3] or m[4] or ""):
            words.add("#hidden")
    return words


def boilerplate(t: Tree) -> list[bool]:
    """Which elements are taken out, with all inside them."""
    n = len(t.tag)
    holds = [tag in ARTICLE for tag in t.tag]  # an article, or has one inside
    for e in range(n - 1, 0, -1):
        if holds[e]:
            holds[t.parent[e]] = True
    out, named, forms = [False] * n, [], []
    for e in range(1, n):
        tag = t.tag[e]
        if out[t.parent[e]] or tag in RAW or tag in DROPPED and not (tag == "header" and holds[e]):
            out[e] = True
            continue
        words = _named(t.attr[e]) if t.attr[e] and tag not in ("html", "body") else set()
        out[e] = bool("#hidden" in words or tag == "article" and words & {"comment", "comments"})
        if not out[e] and not holds[e] and tag not in KEPT:
            if words & BOILERPLATE and not words & LAYOUT:
                named.append(e)
            elif tag in FORMS:
                forms.append(e)
    if named:
        _take_named(t, out, named)
    if forms:
        chars, links = sizes(t, out)
        holding = _path(t, _densest(t, out))
        for e in forms:
            if e not in holding:
                out[e] = out[e] or chars[e] - links[e] <= SMALL_SHARE * (chars[0] - links[0]) or links[e] >= LINK_SHARE * chars[e]
    for e in range(1, n):
        out[e] = out[e] or out[t.parent[e]]
    return out


def _take_named(t: Tree, out: list[bool], named: list[int]) -> None:
    """Take out the named elements, but for those that wrap the page."""
    n = len(t.tag)
    heading = next((e for e in range(n) if t.tag[e] == "h1" and not out[e]), -1)
    wraps = _path(t, heading) & _path(t, _densest(t, out)) if heading > 0 else set()
    taken = [e for e in named if e not in wraps]
    without = out[:]
    for e in taken:
        without[e] = True
    for e in range(1, n):
        without[e] = without[e] or without[t.parent[e]]
    chars, links = sizes(t, without)
    if chars[0] > links[0]:
        out[:] = without
        return
    # names alone hold the text: the densest of them is the article, without what is named inside
    best = _path(t, _densest(t, out))
    for e in taken:
        out[e] = out[e] or e not in best
    for e in range(1, n):
        out[e] = out[e] or out[t.parent[e]]


def _densest(t: Tree, out: list[bool]) -> int:
    sums = densities(t, out)[1]
    return max(range(len(sums)), key=lambda e: (sums[e], -e))


def _path(t: Tree, e: int) -> set[int]:
    """An element and all that hold it."""
    path = set()
    while e >= 0:
        path.add(e)
        e = t.parent[e]
    return path


def sizes(t: Tree, out: list[bool]) -> tuple[list[int], list[int]]:
    """Characters of each element, and those of them in links."""
    n = len(t.tag)
    chars, links, in_link = [0] * n, [0] * n, [False] * n
    for e in range(1, n):
        in_link[e] = t.tag[e] == "a" or in_link[t.parent[e]]
    for e, text in t.pieces:
        if text is not None and not out[e]:
            size = sum(map(len, text.split()))
            chars[e] += size
            if in_link[e]:
                links[e] += size
    for e in range(n - 1, 0, -1):
        if not out[e]:
            chars[t.parent[e]] += chars[e]
            links[t.parent[e]] += links[e]
    return chars, links


def densities(t: Tree, out: list[bool]) -> tuple[list[float], list[float]]:
    """Composite text density of each element, and the sum over its children."""
    n = len(t.tag)
    chars, links = sizes(t, out)
    tags, link_tags = [0] * n, [0] * n
    for e in range(n - 1, 0, -1):
        if not out[e]:
            p = t.parent[e]
            tags[p] += tags[e] + 1
            link_tags[p] += link_tags[e] + (t.tag[e] == "a")
    page = links[0] / max(1, chars[0])
    density, sums = [0.0] * n, [0.0] * n
    for e in range(n):
        if chars[e] and not out[e]:
            c, lc, k, lk = chars[e], max(1, links[e]), max(1, tags[e]), max(1, link_tags[e])
            base = math.log(c / max(1, c - links[e]) * links[e] + page * c + math.e)
            density[e] = c / k * (math.log(c / lc * k / lk) / math.log(base) if base > 1 else math.log(c / lc * k / lk + math.e))
    for e in range(1, n):
        if not out[e]:
            sums[t.parent[e]] += density[e]
    return density, sums


def content(t: Tree, out: list[bool]) -> list[bool]:
    """Which elements belong to the article."""
    n = len(t.tag)
    density, sums = densities(t, out)
    best = max(range(n), key=lambda e: (sums[e], -e))
    body = next((e for e in range(n) if t.tag[e] == "body"), 0)
    path = [best]
    while t.parent[path[-1]] >= 0:
        path.append(t.parent[path[-1]])
    threshold = min(density[e] for e in path[:path.index(body) + 1] or path) if body in path else min(density[e] for e in path)
    holders = [e for e in path if t.tag[e] in ARTICLE]
    root = holders[-1] if holders else best
    above = set(path[path.index(root) + 1:])
    inside = [False] * n
    inside[root] = True
    for e in range(n):
        if e == root or out[e]:
            inside[e] = e == root and not out[e]
        elif e > 0 and (inside[t.parent[e]] or not holders and t.parent[e] in above and e not in above and density[e] >= threshold):
            inside[e] = True
    for e in above:  # text that stands beside the chosen element, in no element of its own
        inside[e] = False
    return inside


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by one space."""
    if not page:
        return ""
    t = Tree(page.replace("\0", "�"))
    out = boilerplate(t)
    inside = content(t, out)
    blocks, now = [], []
    for e, text in t.pieces:
        if text is None:
            if now:
                blocks.append("".join(now))
                now = []
        elif inside[e] and not out[e]:
            now.append(html.unescape(text) if "&" in text else text)
    if now:
        blocks.append("".join(now))
    return " ".join(w for b in blocks for w in b.split())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``.

    Null and empty pages, and pages without any text, give an empty text.
    A very long page is read whole, in one pass over its markup.
    Text outside all tags counts as the body's. Every row is taken by itself:
    repeated rows and ids come back as often as they are given, null ids and
    urls stay null. Other columns are ignored; an empty table gives no rows.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for page_id, url, page in arrow_rows(batches):
                text = main_text(page)
                yield page_id, url, text, len(text)
        return arrow_out(schema, rows(), weight=lambda r: len(r[2]))

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
