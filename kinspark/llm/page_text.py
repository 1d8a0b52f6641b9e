"""Main text of web pages by tag-path ratios.

A page becomes a sequence of blocks (text between block-level tags), each with
its root-to-leaf tag path, path labels being tag names with their class words.
Per path the blocks' text outside links and their punctuation are added up:

* text ratio: characters outside links a block of the path;
* punctuation ratio: punctuation marks a block of the path;
* both are smoothed along the page with a Gaussian window, so that a heading or
  a short paragraph between long ones shares their standing, and fused as a
  product; a path's fused ratio is the mean over its blocks;
* paths from ``THRESHOLD`` of the text-weighted mean on are content paths.

What may compete is settled first: elements that are never article text by their
tag, role or hidden state, and elements whose class or id words name menus,
headers, footers, sidebars, notices, adverts, forms or reader comments, unless
such an element wraps the article itself (it holds <main> or <h1>, or most of
the page's text with an <article> or a class naming content; for comments only
<main> or <h1> count).  Content paths then point to content nodes: the <article> (<main>,
role=main, itemprop=articleBody) with most content text and its like on the same
path, whole but for lists of bare links; on a page without such an element, the
content paths' blocks, with what stands between the first and the last of them
and the headings right before.  Nothing is dropped for its length.

The parser is a single pass over tags (a regular expression with possessive
repeats, linear in the page) that follows the HTML rules for raw text, void
elements, and implied and stray end tags.  Inline elements do not break a block;
<br> counts as white space.  A page is one row from parsing to text, so nothing
is shuffled and pages of one host or many equal pages cost no more than others.

Defined results: null, empty and textless pages give an empty text; a page
without tags is one block; repeated rows and null ids keep their rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.session import table

THRESHOLD = 0.1
#: Blocks to each side that the Gaussian window reaches, and its spread.
REACH, SPREAD = 2, 1.0

# The HTML elements of each kind.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = _HEADINGS | frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form head header hgroup html legend li main menu nav object ol optgroup option p pre search section select summary svg table tbody "
    "td template tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_KEEPS_P = frozenset("caption td th button object template html body head optgroup option select svg canvas legend tbody tfoot thead tr".split())
_HEAD_ONLY = frozenset("meta title link style script base noscript template".split())
_SCOPE = frozenset("td th table caption object template button".split())
#: Open elements that a start tag ends, up to the nearest of the bounds.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr"}, {"table"}),
    **{t: ({"tr", "tbody", "thead", "tfoot", "caption"}, {"table"}) for t in ("tbody", "thead", "tfoot")},
}
_NEVER = frozenset(
    "head nav aside footer form button select option optgroup fieldset legend dialog menu object svg canvas template search".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
_OTHER_WORDS = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager topbar toolbar header masthead banner footer "
    "colophon copyright sidebar aside rail widget widgets ad ads advert adverts advertisement advertisements advertising adsense sponsor "
    "sponsors sponsored promo promos promoted promotion promotions cookie cookies consent gdpr notice notices notification notifications "
    "alert alerts popup modal overlay paywall disclaimer form forms login signin signup newsletter subscribe subscription search share "
    "sharing social related recommended recommendations".split()
)
_CONTENT_WORDS = frozenset("content article main post entry story body page wrapper container layout".split())

_COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))", re.S)
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>")
_BOGUS = re.compile(r"<(?:[!?]|/(?![A-Za-z]))[^>]*+>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_CUT_TAG = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？；،؟।]")
_ENDS_OF_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}


@dataclass(slots=True)
class Node:
    parent: int
    tag: str
    path: int
    words: frozenset = frozenset()
    main: bool = False  # an element that says it is the article
    never: bool = False  # not article text by tag, role or hidden state


@dataclass
class Page:
    """Nodes in page order (a parent before its children) and blocks (node, text, characters within links)."""

    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


@lru_cache(4096)
def _described(tag: str, attributes: str) -> tuple[frozenset, bool, bool]:
    """(class and id words, says it is the article, is never article text) of a start tag."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    words = frozenset(w.lower() for w in _NAME_PARTS.findall(f"{found.get('class', '')} {found.get('id', '')}"))
    role = found.get("role", "").lower()
    main = tag in ("article", "main") or role in ("main", "article") or "articlebody" in found.get("itemprop", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(found.get("style", "")))
    return words, main, tag in _NEVER or role in _ROLES or hidden


class _Parser:
    def __init__(self):
        self.page = Page([Node(-1, "", 0)])
        self.stack, self.open, self.paths = [0], Counter(), {}
        self.text: list[str] = []
        self.linked, self.in_link = 0, False

    def flush(self) -> None:
        joined = " ".join("".join(self.text).split())
        if joined:
            self.page.blocks.append((self.stack[-1], joined, self.linked))
        self.text, self.linked, self.in_link = [], 0, False

    def add(self, raw: str) -> None:
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            self.text.append(raw)
            if self.in_link:
                self.linked += len(" ".join(raw.split()))

    def pop(self) -> str:
        tag = self.page.nodes[self.stack.pop()].tag
        self.open[tag] -= 1
        return tag

    def pop_through(self, tags: set[str], bounds: frozenset | set) -> None:
        """Ends the elements up to the nearest of ``tags``, if one is open inside the nearest bound."""
        if any(map(self.open.get, tags)):
            for i in range(len(self.stack) - 1, 0, -1):
                tag = self.page.nodes[self.stack[i]].tag
                if tag in tags:
                    while len(self.stack) > i:
                        self.pop()
                    return
                if tag in bounds:
                    return

    def start(self, tag: str, attributes: str) -> None:
        if self.open["head"] and tag not in _HEAD_ONLY and tag not in ("html", "head"):
            self.flush()
            self.pop_through({"head"}, set())
        if tag == "a":
            self.in_link = True
        elif tag == "br":
            self.text.append(" ")
        elif tag == "hr":
            self.flush()
            self.pop_through({"p"}, _SCOPE)
        if tag not in _BLOCKS or (tag in ("html", "body") and self.open[tag]):
            return
        self.flush()
        if tag not in _KEEPS_P and self.open["p"]:
            self.pop_through({"p"}, _SCOPE)
        if tag in _HEADINGS and self.page.nodes[self.stack[-1]].tag in _HEADINGS:
            self.pop()
        if tag in _ENDS:
            ends, bounds = _ENDS[tag]
            while any(map(self.open.get, ends)):
                depth = len(self.stack)
                self.pop_through(ends, bounds)
                if len(self.stack) == depth:
                    break
        nodes, parent = self.page.nodes, self.stack[-1]
        words, main, never = _described(tag, attributes)
        if tag == "header" and not never:  # an article's own header keeps its headings
            never = not any(nodes[i].main for i in self.stack)
        path = self.paths.setdefault((nodes[parent].path, tag, words), len(self.paths) + 1)
        nodes.append(Node(parent, tag, path, words, main, never))
        self.stack.append(len(nodes) - 1)
        self.open[tag] += 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag not in _BLOCKS or tag in ("html", "body"):
            return
        self.flush()
        if tag in _HEADINGS:
            self.pop_through(set(_HEADINGS), _SCOPE)
        elif tag == "p" or tag not in _SCOPE:
            self.pop_through({tag}, _SCOPE)
        else:
            self.pop_through({tag}, {"table"} - {tag})


def parse(source: str) -> Page:
    p, at, last = _Parser(), 0, source.rfind(">") + 1
    while True:
        i = source.find("<", at, last)
        if i < 0:
            p.add(_CUT_TAG.sub("", source[at:]) if at >= last or "<" in source[at:] else source[at:])
            break
        p.add(source[at:i])
        if source.startswith("<!--", i):
            at = _COMMENT.match(source, i).end()
        elif m := _TAG.match(source, i, last):
            at, tag = m.end(), m[2].lower()
            if m[1]:
                p.end(tag)
            elif tag in _RAW:
                stop = _ENDS_OF_RAW[tag].search(source, at)
                at = len(source) if stop is None else stop.start()
                if stop is not None:
                    close = source.find(">", at)
                    at = len(source) if close < 0 else close + 1
            else:
                p.start(tag, m[3])
                if m[3].endswith("/") and tag == "svg":
                    p.end(tag)
        elif m := _BOGUS.match(source, i, last):
            at = m.end()
        else:
            p.add("<")
            at = i + 1
        last = max(last, at)
    p.flush()
    return p.page


def _summed(nodes: list[Node], own: np.ndarray) -> np.ndarray:
    """Each node's value with those of all nodes under it."""
    total = own.copy()
    for i in range(len(nodes) - 1, 0, -1):
        total[nodes[i].parent] += total[i]
    return total


def _left_out(page: Page, chars: np.ndarray) -> np.ndarray:
    """Nodes under an element that is never article text or that its names rule out."""
    nodes = page.nodes
    has = {t: _summed(nodes, np.array([n.tag == t for n in nodes], np.int64)) for t in ("h1", "main", "article")}
    size = _summed(nodes, np.bincount([b[0] for b in page.blocks], chars, len(nodes)))
    out = np.zeros(len(nodes), bool)
    for i, n in enumerate(nodes[1:], 1):
        wraps = bool(has["h1"][i] or has["main"][i])
        most = 2 * size[i] > size[0]
        if n.tag in ("html", "body", "main"):
            named = False
        elif n.words & _COMMENT_WORDS:
            named = not wraps
        elif n.words & _OTHER_WORDS and n.tag not in _HEADINGS:
            named = not (wraps or (most and (has["article"][i] or n.words & _CONTENT_WORDS)))
        else:
            named = False
        out[i] = out[n.parent] or n.never or named
    return out


def _fused(path: np.ndarray, outside: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The fused ratio of each block's path."""
    _, at, n = np.unique(path, return_inverse=True, return_counts=True)
    window = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SPREAD) ** 2)

    def smooth(v: np.ndarray) -> np.ndarray:
        full = np.convolve(v, window)[REACH : REACH + len(v)]
        return full / np.convolve(np.ones(len(v)), window)[REACH : REACH + len(v)]

    text = (np.bincount(at, outside) / n)[at]
    punctuation = (np.bincount(at, marks) / n)[at]
    fused = smooth(text) * (smooth(punctuation) + 0.1)
    return (np.bincount(at, fused) / n)[at]


def _like(nodes: list[Node], chosen: int) -> np.ndarray:
    """Nodes under the chosen one or under others on its path."""
    inside = np.zeros(len(nodes), bool)
    for i, n in enumerate(nodes):
        inside[i] = n.path == nodes[chosen].path or (i > 0 and inside[n.parent])
    return inside


def _chosen(nodes: list[Node], out: np.ndarray, content: np.ndarray) -> int | None:
    """The element that says it is the article and holds most content text; an inner one if it has half of the outer's."""
    total = _summed(nodes, content)
    best = None
    for i, n in enumerate(nodes):
        if n.main and not out[i] and total[i] > 0 and (best is None or total[i] > total[best]):
            best = i
    inner = best
    while inner is not None:
        best, inner, under = inner, None, np.zeros(len(nodes), bool)
        under[best] = True
        for i in range(best + 1, len(nodes)):
            under[i] = under[nodes[i].parent]
            if under[i] and nodes[i].main and not out[i] and 2 * total[i] >= total[best] and (inner is None or total[i] > total[inner]):
                inner = i
        # an inner element on a path of its own must not cost the outer one its heading
        if inner is not None and any(under[j] and nodes[j].tag == "h1" and not _below(nodes, j, inner) for j in range(best, len(nodes))):
            break
    return best


def _below(nodes: list[Node], i: int, top: int) -> bool:
    while i > top:
        i = nodes[i].parent
    return i == top


def content_blocks(page: Page) -> list[str]:
    """The texts of the page's content nodes, in page order."""
    nodes, blocks = page.nodes, page.blocks
    if not blocks:
        return []
    chars = np.array([len(t) for _, t, _ in blocks], np.float64)
    out = _left_out(page, chars)
    in_header = np.zeros(len(nodes), bool)  # under an article's header, but in no heading
    for i, n in enumerate(nodes[1:], 1):
        in_header[i] = (in_header[n.parent] or n.tag == "header") and n.tag not in _HEADINGS
    node = np.array([b[0] for b in blocks])
    kept = np.flatnonzero(~out[node] & ~in_header[node])
    if not len(kept):
        return []
    node, chars = node[kept], chars[kept]
    linked = np.minimum([blocks[i][2] for i in kept], chars)
    marks = np.array([len(_PUNCTUATION.findall(blocks[i][1])) for i in kept], np.float64)
    path = np.array([nodes[i].path for i in node])
    fused = _fused(path, chars - linked, marks)
    selected = (fused >= THRESHOLD * np.average(fused, weights=chars)) & (2 * linked < chars)
    chosen = _chosen(nodes, out, np.bincount(node[selected], chars[selected], len(nodes)))
    heading = np.array([nodes[i].tag in _HEADINGS for i in node])
    if chosen is not None:
        take = _like(nodes, chosen)[node]
    else:
        at = np.flatnonzero(selected)
        take = np.zeros(len(node), bool)
        if len(at):
            first, last = at[0], at[-1]
            while first > 0 and heading[first - 1]:
                first -= 1
            take[first : last + 1] = True
            take &= selected | heading | (2 * linked < chars)
    bare = {}  # list items that are nothing but a link, on paths that have only such
    for p, tag, full in zip(path.tolist(), (nodes[i].tag for i in node), (linked >= chars).tolist(), strict=True):
        bare[p] = bare.get(p, tag == "li") and full
    return [blocks[k][1] for k, t, p in zip(kept.tolist(), take.tolist(), path.tolist(), strict=True) if t and not bare[p]]


def main_text(source: str | None) -> str:
    return "\n".join(content_blocks(parse(source or "")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(h.as_py()) for h in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text], names=["page_id", "url", "text"])

    columns = [F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")]
    return pages.select(*columns).mapInArrow(run, "page_id long, url string, text string")


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))
