"""Main text of web pages by tag-path ratios.

A page is read into text nodes with their root-to-leaf tag paths, menus and adverts included. For each path
the mean text length and the mean punctuation of its nodes are its two ratios; both are smoothed along the
page with a Gaussian, fused as a geometric mean and cut at a share of their spread. Nodes on paths above the
cut are selected. What says itself that it is one of the kinds that the result leaves out (navigation, forms,
adverts, comments and so on, by element, role, whole class or id) is vetoed, unless it holds the article or
most of the page's text. The selected nodes choose the container: from the root down to the deepest
sectioning element that still holds nearly all of them.

The result is the selected nodes with what belongs to them: in a container that is an article all that isn't
vetoed; in any other what stands between the first and the last selected node, links on weak paths left out,
and the headings right before; outside of it the blocks that are selected for the most part.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*>|(?P<text>[^<]+)|(?P<lone><)", re.S
)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")

# Fixed values of HTML: elements without content, elements whose content is no markup, and inline elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that a new element of the same group ends where its end tag is missing.
GROUPS = {t: g for g in ("p h1 h2 h3 h4 h5 h6", "li", "dt dd", "tr", "td th", "option") for t in g.split()}
#: Elements that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SECTIONS = frozenset("html body main article section div td table tbody tr center".split())
ARTICLE = frozenset(["article", "main"])

# Elements, roles, and words of class and id attributes that mark what is no article.
APART = frozenset("nav footer aside form script style noscript template button select textarea input iframe object svg canvas dialog menu head title audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer masthead topbar toolbar cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended "
    "comment comments commentlist reply replies respond disqus widget pagination pager skip hidden".split()
)
#: Marks of what readers write, which may be longer than the article.
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
#: Words that make known compounds with marks, as in share-buttons; any other word makes another sense, as in related-work.
PARTS = frozenset(
    "area bar block bottom box button buttons column container desktop footer form global group header holder icon icons inline inner item items label left link links list main media mobile "
    "outer panel post posts articles stories primary right secondary section site slot sticky tab tabs text title toggle top trail unit wrap wrapper x".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are the page's text whatever their attributes say.
NEVER_APART = frozenset("html body article main".split())

#: Share of the fused ratios' standard deviation that a path needs.
CUT = 1.0
#: Share of the selected text that a container must hold.
HOLDS = 0.85


def _apart(name: str, attrs: str, inside: bool) -> bool:
    if name in APART or name == "header" and not inside:
        return True
    if not attrs or name in NEVER_APART:
        return False
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key == "role" and value in ROLES:
            return True
    return False


def _marks(name: str, attrs: str) -> set[str]:
    """Marks among the whole classes and ids. The id of a heading is a place in the article."""
    out: set[str] = set()
    if not attrs or name in NEVER_APART:
        return out
    for key, a, b, c in _ATTR.findall(attrs):
        if (key := key.lower()) == "class" or key == "id" and name not in HEADINGS:
            for token in (a or b or c).lower().split():
                words = {w for w in re.split(r"[^a-z]+", token) if w}
                if words <= MARKS | PARTS:
                    out |= words & MARKS
    return out


class Page:
    """Text nodes of a page in order: text, owner (element), path; -1 as owner: a block ends here.

    A path is a number, given to each pair of a path and a tag that continues it, so memory grows with the
    number of elements and not with their depth."""

    def __init__(self, source: str):
        self.names, self.parents = ["html"], [-1]
        self.texts: list[str] = []
        self.owners: list[int] = []
        self.paths: list[int] = []
        self.links: list[bool] = []
        self.apart: set[int] = set()
        self.marks: dict[int, set[str]] = {}
        numbers: dict[tuple[int, str], int] = {}
        stack: list[tuple[str, int, int, bool]] = [("html", 0, 0, False)]  # name, element, path, in a link
        open_: dict[str, int] = {}
        inside, at, n = 0, 0, len(source)

        def close(i: int) -> None:
            nonlocal inside
            for name, _, _, _ in stack[i:]:
                open_[name] -= 1
                inside -= name in ARTICLE
            del stack[i:]

        while at < n:
            m = _TOKEN.match(source, at)
            at = m.end()
            if (text := m["text"] or m["lone"]) is not None:
                _, element, path, link = stack[-1]
                self.texts.append(text)
                self.owners.append(element)
                self.paths.append(path)
                self.links.append(link)
                continue
            name = m["name"] or m["name2"]
            if name is None:
                continue
            name = name.lower()
            attrs = m["attrs"] or m["attrs2"] or ""
            if name not in INLINE:
                self.texts.append(" ")
                self.owners.append(-1)
                self.paths.append(-1)
                self.links.append(False)
            if m["end"] or m["end2"]:
                if open_.get(name):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == name:
                            close(i)
                            break
                        if stack[i][0] in SECTIONS and (name in INLINE or name in GROUPS):
                            break
                continue
            if name in RAW:
                end = re.compile(rf"</{name}[\s/>]", re.I).search(source, at)
                at = source.find(">", end.start()) + 1 if end else n
                at = at or n
                continue
            if name in VOID or name == "html":
                continue
            if name in ENDS_P or name in GROUPS:
                group = GROUPS.get(name, "").split()
                if any(open_.get(x) for x in (*group, "p")):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in group or stack[i][0] == "p" and name in ENDS_P:
                            close(i)
                            break
                        if stack[i][0] in SECTIONS or stack[i][0] in ("ul", "ol", "dl", "blockquote"):
                            break
            if attrs.rstrip().endswith("/") and name in INLINE:
                continue
            parent = stack[-1]
            self.names.append(name)
            self.parents.append(parent[1])
            element = len(self.names) - 1
            stack.append((name, element, numbers.setdefault((parent[2], name), len(numbers) + 1), parent[3] or name == "a"))
            open_[name] = open_.get(name, 0) + 1
            if _apart(name, attrs, inside > 0):
                self.apart.add(element)
            elif marks := _marks(name, attrs):
                self.marks[element] = marks
            inside += name in ARTICLE

    def _vetoed(self, size: np.ndarray) -> np.ndarray:
        """Whether each element is in one that is left out. Marked elements that hold the page's article or
        most of its text aren't; ``size``: text in each element that isn't apart."""
        apart = self._under(self.apart)
        marks = dict(self.marks)
        if marks:
            under = self._under(marks)
            articles = [e for e, name in enumerate(self.names) if name in ARTICLE and size[e] and not apart[e]]
            if not any(not under[e] for e in articles):
                held = set()
                for e in articles:
                    while e >= 0 and e not in held:
                        held.add(e)
                        e = self.parents[e]
                marks = {e: x for e, x in marks.items() if e not in held and (2 * size[e] <= size[0] or x & COMMENTS)}
            else:
                largest = max(articles, key=lambda e: size[e])
                while largest >= 0 and 2 * size[largest] > size[0]:
                    marks.pop(largest, None)
                    largest = self.parents[largest]
        return apart | self._under(marks)

    def _under(self, tops) -> np.ndarray:
        """Whether each element is one of ``tops`` or in one."""
        out = np.zeros(len(self.names), bool)
        if tops:
            for e in range(len(self.names)):  # parents come before children
                out[e] = e in tops or e > 0 and out[self.parents[e]]
        return out

    def _total(self, sizes) -> np.ndarray:
        """For each element the sum over its text nodes."""
        out = np.zeros(len(self.names))
        for o, x in zip(self.owners, sizes, strict=True):
            if o >= 0:
                out[o] += x
        for e in range(len(self.names) - 1, 0, -1):
            out[self.parents[e]] += out[e]
        return out

    def article(self) -> str:
        owners = np.array(self.owners, np.int64)
        full = np.array([o >= 0 and not t.isspace() for o, t in zip(self.owners, self.texts, strict=True)], bool)
        if not full.any():
            return ""
        length = np.where(full, [len(t.strip()) for t in self.texts], 0).astype(float)
        vetoed = self._vetoed(self._total(length * ~self._under(self.apart)[owners]))[owners] & (owners >= 0)
        weak = ~chosen_paths(np.array(self.paths), full, length, np.array([len(_PUNCTUATION.findall(t)) for t in self.texts], float))
        selected = full & ~weak & ~vetoed
        if not selected.any():
            selected = full & ~vetoed
        mass = self._total(length * selected)
        box = 0
        children: dict[int, list[int]] = {}
        for e in range(1, len(self.names)):
            children.setdefault(self.parents[e], []).append(e)
        while self.names[box] not in ARTICLE:
            down = [e for e in children.get(box, []) if self.names[e] in SECTIONS and mass[e] >= HOLDS * mass[0]]
            if not down:
                break
            box = max(down, key=lambda e: mass[e])
        within = self._under({box})[owners] & (owners >= 0)
        keep = selected.copy()
        if self.names[box] in ARTICLE:
            keep |= within & ~vetoed
        else:
            places = np.flatnonzero(selected & within)
            first, last = (places[0], places[-1]) if len(places) else (0, -1)
            while first > 0 and (not full[first - 1] or within[first - 1] and not vetoed[first - 1] and self._heading(self.owners[first - 1])):
                first -= 1
            between = np.zeros(len(owners), bool)
            between[first : last + 1] = True
            keep |= between & within & ~vetoed & ~(weak & np.array(self.links))
        outside = np.flatnonzero(selected & ~within)
        if len(outside):
            # Selected nodes outside of the container belong to the result, with their blocks.
            around, e = {box}, box
            while e > 0:
                around.add(e := self.parents[e])
            total, taken = self._total(length * ~vetoed), mass
            tops = set()
            for i in outside:
                top, e = None, self.owners[i]
                while e not in around and 2 * taken[e] >= total[e]:
                    top, e = e, self.parents[e]
                if top is not None:
                    tops.add(top)
            keep |= self._under(tops)[owners] & (owners >= 0) & ~vetoed & ~(weak & np.array(self.links))
        return " ".join(entities.unescape("".join(t for t, k, o in zip(self.texts, keep, self.owners, strict=True) if k or o < 0)).split())

    def _heading(self, e: int) -> bool:
        while e > 0 and self.names[e] in INLINE:
            e = self.parents[e]
        return self.names[e] in HEADINGS


def chosen_paths(paths: np.ndarray, full: np.ndarray, length: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether each node's path is above the cut: mean length and mean punctuation of the path's nodes,
    smoothed along the page and fused. Only ``full`` nodes, those with text, count and are chosen."""
    _, which = np.unique(paths[full], return_inverse=True)
    count = np.bincount(which)
    by_length, by_marks = np.bincount(which, length[full]) / count, np.bincount(which, marks[full]) / count
    fused = np.sqrt(_smooth(by_length[which]) * (_smooth(by_marks[which]) + 0.1))
    ratio = np.bincount(which, fused) / count
    out = np.zeros(len(paths), bool)
    out[full] = ((ratio >= CUT * ratio[which].std()) | (ratio == ratio.max()))[which]
    return out


def _smooth(x: np.ndarray) -> np.ndarray:
    kernel = np.array([math.exp(-(d**2) / 2) for d in (-1, 0, 1)])
    weight = np.convolve(np.ones(len(x)), kernel, "full")[1:-1]
    return np.convolve(x, kernel, "full")[1:-1] / weight


def extract(source: str | None) -> str:
    """The main text of a page; null and pages without text give the empty text."""
    return Page(source).article() if source else ""


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    Null html is empty; its text is empty. Null page_id and url, and repeated rows, are kept as they are.
    An empty table gives an empty result.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([extract(x) for x in s], dtype=object)

    text = F.pandas_udf(run, "string")(F.col("html"))
    return pages.select("page_id", "url", "html").withColumn("text", text).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
