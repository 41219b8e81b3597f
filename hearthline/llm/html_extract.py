"""The main text of a web page by tag-path ratios.

Every text node has a root-to-leaf tag path. Per path of a page, text length and punctuation are aggregated over its nodes; the two
ratios are smoothed over the page's node order, so that a short paragraph among long ones rises and a long notice among links
falls, and fused by multiplication with the share of text outside links. Paths whose fused value reaches the spread of
all nodes' values are content. The element that holds most of the content is the article: all its text counts, headings, lists and
short paragraphs too, but for parts that are boilerplate by element or by name (menus, adverts, comments, ...).

Each page is a row by itself: no shuffle, and a lost executor costs the pages of its running tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.llm.common import pieces, text_or_empty

VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
HIDDEN = set("head script style noscript template iframe object svg math canvas audio video map select datalist".split())
BOILERPLATE = set("nav footer aside form button input textarea dialog menu fieldset header".split())
#: Roles and words of class and id by which a page names parts that are not its article.
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar side rail widget footer header "
    "masthead topbar toolbar comment comments respond replies disqus share sharing social related recommended newsletter subscribe "
    "subscription signup login search form copyright legal skip pager pagination".split()
)
#: Names that stay boilerplate however much text they hold; the others may also describe the layout around an article.
ALWAYS = set("comment comments respond replies disqus related recommended".split())
ARTICLE = set("article main".split())
#: Elements that keep their text although the names of a page's layout match: they hold the article.
WHOLE = set("html body article main".split())
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split()
)
#: Start tags that end an open element of the second set, up to an element of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
#: Parts of an article that count beside its paragraphs where no article element bounds them.
PARTS = set("h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption".split())
HEAD = set("title meta link style script base noscript template head html".split())
MARKS = re.compile(r"[.,;:!?…、。！，：；？،؛؟।]")
#: Share of the content's characters that the article must hold: an article or main element, or any other.
HALF, MOST = 0.5, 0.85
LINKED = 0.8


class _Element:
    """An element, the number of its tag path, and what it has from the elements around it."""

    __slots__ = ("tag", "parent", "path", "out", "named", "link", "part", "depth", "held", "within")

    def __init__(self, tag: str, parent: _Element | None, path: int, out: bool, named: bool):
        self.tag, self.parent, self.path, self.out, self.named = tag, parent, path, out, named
        self.link = tag == "a" or bool(parent and parent.link)
        self.part = tag in PARTS or bool(parent and parent.part)
        self.depth = parent.depth + 1 if parent else 0
        self.held, self.within = 0.0, False


#: Elements whose content is text up to their end tag.
RAW = {t: re.compile(f"</{t}(?![a-z0-9])", re.I) for t in "script style textarea title noframes xmp".split()}
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s"'/>=]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'>]+)))?""")


class _Nodes:
    """Text nodes of a page in order: element, text and the number of the block that each belongs to. Reads a page once from
    front to end: no place is searched twice for the end of a tag, comment or quote that never comes."""

    def __init__(self, page: str):
        self.top = _Element("html", None, 0, False, False)
        self.paths: dict[tuple[int, str], int] = {}
        self.made = [self.top]
        self.open: Counter[str] = Counter()
        self.elements: list[_Element] = []
        self.texts: list[str] = []
        self.block_of: list[int] = []
        self.block = 0
        self.without: set[str] = set()  # quotes that do not come again
        at = 0
        while at < len(page):
            opened = page.find("<", at)
            if opened < 0:
                opened = len(page)
            if opened > at:
                self._text(page[at:opened])
            at = self._markup(page, opened) if opened < len(page) else opened

    def _markup(self, page: str, at: int) -> int:
        """Reads what begins with the < at this place; returns where it ends."""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 2)
            return end + 3 if end >= 0 else len(page)
        named = NAME.match(page, at)
        if not named and page[at + 1 : at + 2] not in ("!", "?", "/"):
            self._text("<")
            return at + 1
        end = page.find(">", at) if not named else self._tag_end(page, named.end())
        if end < 0:
            return len(page)
        if named:
            tag = named[2].lower()
            if named[1]:
                self._end(tag)
            else:
                self._start(tag, page[named.end() : end])
                if tag in RAW:
                    shut = RAW[tag].search(page, end)
                    return shut.start() if shut else len(page)
        return end + 1

    def _tag_end(self, page: str, at: int) -> int:
        """The first > outside quotes; a quote that is never closed quotes nothing."""
        while True:
            end = page.find(">", at)
            quoted = re.compile(r"""=\s*(["'])""").search(page, at, max(end, at))
            if end < 0 or not quoted or quoted[1] in self.without:
                return end
            shut = page.find(quoted[1], quoted.end())
            if shut < 0:
                self.without.add(quoted[1])
                return end
            at = shut + 1

    def _start(self, tag: str, rest: str) -> None:
        if tag == "html":
            return
        if tag not in HEAD:
            self._leave({"head"}, set())
        if tag in CLOSES_P:
            self._leave({"p"}, {"button", "td", "th", "caption"})
        if tag in ENDS:
            self._leave(*ENDS[tag])
        if tag == "br":
            self._add(" ")
        elif tag not in INLINE:
            self.block += 1
        if tag not in VOID:
            attrs = [(m[1].lower(), unescape(m[2] or m[3] or m[4] or "")) for m in ATTRIBUTE.finditer(rest)] if rest.strip() else []
            path = self.paths.setdefault((self.top.path, tag), len(self.paths) + 1)
            out, named = self._apart(tag, attrs)
            self.top = _Element(tag, self.top, path, out, named)
            self.made.append(self.top)
            self.open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._add(" ")
        elif tag not in INLINE:
            self.block += 1
        self._leave({tag}, None if tag in INLINE else set())

    def _text(self, data: str) -> None:
        if not self.top.out:
            self._add(unescape(data) if "&" in data else data)

    def _add(self, text: str) -> None:
        self.elements.append(self.top)
        self.texts.append(text)
        self.block_of.append(self.block)

    def _leave(self, tags: set[str], up_to: set[str] | None) -> None:
        """Closes the nearest open element of ``tags``; a part of a line (up_to None) ends inside its block."""
        at: _Element | None = self.top if any(self.open[t] for t in tags) else None
        while at is not None and at.parent is not None:
            if at.tag in tags:
                while self.top is not at.parent:
                    self.open[self.top.tag] -= 1
                    self.top = self.top.parent
                return
            if at.tag not in INLINE if up_to is None else at.tag in up_to:
                return
            at = at.parent

    def _apart(self, tag: str, attrs: list[tuple[str, str]]) -> tuple[bool, bool]:
        """Whether an element is boilerplate for certain, and whether by a name that may be the layout's."""
        if self.top.out or tag in HIDDEN or tag in BOILERPLATE and not (tag == "header" and any(self.open[t] for t in ARTICLE)):
            return True, False
        given = dict(attrs)
        named = lambda names: any(_named(given.get(k), names) for k in ("class", "id"))
        if tag in WHOLE:
            return tag == "article" and named(ALWAYS), False
        if "hidden" in given or given.get("aria-hidden") == "true" or given.get("role") in ROLES:
            return True, False
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style") or ""):
            return True, False
        return tag not in INLINE and named(ALWAYS), tag not in INLINE and named(NAMES)

    def settle(self) -> None:
        """Elements with a boilerplate name are left out, but for those that enclose an article or, where a page marks none, half of
        the page's text: there the name is the layout's (content with-sidebar)."""
        for element, text in zip(self.elements, self.texts):
            element.held += len(text) * (not element.out)
        around: set[_Element] = set()
        for element in reversed(self.made[1:]):
            element.parent.held += element.held
            if element in around or element.tag in ARTICLE and not element.out:
                around.add(element.parent)
        for element in self.made[1:]:
            named = element.named and element not in around and (bool(around) or element.held < HALF * self.made[0].held)
            element.out = element.out or element.parent.out or named
        for element in self.made:
            element.held = 0.0


def _named(value: str | None, names: set[str]) -> bool:
    return bool(value) and not names.isdisjoint(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()))


def _smooth(values: np.ndarray) -> np.ndarray:
    """Gaussian of one node's width over the neighbours, in page order."""
    kernel = np.exp(-0.5 * np.arange(-3, 4) ** 2.0)
    around = np.convolve(np.ones(len(values)), kernel, "full")[3:-3]
    return np.convolve(values, kernel, "full")[3:-3] / around


def _content(length: np.ndarray, marks: np.ndarray, linked: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Whether the path of each text node is a content path."""
    per_path = lambda x: np.bincount(path, x)
    nodes, chars = np.maximum(1, per_path(np.ones(len(path)))), np.maximum(1, per_path(length))
    text_ratio = _smooth((chars / nodes)[path])
    mark_ratio = _smooth((per_path(marks) / nodes)[path])
    fused = text_ratio * mark_ratio * (1 - per_path(length * linked) / chars)[path]
    value = (per_path(fused) / nodes)[path]
    return (value > 0) & (value >= min(value.std(), value.max()))


def main_text(page: str) -> str:
    """The article of one page, blocks joined by one space."""
    parser = _Nodes(page)
    parser.settle()
    open_nodes = [k for k, (e, text) in enumerate(zip(parser.elements, parser.texts)) if not e.out and text and not text.isspace()]
    if not open_nodes:
        return ""
    elements, texts = [parser.elements[k] for k in open_nodes], [parser.texts[k] for k in open_nodes]
    path = np.array([e.path for e in elements])
    length = np.array([len(" ".join(t.split())) for t in texts], float)
    marks = np.array([len(MARKS.findall(t)) for t in texts], float)
    linked = np.array([e.link for e in elements], float)
    content = _content(length, marks, linked, path)
    if not content.any():
        content = linked < 1 if (linked < 1).any() else np.ones(len(path), bool)  # no path has punctuation: a title, a table
    article = _article(parser.made, elements, length * content)
    menu = _menus(length, marks, linked, path)
    whole = article.tag in ARTICLE
    lines = {parser.block_of[k] for k, hit in zip(open_nodes, content) if hit}
    kept: dict[int, list[str]] = {}
    for k, (element, text) in enumerate(zip(parser.elements, parser.texts)):
        if element.out or not element.within or element.path < len(menu) and menu[element.path]:
            continue
        block = parser.block_of[k]
        if whole or block in lines or element.part:
            kept.setdefault(block, []).append(text)
    return " ".join(x for x in (" ".join("".join(parts).split()) for parts in kept.values()) if x)


def _article(made: list[_Element], elements: list[_Element], weight: np.ndarray) -> _Element:
    """The deepest article or main that holds most of the content, else the deepest element that does and is no paragraph;
    marks all elements within."""
    for element, w in zip(elements, weight.tolist()):
        element.held += w
    for element in reversed(made[1:]):
        element.parent.held += element.held
    holders = [e for e in made if e.held >= MOST * made[0].held]
    whole = [e for e in made if e.tag in ARTICLE and made[0].held and e.held >= HALF * made[0].held]
    others = [e for e in holders if e.tag not in INLINE and e.tag != "p" and e.tag not in PARTS]
    article = max(whole or others, key=lambda e: e.depth)
    article.within = True
    for element in made[1:]:
        element.within = element.within or element.parent.within
    return article


def _menus(length: np.ndarray, marks: np.ndarray, linked: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Paths of three or more nodes that are links without punctuation."""
    nodes, chars = np.bincount(path), np.bincount(path, length)
    return (nodes >= 3) & (np.bincount(path, length * linked) >= LINKED * chars) & (np.bincount(path, marks) < nodes / 2)


def extract_pages(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, ``text`` (the article's text, empty if there is none) and ``n_chars``, its code points.

    A null page is empty and has an empty text. Repeated rows each get their result, an empty table an empty one. Columns other
    than ``keep`` are not read; a kept column must not be named text or n_chars. Unclosed, misplaced and unknown tags are
    taken as browsers take them. A page is parsed as a whole in memory, about 20 times its size for the time of that page.
    """
    if {"text", "n_chars"} & set(keep):
        raise ValueError("a kept column has the name of a result: text, n_chars")
    named = [F.col(c) for c in keep]
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "__page"):
            found = [main_text(x) for x in texts.to_pylist()]
            columns = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names=[*keep, "text", "n_chars"])

    return pages.select(*named, text_or_empty(html).alias("__page")).mapInArrow(work, schema)
