"""Main text of web pages by tag-path ratios.

A page becomes a list of text nodes, each with its root-to-leaf tag path (tag names and
classes). Only tags and roles leave a subtree out (scripts, menus, footers, asides,
controls ...). Over the other paths, text length and punctuation are summed and divided
by the path's number of nodes; both ratios are written back to the nodes in page order,
smoothed by a Gaussian and fused by multiplication, with the path's own ratios as a
geometric mean (or a bare line next to a long paragraph would share its ratio). Class and id words (``MARK_WORDS``)
and forms leave nothing out: each such element above a node divides its fused ratio by
``MARK``. Nodes at or above THRESHOLD times the standard deviation of the fused ratios are
content, whatever they stand in, and with a node its line: the text up to the next block.

The rest of the article, its headings and short paragraphs, comes from the container: the
innermost article or main that holds all these nodes, else the innermost of CONTAINERS.
It adds the nodes below the threshold that have no mark between it and them; outside
article and main only those in headings or elements of running text (ADDED) that are more
than links, so a bare line beside the story is left out. It removes nothing.

Defined results: null or empty html, or html without text, gives an empty text; markup
that is never closed ends with the page; rows that repeat an id are treated alone; other
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, payload

THRESHOLD = 0.8
#: A marked element divides the fused ratios of the nodes in it by this.
MARK = 20.0
#: Half width of the smoothing window, in nodes.
RADIUS = 2

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|(?P<text>[^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe title textarea svg object".split())
INLINE = frozenset(
    "a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr img".split()
)
#: Elements that end when another of the set opens inside the same container.
CLOSES = {
    **dict.fromkeys(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
        "section table ul".split(),
        frozenset({"p"}),
    ),
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}),
}
#: No element is closed through one of these.
SCOPES = frozenset("html body article aside main section div nav footer header table ul ol dl form td th".split())
CONTAINERS = frozenset("html body article main section div".split())

NEVER_TAGS = RAW | frozenset("head nav footer aside button select menu dialog input canvas audio video".split())
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split()
)
#: Words in a class or id that speak against a path.
MARK_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead comment comments reply replies respond responses disqus cookie cookies consent notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended widget toolbar pagination pager skip search form".split()
)
#: Words that may stand beside them in a compound (``share-buttons``, ``site-footer``).
BESIDE_WORDS = frozenset(
    "site page main top bottom left right primary secondary global inner outer container wrapper wrap box bar block list "
    "item items link links button buttons icon icons area slot unit content post posts article articles".split()
)
#: Elements of text: one word of a longer class or id says nothing here, nor does their id.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 section pre blockquote table td th dl dt dd".split())
#: Elements whose text the container adds outside article and main.
ADDED = TEXTUAL - {"section"} | frozenset("li figcaption caption summary".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


def attributes(attrs: str) -> dict[str, str]:
    """Lower-case names and values; of a repeated name the first."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def never(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    if tag in NEVER_TAGS or "hidden" in attrs or tag == "header" and not inside:
        return True
    return bool(set(re.split(r"[^a-z]+", attrs.get("role", "").lower())) & NEVER_ROLES)


def marked(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element speaks against the text in it."""
    if tag == "form" or attrs.get("role", "").lower() == "form":
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    classes = attrs.get("class", "").lower().split()
    # Ids of headings and sections are made from their titles.
    ids = [] if tag in TEXTUAL or "section" in classes else attrs.get("id", "").lower().split()
    for token in classes + ids:
        words = set(re.split(r"[^a-z]+", token)) - {""}
        found = words & MARK_WORDS
        if inside or tag in TEXTUAL:  # only whole tokens and known compounds
            found = found - {"header"} if words <= MARK_WORDS | BESIDE_WORDS else None
        if found:
            return True
    return False


class Open(NamedTuple):
    """An element that is open: its number, that of its tag path, whether it is left out,
    whether it is an article or main or stands in one, how many marked elements hold it
    (itself included), and whether it stands in one of ADDED and in a link."""

    tag: str
    element: int
    path: int
    out: bool
    inside: bool
    marks: int
    added: bool
    link: bool


class Page:
    """Text nodes of a page in order: text, number of the tag path, element, whether a block
    begins before it, whether an element of ADDED holds it, whether a link does; and of each
    element its tag, the one it stands in (-1: none) and its number of marks. Elements are
    numbered as they open, tag paths as a trie."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.paths: list[int] = []
        self.elements: list[int] = []
        self.breaks: list[bool] = []
        self.added: list[bool] = []
        self.links: list[bool] = []
        self.tags: list[str] = []
        self.above: list[int] = []
        self.marks: list[int] = []


def text_nodes(page: str) -> Page:
    """What may be content of a page."""
    found, stack, trie = Page(), [], {}
    opened: Counter[str] = Counter()  # how many elements of a tag are open
    new_block, at, size = True, 0, len(page)

    def close_from(i: int) -> None:
        for e in stack[i:]:
            opened[e.tag] -= 1
        del stack[i:]

    while at < size:
        m = TOKEN.match(page, at)
        at = m.end()
        kind = m.lastgroup
        if kind == "text":
            if not (stack and stack[-1].out):
                text = m.group()
                if text.strip():
                    found.texts.append(text)
                    found.paths.append(stack[-1].path if stack else -1)
                    found.elements.append(stack[-1].element if stack else -1)
                    found.breaks.append(new_block)
                    found.added.append(bool(stack) and stack[-1].added)
                    found.links.append(bool(stack) and stack[-1].link)
                    new_block = False
                elif found.texts and not new_block:
                    found.texts[-1] += " "
        elif m.group("end"):
            tag = m.group("end").lower()
            new_block |= tag not in INLINE
            for i in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close_from(i)
                    break
                if stack[i].tag in SCOPES and tag not in SCOPES:
                    break
        elif m.group("start"):
            tag, attrs = m.group("start").lower(), m.group("attrs")
            new_block |= tag not in INLINE
            if ends := CLOSES.get(tag):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in ends:
                        close_from(i)
                    elif stack[i].tag in SCOPES:
                        break
            if tag in VOID or attrs.endswith("/") and tag in INLINE:
                continue
            if tag in RAW:  # what is inside is not markup
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else size
                continue
            given = attributes(attrs)
            over = stack[-1] if stack else Open("", -1, -1, False, False, 0, False, False)
            name = tag + "".join("." + c for c in given.get("class", "").split())
            path = trie.setdefault((over.path, name), len(trie))
            inside = over.inside or tag in ("article", "main")
            marks = over.marks + marked(tag, given, over.inside)
            added = tag in ADDED or over.added and tag not in CONTAINERS
            out = over.out or never(tag, given, over.inside)
            stack.append(Open(tag, len(found.tags), path, out, inside, marks, added, over.link or tag == "a"))
            opened[tag] += 1
            found.tags.append(tag)
            found.above.append(over.element)
            found.marks.append(marks)
    return found


def core_nodes(texts: list[str], paths: list[int], marks: list[int]) -> np.ndarray:
    """Which nodes stand out by their smoothed and fused tag-path ratios."""
    _, path = np.unique(np.array(paths, np.int64), return_inverse=True)
    length = np.array([len(t.strip()) for t in texts], float)
    points = np.array([len(PUNCTUATION.findall(t)) for t in texts], float)
    nodes = np.bincount(path)
    window = np.exp(-(np.arange(-RADIUS, RADIUS + 1) ** 2) / 2.0)
    weight = np.convolve(np.ones(len(texts)), window, "full")[RADIUS : RADIUS + len(texts)]

    def smoothed(by_node: np.ndarray) -> np.ndarray:
        return np.convolve(by_node, window, "full")[RADIUS : RADIUS + len(texts)] / weight

    lengths, pointed = ((np.bincount(path, values) / nodes)[path] for values in (length, points))
    own, around = lengths * (1 + pointed), smoothed(lengths) * (1 + smoothed(pointed))
    against = np.array(marks, float)
    fused = np.sqrt(own * around) * MARK ** (against.min() - against)
    return fused >= min(THRESHOLD * fused.std(), fused.max())


def container(found: Page, first: int, last: int) -> int | None:
    """The innermost article or main, else the innermost other container, that holds the
    elements ``first`` and ``last`` and with them all that opened between them."""
    while first != last:  # to the innermost element that holds both
        if first > last:
            first = found.above[first]
        else:
            last = found.above[last]
    other = None
    while first >= 0:
        if found.tags[first] in ("article", "main"):
            return first
        if other is None and found.tags[first] in CONTAINERS:
            other = first
        first = found.above[first]
    return other


def content_nodes(found: Page, core: np.ndarray) -> list[bool]:
    """Which nodes are content: the core, and what its container adds."""
    held = [e for e, is_core in zip(found.elements, core, strict=True) if is_core]
    content = container(found, min(held), max(held))
    within = [content is None] * len(found.tags)  # an element opens after the one it stands in
    for e, over in enumerate(found.above):
        within[e] |= e == content or over >= 0 and within[over]
    free = 0 if content is None else found.marks[content]
    whole = content is not None and found.tags[content] in ("article", "main")
    out: list[bool] = []
    for line in lines(found):
        marks = [found.marks[e] if (e := found.elements[i]) >= 0 else 0 for i in line]
        least = min((m for i, m in zip(line, marks, strict=True) if core[i]), default=-1)
        links = all(found.links[i] for i in line)
        for i, m in zip(line, marks, strict=True):
            e = found.elements[i]
            inside = content is None or e >= 0 and within[e]
            out.append(m <= least or inside and m <= free and (whole or found.added[i] and not links))
    return out


def lines(found: Page) -> list[range]:
    """The nodes of each line: what stands between two blocks."""
    starts = [i for i, fresh in enumerate(found.breaks) if fresh or i == 0]
    return [range(a, b) for a, b in zip(starts, [*starts[1:], len(found.breaks)], strict=True)]


def main_text(page: str) -> str:
    """The main text of one page."""
    found = text_nodes(page)
    if not found.texts:
        return ""
    marks = [found.marks[e] if e >= 0 else 0 for e in found.elements]
    chosen = content_nodes(found, core_nodes(found.texts, found.paths, marks))
    blocks: list[str] = []
    for text, fresh, taken in zip(found.texts, found.breaks, chosen, strict=True):
        if taken:
            if fresh or not blocks:
                blocks.append(text)
            else:
                blocks[-1] += text
        elif blocks:
            blocks.append("")
    return " ".join(" ".join(entities.unescape(b) for b in blocks).split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a page: page_id, url, text, n_chars."""
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload(html_col))

    def batch(rows: pa.RecordBatch) -> dict[str, list]:
        texts = [main_text(h.decode("utf-8", "replace")) for h in rows.column("_bytes").to_pylist()]
        return {
            "page_id": rows.column("page_id"),
            "url": rows.column("url"),
            "text": texts,
            "n_chars": [len(t) for t in texts],
        }

    id_type = source.schema["page_id"].dataType.simpleString()
    return map_batches(source, batch, f"page_id {id_type}, url string, text string, n_chars long")
