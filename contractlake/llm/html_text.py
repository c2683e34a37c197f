"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is a sequence of words, which score positive, and tags, which score negative. How much depends on where they
stand: the weights are learned from labelled pages, those that mark their article themselves (``<article>``, ``<main>`` or
the matching role), by counting how often words of a place and tags of a name lie inside and outside of it. One linear
scan finds the contiguous region with the largest sum. Of that region the blocks that stand in menus, headers, footers,
sidebars, notices, adverts, forms or reader comments are left out, which are known by their tags and roles. Classes and ids
only make an element suspect (headings and paragraphs never): one that holds the marked article or most of the page's words
stays, a name that also fits a section of an article counts if half of the words are links, else it only sets the words' weight.

The region that the scan finds is widened to whole elements, so that tables, lists and short blocks at the edges of an
article, whose tags outweigh their words, stay: to the marked articles that it touches, or where none is marked to the smallest
element inside the body that holds it (then without blocks that are mostly links). A form is furniture unless it holds the
marked article or most of the page's words; so is a list of links beside a marked article. Text that scripts would show or hide
stays if it stands in a marked article.

Words of a run have one weight, so the scan goes by runs; tags of cells and list items count once between words. Pages are parsed
as browsers would: tags may stay open, end tags may be missing, scripts and styles end at their own end tag only, comments that
never end hide the rest. Parsing takes time in proportion to the page, however deep or broken its tags. Weights are learned
for tag names of up to 16 ASCII characters; others keep their prior.

Contract: null and empty html give the empty text; nothing is cut; character references are decoded once; white
space in a block becomes one space, blocks are joined by a line feed; of equally good regions the first and longest is
taken; without labelled pages the prior weights hold; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages to learn from, at most.
TRAIN_PAGES = 2000
TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*'|<)*+)>|[!?/][^>]*>)")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
# Fixed values of the HTML standard.
RAW = frozenset("script style template textarea title iframe noembed noframes xmp svg annotation annotation-xml mphantom object audio video canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img "
                   "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd semantics".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = frozenset("li dt dd tr td th option thead tbody tfoot".split())
CELLS = frozenset("table caption colgroup thead tbody tfoot tr td th ul ol li dl dt dd".split())
LISTS = frozenset("ul ol".split())
# What page furniture is called.
FORM_ROLES = frozenset("search form".split())
FURNITURE_TAGS = frozenset("nav aside footer button menu dialog head".split())
FORM_TAGS = frozenset("form fieldset".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary dialog alert alertdialog menu menubar toolbar tablist".split())
FURNITURE_NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar "
    "header masthead footer copyright legal colophon "
    "sidebar aside widget widgets related recommended recommendations trending popular "
    "notice notices cookie cookies consent gdpr banner alert popup modal overlay newsletter subscribe subscription paywall disclaimer toast "
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted "
    "form search login signup "
    "comment comments commentlist discussion disqus replies respond "
    "share sharing social follow skip".split())
# Of these, what sections of articles are called, too; words that stand beside furniture's name in one class or id; what articles are called.
ALSO_SECTIONS = frozenset(
    "navigation header copyright legal colophon aside related recommended recommendations trending popular notice notices consent banner alert "
    "subscription disclaimer promotion form search login signup discussion respond replies sharing follow skip".split())
BESIDE = frozenset(
    "site page global main primary secondary top bottom left right inner outer box bar list item items slot unit block area container wrapper wrap section "
    "group panel module zone links link buttons button icons icon bars post article entry story content text title heading blog user reader "
    "social media mobile desktop sticky fixed floating small large".split())
CONTENT_NAMES = frozenset("content article post story entry column columns".split())
NOT_SO = frozenset("has with no not without".split())
OWN_ARTICLE = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


@dataclass
class Run:
    """Words of one place (``block``: number of their block) or one tag, in page order."""
    key: str
    words: int = 0
    block: int = -1
    inside: bool = False  # of a marked article
    element: int = 0
    link: bool = False


@dataclass
class Suspect:
    """An element that may be furniture by its class or id (``sure``: surely), as a form (sure) or as a list of links (``plain``), and
    what it holds outside of tags and roles of furniture."""
    sure: bool
    inside: bool  # of a marked article
    within: int = -1  # the suspect around it
    words: int = 0
    links: int = 0
    articles: int = 0
    plain: bool = False


@dataclass
class Element:
    """An element outside of furniture, by the runs in it."""
    tag: str
    parent: int
    depth: int
    first: int
    last: int = -1  # the run after its last one
    marked: str = ""  # article or main


@dataclass
class Page:
    runs: list[Run] = field(default_factory=list)
    blocks: list[list[str]] = field(default_factory=list)
    furniture: list[bool] = field(default_factory=list)
    articles: int = 0
    words: int = 0
    suspects: dict[int, Suspect] = field(default_factory=dict)  # by the place of their tag in the source
    elements: list[Element] = field(default_factory=list)


@dataclass(slots=True)
class Open:
    """An element that is open, and what holds for text in it."""
    tag: str
    furniture: bool
    inside: bool  # of a marked article
    around: int  # place of the innermost suspect
    block: str  # tag of the innermost block
    block_at: int  # its place in the stack
    link_at: int  # place of the innermost link
    element: int


def is_furniture(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in OWN_ARTICLE:
        return False
    if tag in FURNITURE_TAGS or (tag == "header" and not in_article) or attributes.get("role", "").lower() in FURNITURE_ROLES:
        return True
    if not in_article and ("hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "").lower()):
        return True
    return tag == "noscript" and not in_article


def suspect(tag: str, attributes: dict[str, str], in_article: bool) -> Suspect | None:
    if tag in OWN_ARTICLE or tag in HEADINGS or tag == "p":
        return None
    if tag in FORM_TAGS or attributes.get("role", "").lower() in FORM_ROLES:
        return Suspect(True, in_article)
    named, sure, content = False, False, False
    for name in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        parts = [p.lower() for p in NAME_PART.findall(name)]
        first = next((k for k, p in enumerate(parts) if p in FURNITURE_NAMES), None)
        if first is None:
            content |= not CONTENT_NAMES.isdisjoint(parts)
        elif NOT_SO.isdisjoint(parts[:first]) and not (in_article and tag == "header" and FURNITURE_NAMES.isdisjoint(set(parts) - {"header"})):
            named = True
            sure |= FURNITURE_NAMES | BESIDE >= set(parts) and not ALSO_SECTIONS | BESIDE >= set(parts)
    if named:
        return Suspect(sure and not content, in_article)
    return Suspect(False, False, plain=True) if tag in LISTS and not in_article else None


def is_named_furniture(found: Suspect, page: Page) -> bool:
    """Whether a suspect is left out. One that holds a marked article never is, nor one that holds most words, unless the article is beside it."""
    if found.articles or (2 * found.words >= page.words and (found.inside or not page.articles)):
        return False
    if found.plain:
        return bool(page.articles and found.words) and 2 * found.links >= found.words
    return found.sure or 2 * found.links >= found.words


def marks_article(tag: str, attributes: dict[str, str]) -> bool:
    return tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article")


def parse(source: str) -> Page:
    """Runs and blocks of a page; parsed once more if there are suspects, as what they are is known at the end only."""
    page = parse_as(source, {})
    if not page.suspects:
        return page
    for found in reversed(page.suspects.values()):
        if found.within >= 0:
            outer = page.suspects[found.within]
            outer.words, outer.links, outer.articles = outer.words + found.words, outer.links + found.links, outer.articles + found.articles
    named = {k: is_named_furniture(v, page) for k, v in page.suspects.items()}
    return parse_as(source, named, frozenset(k for k, v in page.suspects.items() if not named[k] and not v.plain and not v.articles and 2 * v.words < page.words))


def parse_as(source: str, named: dict[int, bool], weighed: frozenset[int] = frozenset()) -> Page:
    """Runs, blocks and suspects of a page; ``named`` tells whether the suspect at a place of the source is furniture, ``weighed`` has those
    whose words have a weight of their own."""
    page, at, n, last_end = Page(), 0, len(source), source.rfind(">")
    page.elements.append(Element("body", -1, 0, 0))
    stack: list[Open] = []
    places: dict[str, list[int]] = {}  # of the open elements of each name in the stack
    text: list[str] = []
    root = here = Open("body", False, False, -1, "body", -1, -1, 0)

    def end_block() -> None:
        if text:
            page.blocks.append(text.copy())
            page.furniture.append(here.furniture)
            text.clear()

    def add_text(raw: str) -> None:
        if raw:
            words = len(raw.split())
            text.append(raw)
            if words:
                link = here.link_at >= 0 and len(stack) - here.link_at <= 4
                if not here.furniture:
                    page.words += words
                    if here.around >= 0:
                        page.suspects[here.around].words += words
                        page.suspects[here.around].links += words * link
                kind = "furniture" if here.furniture else "named" if here.around in weighed else "heading" if here.block in HEADINGS else here.block
                page.runs.append(Run(f"word {kind}{' link' if link else ''}", words, len(page.blocks), here.inside, here.element, link))

    def add_tag(name: str, inside: bool, element: int) -> None:
        if name in CELLS and page.runs and page.runs[-1].key[:4] == "tag " and page.runs[-1].key[4:] in CELLS:
            return  # between two words, cells and items count once
        page.runs.append(Run(f"tag {name}", inside=inside, element=element))

    def pop(to: int) -> None:
        nonlocal here
        while len(stack) > to:
            gone = stack.pop()
            places[gone.tag].pop()
            if gone.element != (stack[-1].element if stack else 0):
                page.elements[gone.element].last = len(page.runs)
        here = stack[-1] if stack else root

    while at < n:
        start = source.find("<", at)
        if start < 0 or start > last_end:  # no tag ends any more; a comment that opens here hides the rest
            hidden = source.find("<!--", max(start, at)) if start >= 0 else -1
            add_text(html.unescape(source[at:hidden] if hidden >= 0 else source[at:]))
            break
        found = TAG.match(source, start) or LOOSE.match(source, start)
        if not found:
            add_text(html.unescape(source[at:start + 1]))
            at = start + 1
            continue
        add_text(html.unescape(source[at:start]))
        at = found.end()
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            text.append(" ")
            continue
        block = tag not in INLINE
        if found[1]:
            if block:
                end_block()
            inside, furniture, element = here.inside, here.furniture, here.element
            if places.get(tag):
                k = places[tag][-1]
                inside, furniture, element = stack[k].inside, stack[k].furniture, stack[k].element
                pop(k)
            if not furniture:
                add_tag(tag, inside and tag not in OWN_ARTICLE, element)
            continue
        attributes = {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(found[3] or "")} if found[3] else {}
        if block:
            end_block()
            if tag in SAME_CLOSES or tag in CLOSES_P:
                closing = tag if tag in SAME_CLOSES else "p"
                k = here.block_at
                while k >= 0 and stack[k].tag != closing and tag in SAME_CLOSES and stack[k].tag == "p":
                    k = stack[k - 1].block_at if k else -1
                if k >= 0 and stack[k].tag == closing:
                    pop(k)
        furniture = here.furniture or is_furniture(tag, attributes, here.inside) or named.get(start, False)
        around, inside = here.around, here.inside
        if not furniture and (found_name := suspect(tag, attributes, inside)):
            found_name.within, page.suspects[start], around = around, found_name, start
        article = marks_article(tag, attributes) and not furniture
        if not here.furniture:  # furniture counts as one tag, whatever is in it
            add_tag("furniture" if furniture else tag, inside, here.element)
        if article and not inside:
            page.articles += 1
            if around >= 0:
                page.suspects[around].articles += 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            at = n if end is None else (source.find(">", end.start()) + 1 or n)
            continue
        if tag not in VOID and not (found[3] or "").rstrip().endswith("/"):
            element = here.element
            if block and not furniture:
                kind = "" if not article else "main" if tag == "main" or attributes.get("role", "").lower() == "main" else "article"
                page.elements.append(Element(tag, element, page.elements[element].depth + 1, len(page.runs), marked=kind))
                element = len(page.elements) - 1
            places.setdefault(tag, []).append(len(stack))
            stack.append(Open(tag, furniture, (inside or article) and not furniture, around, tag if block else here.block, len(stack) if block else here.block_at,
                              len(stack) if tag == "a" else here.link_at, element))
            here = stack[-1]
    end_block()
    pop(0)
    page.elements[0].last = len(page.runs)
    return page


#: Counts that hold before any page is seen: (inside, outside).
PRIOR = {"word furniture": (0.1, 50.0), "tag furniture": (0.1, 50.0), "word heading": (5.0, 2.0), "word p": (20.0, 1.0), "tag p": (20.0, 2.0)}


def prior(key: str) -> tuple[float, float]:
    if key in PRIOR:
        return PRIOR[key]
    if key.startswith("word"):
        return (0.1, 50.0) if key.startswith("word furniture") else (2.0, 4.0) if key.endswith("link") else (5.0, 2.0)
    return (5.0, 1.0) if key[4:] in INLINE | HEADINGS else (2.0, 2.0)


def weight(key: str, counts: dict[str, tuple[float, float]]) -> float:
    """Words score log(1 + inside / outside), tags -log(1 + outside / inside), of the counts and the prior."""
    inside, outside = (a + b for a, b in zip(counts.get(key, (0.0, 0.0)), prior(key)))
    return math.log1p(inside / outside) if key.startswith("word") else -math.log1p(outside / inside)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part with the largest sum, in one pass; (0, 0) if there is none above zero."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best or (total == best and region[0] == start and best > 0):
            best, region = total, (start, k + 1)
    return region


def chosen(page: Page, start: int, end: int) -> list[int]:
    """The blocks of the region from run ``start`` to ``end``, widened to whole elements."""
    blocks = {run.block for run in page.runs[start:end] if run.words}
    for kind in ("article", "main"):  # where a main holds articles, they are what it marks
        touched = [e for e in page.elements if e.marked == kind and e.first < end and start < e.last]
        if touched:
            return sorted(blocks | {run.block for e in touched for run in page.runs[e.first:e.last] if run.words})
    if start < end and not page.articles:
        a, b = page.runs[start].element, page.runs[end - 1].element
        while a != b:  # up to the smallest element that holds both ends
            ea, eb = page.elements[a], page.elements[b]
            a, b = (ea.parent, b) if ea.depth > eb.depth else (a, eb.parent) if eb.depth > ea.depth else (ea.parent, eb.parent)
        around = page.elements[a]
        if around.depth and around.tag not in ("html", "body"):
            words: dict[int, list[int]] = {}
            for run in page.runs[around.first:around.last]:
                if run.words:
                    n = words.setdefault(run.block, [0, 0])
                    n[0] += run.words
                    n[1] += run.words * run.link
            blocks |= {k for k, (n, links) in words.items() if 2 * links < n}
    return sorted(blocks)


def main_text(source: str | None, weights: dict[str, float], counts: dict[str, tuple[float, float]]) -> str:
    page = parse(source or "")
    scores = []
    for run in page.runs:
        if run.key not in weights:
            weights[run.key] = weight(run.key, counts)
        scores.append(weights[run.key] * (run.words or 1))
    texts = (" ".join("".join(page.blocks[b]).split()) for b in chosen(page, *best_region(scores)) if not page.furniture[b])
    return "\n".join(t for t in texts if t)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict[str, tuple[float, float]]:
    """(inside, outside) counts by place and tag, of TRAIN_PAGES pages at most that mark exactly one article."""
    marked = F.lower(html_col).rlike(r"<(article|main)[\s>]|role=.?(main|article)\b")
    sample = pages.where(marked).select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(TRAIN_PAGES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[float]] = {}
        for batch in batches:
            for source in batch.column(0):
                page = parse(source.as_py() or "")
                if page.articles == 1:
                    for run in page.runs:
                        name = run.key.split(" ", 1)[1].split()[0]
                        if name.isascii() and len(name) <= 16:
                            found.setdefault(run.key, [0.0, 0.0])[0 if run.inside else 1] += run.words or 1
        if found:
            yield pa.RecordBatch.from_pydict({"key": list(found), "inside": [v[0] for v in found.values()], "outside": [v[1] for v in found.values()]})

    rows = pages.join(F.broadcast(sample), id_col).select(html_col).mapInArrow(count, "key string, inside double, outside double")  # TRAIN_PAGES ids at most
    sums = rows.groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()  # tags of a bounded sample
    return {r["key"]: (r["inside"], r["outside"]) for r in sums}


def extract(pages: DataFrame, counts: dict[str, tuple[float, float]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per input row, in one pass."""
    types = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    shared = pages.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: dict[str, float] = {}
        for batch in batches:
            texts = [main_text(v.as_py(), weights, shared.value) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(np.array(list(map(len, texts)), dtype=np.int64))],
                                             names=[id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"{id_col} {types[id_col]}, {url_col} {types[url_col]}, text string, n_chars long")
