"""No article text is lost to tables, lists, forms or nesting, and broken markup costs linear time."""

import os
import time
from html.parser import HTMLParser

import pytest

from contractlake.llm import html_text as h

PAGES = "/root/testdata/sf0.01/pages.parquet"
PROSE = "Several words of running prose that make a paragraph of the article, long enough to count."
MENU = "<nav><a href='/'>Home</a> <a href='/x'>News</a></nav>"
FOOT = "<footer>All rights reserved by somebody</footer>"


def counts():
    found = {}
    import duckdb
    for (source,) in duckdb.sql(f"select html from '{PAGES}'").fetchall():
        page = h.parse(source or "")
        if page.articles == 1:
            for run in page.runs:
                found.setdefault(run.key, [0.0, 0.0])[0 if run.inside else 1] += run.words or 1
    return {k: tuple(v) for k, v in found.items()}


LEARNED = [{}, counts()] if os.path.exists(PAGES) else [{}]


def text(source, learned):
    return h.main_text(source, {}, learned)


def table(rows):
    return "<table>" + "".join(f"<tr><td>r{i}</td><td>{i}</td></tr>" for i in range(rows)) + "</table>"


def cells(rows):
    return [x for i in range(rows) for x in (f"r{i}", f"{i}")]


@pytest.mark.parametrize("learned", LEARNED)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div role='main'>{}</div>", "<div class='body-text'>{}</div>"])
def test_edges_of_an_article_stay(learned, wrap):
    paragraphs = f"<p>{PROSE}</p>" * 3
    for inner, want in [
            (paragraphs + table(60), [PROSE] * 3 + cells(60)),
            (table(60) + paragraphs, cells(60) + [PROSE] * 3),
            (paragraphs + "<dl><dt>Term</dt><dd>its meaning</dd><dt>B</dt><dd>c</dd></dl>", [PROSE] * 3 + ["Term", "its meaning", "B", "c"]),
            (paragraphs + "<div><div><div><div>End</div></div></div></div>", [PROSE] * 3 + ["End"]),
            ("<figure><img src='a'><figcaption>First</figcaption></figure>" + paragraphs, ["First"] + [PROSE] * 3)]:
        page = f"<html><head><title>T</title></head><body>{MENU}{wrap.format(inner)}{FOOT}</body></html>"
        assert text(page, learned) == "\n".join(want)


@pytest.mark.parametrize("learned", LEARNED)
def test_an_article_that_is_a_table(learned):
    assert text(f"<body>{MENU}<article>{table(30)}</article>{FOOT}</body>", learned) == "\n".join(cells(30))


@pytest.mark.parametrize("learned", LEARNED)
def test_forms_around_the_page_are_no_furniture_but_forms_in_it_are(learned):
    signup = "<form action='/s'><label>Your mail</label><input name='m'><button>Join us</button></form>"
    for wrap in ("<article>{}</article>", "<div>{}</div>"):
        page = f"<body><form id='aspnetForm' method='post'>{MENU}{wrap.format(f'<p>{PROSE}</p><p>{PROSE}</p>' + signup + f'<p>{PROSE}</p>')}{FOOT}</form></body>"
        assert text(page, learned) == "\n".join([PROSE] * 3)
    assert text(f"<body><form role='search'>find it here</form><article><p>{PROSE}</p></article></body>", learned) == PROSE


@pytest.mark.parametrize("learned", LEARNED)
def test_hidden_text_of_an_article_stays_and_outside_goes(learned):
    page = f"<body><div hidden>{PROSE}</div><noscript>Please enable scripts</noscript><article><p>{PROSE}</p><p hidden>More to read</p><noscript>Even more</noscript></article></body>"
    assert text(page, learned) == "\n".join([PROSE, "More to read", "Even more"])


@pytest.mark.parametrize("learned", LEARNED)
def test_link_lists_between_articles_go(learned):
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Another story number {i}</a></li>" for i in range(5)) + "</ul>"
    page = f"<body><article><p>{PROSE}</p></article>{links}<article><p>{PROSE}</p></article></body>"
    assert text(page, learned) == "\n".join([PROSE] * 2)
    inside = f"<body><article><p>{PROSE}</p>{links}</article></body>"
    assert text(inside, learned).count("Another story") == 5


@pytest.mark.parametrize("junk", ["<b>", "<a ", "<i></b>", "<b><p>x", "<div>", "<a \"", "<a '\">", "<li><b>", "<td>", "</p>", "<p><span>", "<font><table>"])
def test_broken_markup_takes_linear_time(junk):
    page = f"<article><p>{PROSE}</p></article>" + junk * 100_000
    start = time.time()
    assert text(page, {}).startswith(PROSE)
    assert time.time() - start < 20


class Marked(HTMLParser):
    """The text of an article by the tags of the given pages alone: blocks of the one ``<article>``, furniture left out."""
    GONE = {"script", "style", "nav", "aside", "footer", "form", "button", "template"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.now = [], [], []

    def cut(self):
        if t := " ".join("".join(self.now).split()):
            self.blocks.append(t)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.now.append(" ")
        elif tag not in h.INLINE:
            self.cut()
        if tag not in h.VOID:
            self.open.append((tag, dict(attrs).get("class") or ""))

    def handle_endtag(self, tag):
        if tag not in h.INLINE:
            self.cut()
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        tags = [t for t, _ in self.open]
        if "article" in tags and not self.GONE & set(tags) and not any({"ad", "comments", "notice", "share", "related", "cookie", "promo"} & set(c.split()) for _, c in self.open):
            self.now.append(data)


@pytest.mark.skipif(not os.path.exists(PAGES), reason="test data not present")
def test_pages_equal_their_marked_article():
    import duckdb
    differ, seen = 0, 0
    for (source,) in duckdb.sql(f"select html from '{PAGES}'").fetchall():
        if source and source.lower().count("<article") == 1:
            p = Marked()
            p.feed(source)
            p.cut()
            seen += 1
            differ += "\n".join(p.blocks) != text(source, LEARNED[-1])
    assert seen > 100 and differ == 0
