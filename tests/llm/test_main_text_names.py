"""Article text under classes and ids that hold a word for page furniture."""

import pytest

from contractlake.llm import html_text

MARKED = "<html><body><nav><a href=/>Menu item</a></nav><div class=ad>Buy this now</div><article><h1>T</h1><p>Words of page {0} and some more.<p>Second</article><footer>x</footer></body></html>"
PROSE = "Some words of an article that go on for a while and say a little"


def text_of(source):
    counts = {}
    for i in range(20):
        for run in html_text.parse(MARKED.format(i)).runs:
            inside, outside = counts.get(run.key, (0.0, 0.0))
            counts[run.key] = (inside + run.inside * (run.words or 1), outside + (not run.inside) * (run.words or 1))
    return html_text.main_text(source, {}, counts)


@pytest.mark.parametrize("part", [
    "<h2 id='related-work'>{0}</h2>", "<section id='discussion'><h2>On it</h2><p>{0}</p></section>", "<h2 id='search'>{0}</h2>", "<p class='ad-hoc'>{0}</p>",
    "<div class='ad-hoc'>{0}</div>", "<section id='related-work'><p>{0} <a href=x>see</a></p></section>", "<p>We have <math><mi>{0}</mi><mo>=</mo><mn>2</mn></math> then</p>"])
@pytest.mark.parametrize("around", ["<article>{0}</article>", "<div>{0}</div>"])
def test_sections_and_headings_stay(part, around):
    body = around.format(f"<h1>Title</h1><p>{PROSE}.</p><p>{PROSE} one.</p>{part.format('kept text of this part')}<p>{PROSE} two.</p><p>{PROSE} three.</p>")
    assert "kept text of this part" in text_of(f"<html><body><nav>Menu</nav>{body}<footer>x</footer></body></html>")


@pytest.mark.parametrize("name", ["content-with-sidebar", "two-column sidebar-left", "post comments-open", "sidebar-left"])
@pytest.mark.parametrize("inner", ["{0}", "<article>{0}</article>", "<div>{0}</div>"])
def test_wrappers_stay(name, inner):
    body = inner.format(f"<p>{PROSE}.</p><div class='ad'>Buy this now</div><p>{PROSE} more.</p>")
    want = f"{PROSE}.\n{PROSE} more."
    assert text_of(f"<body><nav>Menu</nav><div class='{name}'>{body}</div><footer>x</footer></body>") == want
    assert text_of(f"<body><article><div class='{name}'>{body}</div></article></body>") == want


@pytest.mark.parametrize("part", [
    "<div class='related'><a href=x>Other page of ours</a> <a href=y>And another</a></div>", "<div class='ad-slot'>Other page of ours</div>", "<div class='search-box'><a href=x>Other page of ours</a></div>",
    "<section id='comments'><p>Other page of ours is nice</p></section>", "<div class='post-share'>Other page of ours</div>", "<p>a <math><mi>x</mi><annotation>Other page of ours</annotation></math></p>"])
def test_furniture_by_name_goes(part):
    assert "Other page" not in text_of(f"<body><article><p>{PROSE}.</p>{part}<p>{PROSE} more.</p></article></body>")


def test_comments_longer_than_the_article_go():
    assert text_of(f"<body><article><p>{PROSE}.</p></article><div id='comments'>{'<p>Nice words from a reader</p>' * 30}</div></body>") == f"{PROSE}."
