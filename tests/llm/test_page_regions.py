"""The scan decides what is content: pages of many layouts, with and without article, marked wrappers, left-out ends, long pages."""

import html
import os
import time
from collections import Counter

import pytest
from compare import duck
from demandscope.llm import html_extract

SF = "/root/testdata/sf0.01"
SAY = "green river walks under the bright stone cloud near the gamma delta " * 3


@pytest.fixture(scope="module")
def pages():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables aren't here")
    return [p for (p,) in duck(SF).sql("SELECT html FROM pages").fetchall()]


def test_the_whole_page_is_another_text(pages, monkeypatch):
    got = [html_extract.extract(p) for p in pages]
    monkeypatch.setattr(html_extract, "best_region", lambda scores: (0, len(scores)))
    assert sum(html_extract.extract(p) != g for p, g in zip(pages, got, strict=True)) > 0.9 * len(pages)


@pytest.mark.parametrize("name", ["div", "section", "td"])
def test_articles_without_their_tag(pages, name):
    other = lambda p: p.replace("<article>", f"<{name}>").replace("</article>", f"</{name}>")
    assert sum(html_extract.extract(other(p)) == html_extract.extract(p) for p in pages) >= 0.97 * len(pages)


def test_held_out_layouts():
    both = said = wanted = 0
    for source, spans in html_extract.labelled_pages(150, seed=1234):
        page = html_extract.Page(source)
        want = Counter(w for (_, _, text, _), c in zip(page.pieces, html_extract._labels(page, spans), strict=True) if c and text for w in html.unescape(text).split())
        got = Counter(html_extract.extract(source).split())
        both, said, wanted = both + sum((want & got).values()), said + sum(got.values()), wanted + sum(want.values())
    assert both >= 0.97 * said and both >= 0.97 * wanted


@pytest.mark.parametrize("mark", ["content no-sidebar", "layout has-sidebar", "post-header", "page header-fixed", "content"])
def test_marked_wrappers_alone(mark):
    assert html_extract.extract(f'<html><body><div class="{mark}">' + f"<p>{SAY}</p>" * 4 + "</div></body></html>") == "\n\n".join([SAY.strip()] * 4)


def test_what_interrupts_an_article_is_left_out():
    body = f"<h1>Of rivers</h1><p>{SAY}</p>"
    for box in ('<div class="ad">alpha beta gamma delta</div>', "<aside><p>alpha beta gamma delta near</p></aside>", "<script>alpha()</script>", "<div hidden>alpha</div>", '<div class="share"><a>alpha</a> <a>beta</a></div>'):
        assert html_extract.extract(f"<html><body><nav><ul><li><a href=/>one</a></ul></nav><article>{body}{box}<p>{SAY}</p></article><footer>end of it</footer></body></html>") == f"Of rivers\n\n{SAY.strip()}\n\n{SAY.strip()}"


def test_left_out_ends():
    menu = "<ul><li class=menu><a href=/a>alpha</a><li class=menu><a href=/b>beta</a></ul>"
    page = f"<body><nav>{menu}</nav><article><h1>T</h1><p>{SAY}<p>{SAY}<ul><li>one two three<li>four five six</ul><table><tr><td>a b c<td>d e f<tr><td>g h i</table><p>{SAY}</article>"
    assert html_extract.extract(page) == "\n\n".join(["T", SAY.strip(), SAY.strip(), "one two three", "four five six", "a b c", "d e f", "g h i", SAY.strip()])


@pytest.mark.parametrize("part", ["<li>one two three", "<li class='menu'>x", "<b>x", "<div>x", "</p></li></b>x", "<p title='", "<dt>a<dd>b", "<div hidden>", "<table><tr><td>x"])
def test_time_is_linear(part):
    html_extract.learned()
    took = []
    for n in (20_000, 100_000):
        began = time.perf_counter()
        html_extract.extract("<body><ul>" + part * n)
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 1 and took[1] < 30
