import pytest

from demandscope.llm import html_extract

SAY = "green river walks under the bright stone cloud near the gamma delta " * 3
BODY = f"<h1>Of rivers</h1><p>{SAY}</p><p>{SAY}</p>"
LIST = "<ul>" + "<li><a href='/x'>alpha</a></li>" * 12 + "</ul>"


@pytest.mark.parametrize("mark", ['id="content" class="no-sidebar"', 'class="has-header"', 'class="share-page"', 'class="side-by-side"'])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "{}"])
def test_a_marked_wrapper_is_no_note(mark, inner):
    page = f"<html><body><nav>{LIST}</nav><div {mark}>{inner.format(BODY)}<div class='comments'><p>{SAY}</p></div></div><footer>beta</footer></body></html>"
    say = SAY.strip()
    assert html_extract.extract(page) == f"Of rivers\n\n{say}\n\n{say}"


def test_an_article_in_a_marked_element_with_few_of_the_words():
    page = f"<html><body><div class='has-header'><article><p>{SAY}</p></article></div><div class='widget'><p>{SAY * 5}</p></div></body></html>"
    assert html_extract.extract(page) == SAY.strip()


def test_marks_still_count():
    """Comments longer than the article, teasers, and what is hidden or an aside."""
    say = SAY.strip()
    assert html_extract.extract(f"<body><div><h1>Of rivers</h1><p>{SAY}</p></div><div id='comments'><p>{SAY * 4}</p></div></body>") == f"Of rivers\n\n{say}"
    teasers = "<article><p>alpha beta gamma</p></article>" * 4
    assert html_extract.extract(f"<body><article><p>{SAY}</p></article><div class='related'>{teasers}</div></body>") == say
    assert html_extract.extract(f"<body><p>{SAY}</p><div style='display:none'><article>{SAY * 9}</article></div><aside><article>{SAY * 9}</article></aside></body>") == say
