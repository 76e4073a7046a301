"""Broken, deep and very long pages."""

import random
import time

import pytest
from tilewright.llm import html
from tilewright.session import local_frame

DECLARATIONS = ["<![ x]>", "<![ endif]-->", "<![1]>", "<![%foo]>", "<![", "<![ never closed", "<![CDATA[ x ]]>", "<![if IE]>", "<!", "<!>"]


@pytest.mark.parametrize("declaration", DECLARATIONS)
def test_odd_declarations(declaration):
    article = "<article><p>" + "Words of the article stand here. " * 9 + "</p></article>"
    assert "Words of the article" in html.main_text(article + declaration)
    html.main_text(declaration + article)


def test_bogus_comment_ends_at_its_bracket():
    page = "<article><p>One sentence before it.<![ hidden ]> And one behind.</p></article>"
    assert html.main_text(page) == "One sentence before it. And one behind."


def test_broken_pages_are_never_an_error():
    rng = random.Random(3)
    pieces = ["<", ">", "</", "<!", "<!--", "-->", "<![", "]]>", "<?", "&", "&#", "&#x110000;", "&amp", "'", '"', "=", "/",
              "<p", "<div class='nav", "<a href=", "</p>", "<script>", "</script", "<style>", "<textarea>", "<svg/>", "<math>",
              "\x00", "퟿", "é", " ", "\n", "words of text", "<table><tr><td>", "<li>", "</ul>", "<h1>", "<main>"]
    for _ in range(2000):
        html.main_text("".join(rng.choices(pieces, k=rng.randrange(1, 80))))


@pytest.mark.parametrize(
    "page",
    [
        "<div>x" * 60_000, "<div>x<p>y" * 30_000 + "</b></p>" * 30_000, "<form class=menu>x<li>" * 60_000,
        "<ul><li>x" * 60_000 + "</td>" * 60_000, "<table><tr><td>x" * 20_000, "<article>x<h1>y" * 30_000,
    ],
    ids=["div", "p", "hints", "lists", "tables", "articles"],
)
def test_deep_pages(page):
    start = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - start < 5


def test_broken_pages_in_a_table(spark):
    pages = [(1, "u", d) for d in DECLARATIONS] + [(2, None, "<p>" + "long " * 200_000), (None, "u", None)]
    rows = html.extract_text(local_frame(spark, pages, "page_id long, url string, html string")).collect()
    assert len(rows) == len(pages) and max(r.n_chars for r in rows) == 999_999
