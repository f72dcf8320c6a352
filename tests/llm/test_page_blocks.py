"""Text that belongs to the article, and markup that must not cost more than its length."""

import time

import pytest

from wickwork.llm import html_text

WORDS = "Some plain words of the text that people came here to read today."


@pytest.fixture(scope="module")
def tree():
    return html_text.trained_tree()


@pytest.mark.parametrize(
    "page",
    ["<b>" * 200_000, "<div>" * 200_000, "<p><i>" * 100_000, "<b>" * 2000 + "</i>" * 200_000,
     "<div>" + "<b>" * 100_000 + "</p></u></div>" * 60_000, "<head>" + "<b>" * 200_000, "<template>" * 200_000,
     "<head>" + "<template>" * 100_000 + "<p>" * 100_000, "</div>" * 200_000, "<ul>" + "<li><a href=x>" * 100_000],
)
def test_broken_markup_takes_time_in_proportion_to_its_length(tree, page):
    start = time.process_time()
    html_text.main_text(f"<body>{page}<article><p>{WORDS}</p></article>", tree)
    assert time.process_time() - start < 4


@pytest.mark.parametrize(
    "inside, text",
    [("<p>where <math><mi>x</mi></math> is a number</p>", "where x is a number"),
     ("<p>see <object data=a.svg>the fallback words</object> here</p>", "see the fallback words here"),
     (f"<p hidden>{WORDS}</p>", WORDS),
     (f"<section class='legal-analysis'><p>{WORDS}</p></section>", WORDS),
     ("<div class=share-price><p>It closed at 42 after a long and busy day.</p></div>", "It closed at 42 after a long and busy day."),
     ("<p><a href=1>one two</a> <a href=2>three four</a> <a href=3>five six seven</a> eight</p>", "one two three four five six seven eight"),
     (f"<div class=ad><p>{WORDS}</p></div>", ""), (f"<div class='share-buttons'><p>{WORDS}</p></div>", ""),
     (f"<div class='related-posts'><p>{WORDS}</p></div>", ""), (f"<aside>{WORDS}</aside>", "")],
)
def test_what_stands_in_an_article(tree, inside, text):
    page = f"<body><nav><a href=a>Home</a></nav><article><h1>A title</h1><p>{WORDS}</p>{inside}<p>{WORDS} End.</p></article>"
    want = " ".join(t for t in ("A title", WORDS, text, WORDS + " End.") if t)
    assert html_text.main_text(page, tree) == want


def test_a_long_paragraph_before_a_short_one(tree):
    long = " ".join(f"word{i}" for i in range(40))
    assert long in html_text.main_text(f"<body><p>{long}</p><p>two words</p>", tree)


def test_misnested_ends_close_what_they_closed_before(tree):
    page = f"<body><article><p><b>{WORDS}</p></b><p>{WORDS}</i></div></p></article><footer>Not this one</footer>"
    assert html_text.main_text(page, tree) == f"{WORDS} {WORDS}"
