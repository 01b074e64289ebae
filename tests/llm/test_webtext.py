"""Odd pages: long ones in linear time, titles inside articles, and pages that stand in a form."""

import time

import pytest

from tapelake.llm import webtext


def text(page):
    return " ".join(b.text for b in webtext.main_blocks(page))


@pytest.mark.parametrize("piece", ["<nav>a", "<div>a", "<b>a", "<svg>a", "<p>a", "<li>a", "</x>a"])
def test_a_long_page_takes_time_in_proportion(piece):
    page = piece * (1_000_000 // len(piece))
    start = time.monotonic()
    webtext.candidates(webtext.main_blocks(page))
    assert time.monotonic() - start < 20


def test_a_header_inside_the_article_holds_its_title():
    assert text("<article><header><h1>Title</h1></header><p>body</p></article>") == "Title body"
    assert text("<header>Site</header><article><p>body</p></article>") == "body"
    assert text("<article><header class='banner'>Ad</header><p>body</p></article>") == "body"
    assert text("<main><header>Site</header><p>body</p></main>") == "body"


def test_a_form_around_a_page():
    assert text("<body><form id=f><div><nav>Menu</nav><p>body</p></div></form></body>") == "body"
    assert text("<body><form><input>Search</form></body>") == ""
    assert text("<body><p>body</p><form><p>Search</p></form></body>") == "body"


def test_nested_templates_are_told_apart():
    """A subtree counts as a template by its own hash, and all that stands in it goes."""
    page = "<div><ul><li>one</li><li><i>two</i></li></ul><section><p>three</p>four</section></div>"
    found = webtext.main_blocks(page)
    assert [b.text for b in found] == ["one", "two", "three", "four"]
    section = found[3].within
    assert section.tag == "section" and len(webtext.candidates(found)) == 6
    assert webtext.remaining("h", page, {webtext.template_key("h", section.hash)}) == "one two"
    assert webtext.remaining("g", page, {webtext.template_key("h", section.hash)}) == "one two three four"
