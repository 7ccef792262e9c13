"""Which boxes a class or id puts out, and what an article element is worth."""

from __future__ import annotations

import pytest

from moodstream.llm.html_text import main_text

LONG = "This is the text of the article and it is long enough to be read by all of the people who like to read it in the morning."
SIDE = f"{LONG} And this is not a part of it."


@pytest.mark.parametrize("name", [
    "content with-sidebar", "has-sidebar", "no-sidebar", "layout-sidebar-right", "has-comments", "product-review", "long-form", "sidebar-layout", "comments-open",
])
def test_layout_wrappers_stay(name):
    for inner in (f"<p>{LONG}</p>", f"<article><p>{LONG}</p></article>"):
        assert main_text(f'<div class="{name}">{inner}</div>') == main_text(f'<div id="{name}">{inner}</div>') == LONG


@pytest.mark.parametrize("name", ["sidebar", "x sidebar-left", "site-footer", "main_nav", "post-comments", "cookie-notice", "ad-1", "Side-Bar", "related__list"])
def test_parts_go(name):
    assert main_text(f'<div><p>{LONG}</p></div><div class="{name}"><p>{SIDE}</p></div>') == LONG


def test_box_of_the_article_stays():
    assert main_text(f"<div class=modal><article><p>{LONG}</p></article></div>") == LONG
    assert main_text(f"<div class=comments><main><p>{LONG}</p></main></div>") == LONG
    assert main_text(f"<div class=sidebar><article><p>{SIDE}</p></article></div><article><p>{LONG}</p><p>{LONG}</p></article>") == f"{LONG}\n{LONG}"
    assert main_text(f"<div><p>{LONG}</p></div><div class=comments><article><p>{SIDE}</p><p>{SIDE}</p></article></div>") == LONG
    assert main_text(f"<nav><main><p>{LONG}</p></main></nav>") == ""


def test_good_blocks_outside_an_article_stay():
    story = "".join(f"<div>{LONG} Part {n}.</div>" for n in range(3))
    want = [f"{LONG} Part {n}." for n in range(3)]
    assert main_text(f'{story}<div><article class="card"><p>A teaser.</p></article></div>').split("\n")[:3] == want
    assert main_text(f'<article class="card"><p>{SIDE}</p></article>{story}').split("\n")[1:] == want
    assert main_text(f"<div><p>{SIDE}</p></div><article><p>{LONG}</p><p>{LONG}</p></article>") == f"{SIDE}\n{LONG}\n{LONG}"


@pytest.mark.parametrize("name", ["comment", "comment-body", "teaser", "teaser--small", "post related", "related-post"])
def test_marked_articles_go(name):
    assert main_text(f'<div><p>{LONG}</p></div><article class="{name}"><p>{SIDE}</p><p>{SIDE}</p></article>') == LONG
