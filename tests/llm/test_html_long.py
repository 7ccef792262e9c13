"""Pages whose markup is left open or nested without end, in time that grows with their length."""

from __future__ import annotations

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moodstream.llm.html_text import _Tags, blocks_of, main_text

GOOD = "This is the text of the article, and it has all of the words that a reader would expect to find in it, as they are in use."
# The grammar of a tag as one pattern, which is slow on open markup and right on short pages.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)


def tags(page):
    walk, at, out = _Tags(page), 0, []
    while (tag := walk.next(at)) is not None:
        out.append(tag)
        at = tag[1]
    return out


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["<a", "<", ">", '"', "'", " ", "x", "</p", "=", "<!--", "-->", "<!", "<?", "<![CDATA[", "]]>", "<b1:-", "\n", "<1"]), max_size=14).map("".join))
def test_tags_are_those_of_the_pattern(page):
    want = [(m.start(), m.end(), (m[2] or "").lower(), bool(m[1]), m[3] or "") for m in TAG.finditer(page)]
    assert tags(page) == want


MB = 1_000_000
OPEN = {
    "tags": "<a " * (MB // 3), "quotes": '<a "' * (MB // 4), "quotes and an end": '<a "' * (MB // 4) + ">", "odd quotes": "<a '\"" * (MB // 5) + ">",
    "raw": "<script>" + "</script " * (MB // 9), "raw again": "<title><" * (MB // 8), "comments": "<!-" * (MB // 3), "brackets": "<" * MB, "declarations": "<!x " * (MB // 4),
    "attributes": "<p " + "a= " * (MB // 3) + ">", "class": '<div class="' + "a-" * (MB // 2) + '">', "letters": "x" * MB, "names": "<" + "a-" * (MB // 2),
}


@pytest.mark.parametrize("kind", sorted(OPEN))
def test_a_megabyte_of_open_markup(kind):
    start = time.perf_counter()
    text = main_text(f"<article><p>{GOOD}</p></article>" + OPEN[kind])
    assert time.perf_counter() - start < 20
    assert text.startswith(GOOD)


@pytest.mark.parametrize("box", ["div", "article", "main", "nav", "section class='sidebar'", "header", "li class='ad'"])
def test_a_hundred_thousand_nested_boxes(box):
    start = time.perf_counter()
    blocks = blocks_of(f"<{box}>x" * 100_000 + f"<p>{GOOD}</p>" + f"</{box.split()[0]}>" * 100_000)
    assert time.perf_counter() - start < 30 and sum(b.text == GOOD for b in blocks) == 1


def test_closing_tags_without_a_partner():
    start = time.perf_counter()
    assert main_text("<div>" * 50_000 + "</ul>" * 100_000 + f"<p>{GOOD}</p>") == GOOD
    assert time.perf_counter() - start < 20


def test_title_in_the_header_of_an_article():
    page = f"<body><header><h1>Site</h1><p>{GOOD}</p></header><article><header><h1>Title</h1><p>By someone, <a href=x>12 May</a></p></header><p>{GOOD}</p></article></body>"
    assert main_text(page) == f"Title\n{GOOD}"


def test_a_language_without_a_list():
    text = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。吾輩はここで始めて人間というものを見た。"
    links = "".join(f"<li><a href=/{i}>ナビゲーションの項目その{i}番目のリンクです</a></li>" for i in range(9))
    assert main_text(f"<body><nav><ul>{links}</ul></nav><div><h1>猫</h1><p>{text}</p><p>{text}</p></div><footer>{text}</footer><ul>{links}</ul></body>") == f"猫\n{text}\n{text}"
    # One good paragraph in a listed language, and text without its words is no longer taken for prose.
    assert main_text(f"<div><p>{GOOD}</p></div><div><p>{'zq' * 30} {'xw' * 90}</p></div>") == GOOD
