from __future__ import annotations

import html
import re

from moodstream.llm.html_text import extract_text, main_text, op6

LONG = "This is the text of the article and it is long enough to be read by all of the people who like to read it in the morning."

PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>bad";</script></head><body>
<header class=top><h2>Site</h2></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice"><p>{LONG} We use cookies.</p></div><div id=ad-1>Buy now</div>
<article><h1>Head &amp; line</h1><p>{LONG}<br>More&nbsp; of
it.<p>Short one.</p><aside>{LONG} aside</aside><form><p>{LONG} form</p></form>
<p><a href=x>all of this is one long link to some other page that nobody reads</a></p><p>{LONG} &#233;&lt;b&gt;</p>
<section class="comments"><p>{LONG} said a reader.</p></section></article>
<div class="sidebar"><p>{LONG} side</p></div><footer>&copy; {LONG}</footer></body>"""


def test_marked_article():
    assert main_text(PAGE) == f"Head & line\n{LONG} More of it.\nShort one.\n{LONG} é<b>"


def test_unmarked_page_follows_the_two_passes():
    page = f"<div><a href=a>Home</a> <a href=b>News</a></div><div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div>Zzz qqq</div><div><a href=c>Imprint and other things</a></div>"
    assert main_text(page) == f"{LONG}\nYes.\n{LONG}"


def test_edges():
    assert main_text(None) == main_text("") == main_text("<p>") == main_text("<script>x") == ""
    assert main_text("<article>One &amp;amp; two</article>") == "One &amp; two"
    assert main_text("<article><p>a < b and <b>c</article>") .startswith("a")
    assert main_text("<article>" + f"<p>{LONG}</p>" * 3000 + "</article>").count("\n") == 2999


def test_odd_rows(llm):
    pages = llm.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (2, "u", PAGE, "x"), (2, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    rows = extract_text(pages).collect()
    assert sorted(r.n_chars for r in rows) == [0, 0, *[len(main_text(PAGE))] * 2]
    assert all(len(r.text) == r.n_chars for r in rows)
    assert extract_text(pages.limit(0)).count() == 0


def test_registered_query_against_the_article_element(llm):
    folder = "/root/testdata/sf0.001"

    def plain(page):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", article)]
        return "\n".join(b for b in blocks if b)

    want = {r["page_id"]: plain(r["html"]) for r in llm.read.parquet(f"{folder}/pages.parquet").collect()}
    assert {r.page_id: r.text for r in op6(llm, folder).collect()} == want
