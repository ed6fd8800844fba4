"""Extraction from pages written by hand and, on given pages, against their plain template."""

import re
from html import unescape

import pandas as pd
import pytest

from evgraph.llm import html_text, queries

LONG = "The river rose slowly, then quickly, and by noon, as the farmers had feared, it stood at the doors of the mill."


def page(body):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        (page(f"<nav><a href=/>Home</a></nav><article><h1>Flood</h1><p>{LONG}<p>{LONG} <b>again</b></article><footer>&copy; x</footer>"), f"Flood\n\n{LONG}\n\n{LONG} again"),
        (page(f"<header><h1>Site</h1></header><div class='sidebar'><p>{LONG}</p></div><div id=content><p>{LONG}</p><p>a<br>b</p></div><div id='comments'><p>{LONG} {LONG}</p></div>"), f"{LONG}\n\na b"),
        (page(f"<main><p>{LONG}</p><form><p>{LONG}</p><input></form><script>var a='<p>x</p>';</script><ul><li>one<li>two</ul></main><div class='cookie-notice'>We use cookies, {LONG}</div>"), f"{LONG}\n\none\n\ntwo"),
        (page(f"<article><p>{LONG}</p><div class='ad'>Buy</div><aside>{LONG}</aside><section class=comments><p>{LONG}</p></section></article>"), LONG),
        (page(f"<article><p>{LONG}</p><p>caf&eacute; &#8212; &lt;b&gt; 3 < 4</article"), f"{LONG}\n\ncafé — <b> 3 < 4"),
        (page(f"<div class='content with-sidebar'><div class='entry-header'><h1>Flood</h1></div><div class='post-body'><p>{LONG}</p><p>{LONG}</p></div><ol class='commentlist'><li><p>{LONG} {LONG}</p></li></ol><div id='cookieBanner'>We use cookies, and more.</div><ul class='share-links'><li><a href=x>Share</a></ul></div>"), f"Flood\n\n{LONG}\n\n{LONG}"),
        (page(f"<div role=main><p>{LONG}</p><p class='ad'>Buy now</p><blockquote><p>{LONG}</p></blockquote><table><tr><td>a</td><td>b</td></tr></table></div><div class='related-posts'><p>{LONG}</p></div><section id='respond'><h3>Reply</h3></section>"), f"{LONG}\n\n{LONG}\n\na\n\nb"),
        (page(f"<div><div><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div></div>"), f"{LONG}\n\n{LONG}\n\n{LONG}"),
        (page(f"<h1>T</h1><div class='discussion'><p>{LONG}</p><p>{LONG}</p></div>"), f"T\n\n{LONG}\n\n{LONG}"),
        (page(f"<article><section id='methods'><h2>M</h2><p>{LONG}</p></section><section id='discussion'><h2>D</h2><p>{LONG}</p></section><section class='related-work'><h2>R</h2><p>{LONG} <a href=x>see</a></p></section></article>"), f"M\n\n{LONG}\n\nD\n\n{LONG}\n\nR\n\n{LONG} see"),
        (page(f"<div id=wrap><div class='section'><h2>Terms</h2><p>{LONG}</p></div><div class='section legal'><h2>Law</h2><p>{LONG}</p></div><div class='section print'><p>{LONG}</p></div></div><div class='footer legal'><a href=x>Imprint</a></div>"), f"Terms\n\n{LONG}\n\nLaw\n\n{LONG}\n\n{LONG}"),
        (page(f"<div class=post><h1>F</h1><p>{LONG}</p></div><div class=discussion><div class=reply><cite>Ann</cite><p>{LONG} {LONG}</p></div><div class=reply><cite>Bob</cite><p>{LONG} {LONG} {LONG}</p></div></div>"), f"F\n\n{LONG}"),
        (page(f"<div class=post><p>{LONG}</p><div class=tags><a href=a>one</a> <a href=b>two</a></div><div class=search><p>Find it <input name=q></p></div></div>"), LONG),
        (page(f"<h1>T</h1><div class='comments-page'><p>{LONG}</p><p>{LONG}</p></div>"), f"T\n\n{LONG}\n\n{LONG}"),
        (page(f"<div class='notice'><p>{LONG}</p><p>{LONG}</p></div>"), f"{LONG}\n\n{LONG}"),
        (page(f"<article><h1>A</h1><p>{LONG}</p><section id=promotion><h2>Promotion of officers</h2><p>{LONG}</p></section><section id=navigation><h2>Navigation at sea</h2><p>{LONG}</p></section><section class=social><p>{LONG}</p></section></article>"), f"A\n\n{LONG}\n\nPromotion of officers\n\n{LONG}\n\nNavigation at sea\n\n{LONG}\n\n{LONG}"),
        (page(f"<div class=post><h1>A</h1><p>{LONG}</p></div><div id=comments>{f'<p>{LONG}</p>' * 5}</div>"), f"A\n\n{LONG}"),
        (page(f"<div class=post><h1>A</h1><p>{LONG}</p></div><div id=comments>{f'<div><b>Ann</b><p>{LONG} {LONG}</p></div>' * 4}</div>"), f"A\n\n{LONG}"),
        (page(f"<div class=sidebar><p>{LONG}</p><p>{LONG}</p></div><div class=text><p>{LONG} End.</p></div>"), f"{LONG} End."),
        (page(f"<div class=header><p>{LONG}</p><p>{LONG}</p></div><div class=text><p>{LONG} End.</p></div>"), f"{LONG} End."),
        (page(f"<main><article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{LONG} {LONG}</p><p>{LONG} {LONG}</p></article></main>"), f"One\n\n{LONG}\n\nTwo\n\n{LONG} {LONG}\n\n{LONG} {LONG}"),
        (page(f"<article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{LONG} {LONG}</p></article>"), f"One\n\n{LONG}\n\nTwo\n\n{LONG} {LONG}"),
        (page(f"<article><div class=lead><p>Short, but first.</p></div><div><p>{LONG} {LONG}</p><p>{LONG}</p></div><div class=end><p>Fine.</p></div></article>"), f"Short, but first.\n\n{LONG} {LONG}\n\n{LONG}\n\nFine."),
        (page(f"<article><p>{LONG}</p><div class=advert><h3>Buy</h3><p>{LONG}</p></div><div class='newsletter'><h3>News</h3><p>{LONG}</p></div></article>"), LONG),
        (page(f"<div class='page sidebar-right'><div class=text><p>{LONG}</p></div><div class=sidebar><p>{LONG} {LONG} {LONG}</p></div></div>"), LONG),
        (page(f"<div><p>{LONG}</p></div><div><p>{LONG[:-1]}!</p></div>"), f"{LONG}\n\n{LONG[:-1]}!"),
    ],
)
def test_pages(html, text):
    assert html_text.main_text(html) == text


def test_deep_and_broken():
    assert html_text.main_text("<div>" * 5000 + LONG) == LONG
    assert html_text.main_text("<p>" + LONG + "<!-- open") == LONG
    assert html_text.main_text(f"<p>{LONG}</p></div></b></p><p x='1>2'>{LONG}") == f"{LONG}\n\n{LONG}"


def test_large_broken_pages():
    html = f"<div class=a><p>{LONG}<b>" * 20000
    assert html_text.main_text(html).count("The river") == 20000


def test_given_pages(spark):
    real = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").set_index("page_id")
    got = queries.queries()["op4_html_text"](spark, "/root/testdata/sf0.01").toPandas().set_index("page_id")
    assert len(got) == len(real) and list(got.columns)[:3] == ["url", "text", "n_chars"]
    for i, html in real.html.items():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1]
        want = [" ".join(unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1|ul|li)>", article)]
        assert got.text[i] == "\n\n".join(b for b in want if b), i
    assert (got.n_chars == got.text.map(len)).all()


def test_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", page(f"<p>{LONG}</p>"), "clash"), (1, "u", None, None)], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, html_text.extract(pages).collect())) == [(1, "u", "", 0), (1, "u", LONG, len(LONG))]
    assert html_text.extract(pages.limit(0)).count() == 0
