"""Main text of pages: whole tables against a plain cut of the template, other layouts, odd pages."""

import html
import re

import pytest

from tillmark.llm import queries
from tillmark.llm.main_text import main_text

SF = "/root/testdata/sf0.001"
BOILERPLATE = (
    '<header><h2>My site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>'
    '<div class="cookie-notice">We use cookies, please agree to all of them now.</div>'
    '<div id="sidebar"><p>Also read this other long and tempting article of ours.</p></div><!-- x -->'
    "<form><label>Mail</label><input><button>Go</button></form><script>if (a < b) { p('<p>no</p>') }</script>"
    "<style>p { margin: 0 }</style><noscript>Enable scripts</noscript>"
)
TAIL = (
    '<section class="comments"><article class="comment"><p>First! I liked every word of this, thanks a lot for it.</p></article>'
    "</section><footer><p>Copyright, imprint, terms and a long line of other words.</p></footer>"
)
BODY = "<h1>Head &amp; line</h1><p>A long paragraph with <b>bold</b> and <i>slanted</i> words,\n  and more.</p><p>Short.</p>"
TEXT = "Head & line\nA long paragraph with bold and slanted words, and more.\nShort."


def cut(page):
    """What lies in the article element of the test pages, read with patterns."""
    inside = re.search("<article>(.*?)</article>", page, re.S).group(1)
    blocks = (re.sub("<(b|br)>", " ", block) for block in re.split("</?(?:p|h1)>", inside))
    return "\n".join(text for text in (" ".join(html.unescape(block).split()) for block in blocks) if text)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    given = {row.page_id: row for row in pages.collect()}
    rows = queries.page_texts(pages).collect()
    assert len(rows) == len(given) > 0
    for row in rows:
        want = cut(given[row.page_id].html)
        assert (row.url, row.text, row.n_chars) == (given[row.page_id].url, want, len(want))


@pytest.mark.parametrize(
    "around",
    ["<article>{}</article>", "<main>{}</main>", '<div role="main">{}</div>', '<div id="x1"><div>{}</div></div>', '<div itemprop="articleBody">{}</div>'],
)
def test_layouts(around):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{BOILERPLATE}{around.format(BODY)}{TAIL}</body></html>"
    assert main_text(page) == TEXT


def test_headline_in_an_article_header_and_link_lists_outside():
    assert main_text("<header>Site</header><article><header><h1>Head</h1></header><p>Words.</p></article>") == "Head\nWords."
    links = "".join(f'<li><a href="/{n}">link number {n}</a></li>' for n in range(9))
    assert main_text(f"<body><ul>{links}</ul><div>{BODY}</div><ul>{links}</ul></body>") == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        (" \n", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\nb"),
        ("<p>x&nbsp;&lt;y&gt;<br>z &#x4E2D;&#128512; &bogus;", "x <y> z 中😀 &bogus;"),
        ("<article><p>open <b>bold<p>next</article><p>out", "open bold\nnext"),
        ("<article><p>cut off in the midd", "cut off in the midd"),
        ("</div></p><p>a</b></p>", "a"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>yes</p>", "yes"),
        ("<table><tr><td>a</td><td>b</td></tr></table>", "a b"),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_long_pages_take_time_in_proportion():
    assert main_text("<article>" + "<p>word</p>" * 50_000 + "</article>") == "\n".join(["word"] * 50_000)
    assert main_text("<div>" * 20_000 + "deep" + "<i>" * 20_000 + "</b>" * 20_000) == "deep"


def test_rows_and_columns(spark):
    schema = "page_id long, url string, html string, text string, Main_Text string, n_chars int"
    rows = [(1, "u", "<p>a</p>", "t", "m", 1), (1, "u", "<p>a</p>", "t", "m", 1), (None, None, None, None, None, None)]
    found = queries.page_texts(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, found), key=str) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    assert queries.page_texts(spark.createDataFrame([], schema)).collect() == []
