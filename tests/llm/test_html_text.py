"""Main text of pages whose article is known."""

import re
from html import unescape

import pytest

from plumbline.llm.html_text import content_flags, extract_text, main_text, smoothed

PARAGRAPHS = [
    "The quick survey &amp; its <b>many</b> long results were laid out over several pages by those who had asked for it.",
    "In.",
    'Others, who <a href="/x">had seen nothing of it</a>, wrote letters of some length to the editors of the three papers.',
    "Where&nbsp;the   winter\nwas long,<br>people read on and on until the snow had gone and the roads could be used again.",
]
EXPECTED = ["A headline", *(" ".join(unescape(re.sub(r"<br>", " ", p)).replace("<b>", "").replace("</b>", "").split()) for p in PARAGRAPHS)]
EXPECTED[3] = "Others, who had seen nothing of it, wrote letters of some length to the editors of the three papers."
BODY = "<h1>A headline</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
LONG = "This advert goes on and on about a product that nobody needs but everybody is told to buy before the end of the week. " * 3
AROUND = [
    ("<nav><ul><li><a href=/a>Start</a><li><a href=/b>News</a></ul></nav>", ""),
    ("<header><h2>Site name</h2><p>Motto of the site</p></header>", ""),
    ("", f"<aside><p>{LONG}</p></aside>"),
    (f'<div class="cookie-notice"><p>{LONG}</p></div>', ""),
    ("", f'<section id="comments"><h3>3 comments</h3><article class="comment"><p>{LONG}</p></article></section>'),
    ('<div class="ad-slot"><div><p>Buy</div>now</div>', f'<div id="sideBar"><p>{LONG}</p></div>'),
    ("<form action=/s><input name=q><label>Search</label><button>Go</button></form>", "<footer>&copy; 2024 Someone</footer>"),
    ("<script>var a = '<p>not text</p>' < 3;</script><style>p{}</style><noscript>Turn it on</noscript>", "<!-- <p>gone</p> -->"),
    (f'<div style="display: none">{LONG}</div>', f'<div role="complementary">{LONG}</div>'),
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div id="content">{}</div>', "{}", "<table><tr><td>{}</td></tr></table>", "<div class=has-sidebar><div>{}</div></div>"])
@pytest.mark.parametrize("before, after", AROUND)
def test_article_among_other_parts(wrap, before, after):
    page = f"<!DOCTYPE html><html><head><meta charset=utf-8><title>T</title></head><body>{before}{wrap.format(BODY)}{after}</body></html>"
    assert main_text(page).split("\n\n") == EXPECTED


def test_parts_inside_an_article():
    page = f"<body><article>{BODY}<div class='share'>Share it</div>{AROUND[4][1]}<form>Write <input></form></article></body>"
    assert main_text(page).split("\n\n") == EXPECTED
    assert main_text(f"<body><form>{AROUND[0][0]}<article>{BODY}</article><select><option>1<option>2</select></form>").split("\n\n") == EXPECTED
    assert main_text(f"<body><article><header><h1>A headline</h1></header>{BODY[19:]}</article>").split("\n\n") == EXPECTED


@pytest.mark.parametrize(
    "opening",
    ['<article class="post-7 post type-post category-social tag-ads comments-open">', '<div class="entry has-sidebar no-comments"><div>', '<div class="content-sidebar-wrap"><div class="post-header">', '<section class="article-body">'],
)
def test_names_that_tell_something_else(opening):
    page = f"<body class='search cookie'><div class=layout>{opening}{BODY}</div></div></article></section><div class='alert'>{LONG}</div>"
    assert main_text(page).split("\n\n") == EXPECTED
    code = "<article><pre>x = 1 <span class='hljs-comment'># one</span></pre><p>a <em class=notice>b</em> <span class=ads>c</span></article>"
    assert main_text(code) == "x = 1 # one\n\na b"


def test_menus_without_names():
    menu = "<div>" + "".join(f"<a href=/{i}>Entry {i}</a> " for i in range(12)) + "</div>"
    page = f"<html><body>{menu}<div><div>{BODY}</div></div>{menu}<div>Made by someone</div></body></html>"
    assert main_text(page).split("\n\n") == EXPECTED


def test_several_articles():
    teasers = "".join(f"<article><h2><a href=/{i}>Teaser {i}</a></h2></article>" for i in range(5))
    assert main_text(f"<main><article>{BODY}</article>{teasers}</main>").split("\n\n") == EXPECTED


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), (" \n ", ""), ("<html></html>", ""), ("plain words", "plain words"), ("a &lt; b &#x41; &eacute; &bogus;", "a < b A é &bogus;"),
        ("<article><p>One<p>Two <b>three", "One\n\nTwo three"), ("<article>Cut <a href='x", "Cut"), ("<article>Cut <!-- off", "Cut"),
        ("<article>x<![foo bar]>y<![CDATA[z]]></article>", "xy"), ("<nav>Only a menu</nav>", ""), ("<article><p>x</p><script>var a", "x"),
        ("<article><dl><dt>a<dd>b<dt>c</dl><table><tr><td>d<td>e<tr><td>f</table><ul><li>g<li>h</ul></article>", "a\n\nb\n\nc\n\nd\n\ne\n\nf\n\ng\n\nh"),
        ("<article><p>a</p></p></div><p>b</article>", "a\n\nb"), ("<article><span class=ad>x <span>y</span> z</span>w</article>", "w"),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_long_pages():
    words = "word " * 400_000
    assert main_text(f"<article><p>{words}</p></article>") == words.strip()
    assert main_text("x" * 10_000_000) == "x" * 10_000_000
    assert len(main_text("<article>" + "<p>a b" * 50_000).split("\n\n")) == 50_000
    assert main_text("<article>x " + "<a <" * 20_000) is not None
    assert main_text("<div>" * 100_000 + "deep" + "</div>" * 100_000 + "<p>" + "</b>" * 100_000 + "after") == "deep\n\nafter"
    assert main_text("<article>" + "<ul><li>" * 5_000 + "x" + "</em>" * 50_000) == "x"


def test_smoothing_and_clusters():
    assert smoothed([1.0] * 9) == pytest.approx([1.0] * 9)
    middle = smoothed([0.0] * 5 + [1.0] + [0.0] * 5)
    assert middle.index(max(middle)) == 5 and sum(middle) < 1.1
    assert content_flags([]) == []


def test_rows_and_columns(spark):
    rows = [(1, "u", f"<body>{BODY}", "x", 9), (1, "u", f"<body>{BODY}", "x", 9), (None, None, None, None, None), (2, "v", "", "y", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text string, N_CHARS int")
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "html", "text", "n_chars"]
    text = "\n\n".join(EXPECTED)
    assert sorted([(r.page_id, r.text, r.n_chars) for r in found.collect()], key=repr) == sorted([(1, text, len(text))] * 2 + [(2, "", 0), (None, "", 0)], key=repr)
    assert extract_text(pages.limit(0)).count() == 0


def test_given_pages(spark):
    """Their articles are marked, so a plain pattern finds them."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract_text(pages).collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b)
