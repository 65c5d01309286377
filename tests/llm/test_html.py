from __future__ import annotations

import html as library
import re
import time

import pytest

from claimlens.llm.html_extract import extract_pages, main_text
from claimlens.llm.queries import op5_html_text

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script>
<body><header><h1>Site</h1></header><div id="cookie-notice"><p>We, use, cookies</p></div><div class="menu">a, b, c</div>
<nav><ul><li><a href="/x">x</a></ul></nav><div class=content><h2>Title &eacute;</h2>
<p>Long text, with, commas <a href=x>link</a> &amp; <b>more   
text<p>second &lt;i&gt;<br>line<ul><li>one<li>two</ul><!-- no --><div class="share-box">share</div><form>f</form>
<table><tr><td>c1<td>c2</table></div><aside>side, bar</aside><div class="comments"><p>a long, long, reader comment, really</p></div>
<footer>&copy; f</footer>"""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (FULL, "Title é\nLong text, with, commas link & more text\nsecond <i> line\none\ntwo\nc1\nc2"),
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("a < b && c &amp d &#233;&#x41;", "a < b && c & d éA"),
        ("<p>x", "x"),
        ('<div "unclosed', ""),
        ('<p class="a>b">q</p>', "q"),
        ("<nav>a</nav>", ""),
        ("<!-- x", ""),
        ("<script>x", ""),
        ("<article><h1>H</h1></article><div>other words, many, of, them</div>", "H"),
        ('<div class="page no-sidebar"><p>x</p><p hidden>y</p><div style="display: none">z</div></div>', "x"),
        ('<p data-hidden="1">x</p><div class="hidden-gem with-comments"><p>y</p></div>', "x"),
        ("<P>A&nbsp;b\n\n c</P><DIV>d</DIV>", "A b c\nd"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_a_link_list_is_not_the_article():
    links = "".join(f'<p><a href="/{i}">a link, with, commas and length {i}</a></p>' for i in range(40))
    body = "<p>Real prose, with words, goes here.</p>" * 5
    assert main_text(f"<div>{links}</div><div>{body}</div>") == "\n".join(["Real prose, with words, goes here."] * 5)


def test_sibling_paragraphs_are_kept():
    long = "A long paragraph that stands beside the best container, with hardly any link in it at all."
    inner = "<p>Text, with, commas, for, points.</p>" * 9
    assert main_text(f"<body><p>{long}</p><section>{inner}</section><p>short</p></body>").startswith(long)


@pytest.mark.parametrize("tag", ["article", "main", "main><article"])
@pytest.mark.parametrize("paragraphs", [2, 20, 200])
def test_all_of_an_article_is_kept_whatever_its_size(tag, paragraphs):
    long = "A long paragraph, with commas, and more of them, that goes on for quite a while. " * 4
    big = f"<section><h2>One</h2>{f'<p>{long}</p>' * paragraphs}</section>"
    small = "<section><h2>Two</h2><p>Short one.</p><div><div><ul><li>a<li>b</ul></div></div><blockquote>said</blockquote></section>"
    page = f"<body><nav>n</nav><{tag}><h1>H</h1><p>Lead.</p>{big}{small}<aside>x</aside><p>End.</p></article></main><div>d</div></body>"
    want = ["H", "Lead.", "One", *[long.strip()] * paragraphs, "Two", "Short one.", "a", "b", "said", "End."]
    assert main_text(page).split("\n") == want


def test_a_very_long_page_is_read_whole():
    text = main_text("<article>" + "<p>Some words, again.</p>" * 100_000 + "</article>")
    assert text.count("\n") == 99_999


def test_generated_pages(spark, small_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    rows = op5_html_text(spark, small_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S)[1]
        blocks = [library.unescape(re.sub("<[^>]*>", "", b)).split() for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(" ".join(b) for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_edges(spark):
    schema = "page_id bigint, url string, html string, text int, n_chars string"
    rows = [(1, None, None, 1, "x"), (None, "u", "", 2, "y"), (2, "u", "<p>é", 3, "z"), (2, "u", "<p>é", 3, "z")]
    got = extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, None, "", 0), (None, "u", "", 0), (2, "u", "é", 1), (2, "u", "é", 1)], key=str)
    assert extract_pages(spark.createDataFrame([], schema)).collect() == []


WORDS = "A paragraph of the article, with commas, and with enough words to be taken for one."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><p title="the hidden valley">x</p></article>', "x"),
        ('<article><p class="share-price">x</p><div class="related-work ad-hoc"><p>y</p></div></article>', "x\ny"),
        ('<article><div class="share-box">s</div><ul class="related-links"><li>r</ul><p class="ad">a</p><p>x</p></article>', "x"),
        ("<article><header><h1>H</h1><p>by line</p><nav><h2>n</h2></nav></header><p>x</p></article>", "H\nx"),
        (f"<body><div><h1>H</h1><div>{f'<p>{WORDS}</p>' * 9}</div><section><p>short</p></section></div></body>", "\n".join(["H", *[WORDS] * 9, "short"])),
        (
            f'<main><article>{f"<p>{WORDS}</p>" * 3}</article><div class="recommended"><p><a href=x>Other, one</a></p><p><a>Other two</a></p></div></main>',
            "\n".join([WORDS] * 3),
        ),
        ('<body><div class="left-sidebar"><p>s, s, s</p></div><div class="text"><p>x</p></div></body>', "x"),
        ("<article><p>one</p></article><article><p>two</p></article><article><a>link</a></article>", "one\ntwo"),
        ("<body><section><p>a</p></section></section></article><p>b</p></body>", "a\nb"),
    ],
)
def test_what_belongs_to_the_article(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page",
    ["<div>some words" * 100_000, "<div>a, b" * 50_000 + "</p></section>" * 50_000, "<div hidden>x" * 100_000 + "</div>" * 100_000],
    ids=["open", "wrong ends", "hidden"],
)
def test_deep_nesting_takes_time_in_proportion(page):
    start = time.perf_counter()
    text = main_text(page)
    assert time.perf_counter() - start < 5
    assert text == ("" if "hidden" in page else "\n".join(b for b in re.split("<[^>]*>", page) if b))


def test_scoring_alone_finds_the_given_articles(spark, small_dir):
    for r in spark.read.parquet(f"{small_dir}/pages.parquet").select("html").collect():
        page = r["html"]
        assert main_text(re.sub(r"(</?)article\b", r"\1div", page)) == main_text(page)
