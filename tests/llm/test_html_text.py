from __future__ import annotations

import time

import pytest

from cellarium.llm import html_text
from cellarium.llm.html_text import main_text

LONG = "Here is a sentence of the article, with commas, and enough words to count as prose. " * 2
BODY = LONG.strip()

CASES = [
    (None, ""),
    ("", ""),
    ("plain words", "plain words"),
    ("<p>a\n  b&amp;&lt;c&#33;</p>", "a b&<c!"),
    (f"<html><head><title>T</title></head><body><nav><a href=x>menu</a></nav><article><h1>Head</h1><p>{LONG}</p>"
     "<p>Short end.</p></article><footer>foot</footer></body></html>", f"Head {BODY} Short end."),
    (f"<body><div class='sidebar'>side</div><div id=content><h2>H</h2><p>{LONG}<p>{LONG}</div>"
     f"<div class=comments><p>{LONG}</p></div>", f"H {BODY} {BODY}"),
    (f"<article><p><b>Bold start.<br><p>{LONG}</p><script>var t='</p>';</script><div class='ad'>buy</div>"
     "<form><p>mail</p></form><!-- <p>gone</p> --><style>p{}</style>", f"Bold start. {BODY}"),
    (f"<div class=cookie-notice><p>{LONG}</p></div><main><p>{LONG}</p><aside>x</aside><p hidden>y</p></main>", BODY),
    ("<article></article>", ""),
    ("<nav>only</nav>", ""),
    ("<p>one<p>two<div>three</div><ul><li>a<li>b</ul>", "one two three a b"),
    ("a < b and <3 <p>x > y</p>", "a < b and <3 x > y"),
]


@pytest.mark.parametrize("page, want", CASES)
def test_main_text(page, want):
    assert main_text(page) == want


def test_a_link_list_loses_to_prose():
    links = "".join(f"<p><a href=/{k}>{LONG}</a></p>" for k in range(8))
    page = f"<body><div>{links}</div><div><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert main_text(page) == f"{BODY} {BODY}"


def test_comments_are_no_part_of_the_article_they_stand_in():
    comment = f"<article class=comment><p>{', '.join(['yes'] * 90)}.</p></article>"
    page = f"<body><article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p>%s</article></body>"
    want = f"Head {BODY} {BODY}"
    assert main_text(page % (comment * 4)) == want
    assert main_text(page % f"<section><h2>3 Comments</h2>{comment.replace(' class=comment', '') * 3}</section>") == want
    assert main_text(page % f"<ol id='comments'><li><p>{LONG}</p></ol>") == want
    assert main_text(page % f"<div role=comment><p>{LONG}</p></div>") == want


@pytest.mark.parametrize("names", [
    "class='content no-sidebar'", "class='has-header page'", "class='with-comments'", "id=widget-area class='post related'",
])
def test_a_name_does_not_drop_what_holds_the_prose(names):
    page = f"<body><div class=menu>Home</div><div {names}>" + f"<p>{LONG}</p>" * 3 + "</div></body>"
    assert main_text(page) == f"{BODY} {BODY} {BODY}"


def test_sections_of_an_article_stay_and_notices_go():
    page = f"<article><h1>H</h1><p>{LONG}</p><section id=discussion><h2>Discussion</h2><p>{LONG}</p></section>%s</article>"
    assert main_text(page % "") == f"H {BODY} Discussion {BODY}"
    assert main_text(page % f"<div class=notice><p>{LONG}</p></div><div class=related><h3>More</h3><a href=x>y</a></div>") == (
        f"H {BODY} Discussion {BODY}"
    )


def test_siblings_with_prose_headings_and_loose_text_stay():
    short = "A single paragraph of prose that is a good deal longer than eighty characters, and stands apart."
    page = (
        f"<body><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><h2>Head</h2><p>{short}</p></div>"
        f"Loose text <b>in a row</b> that reads like prose. <a href=/>Home</a><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></body>"
    )
    assert main_text(page) == f"{BODY} {BODY} {BODY} Head {short} Loose text in a row that reads like prose. Home"


HOSTILE = {
    "open quotes": '<a "' * 250_000, "two quotes": "<a \"'>" * 150_000, "cdata": "<![CDATA[" * 100_000,
    "unmatched ends": "<div>" * 40_000 + "</span></b></section>" * 40_000, "nested quotes": "<blockquote>x y, " * 40_000,
    "fenced": "<b><div>" + "<i>" * 40_000 + "</b>" * 40_000, "headers": "<article>" + "<div><header>x" * 30_000,
    "lists": "<ul><li>" * 30_000, "bare": "< " * 400_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_grows_with_the_page(name):
    start = time.process_time()
    main_text(HOSTILE[name])
    assert time.process_time() - start < 10


def test_deep_and_long_pages_and_broken_markup():
    assert main_text("<div>" * 20_000 + "<p>deep</p>") == "deep"
    assert main_text("<p>" + "word " * 200_000 + "</p>").count("word") == 200_000
    for page in ("<", "<p", "</", "<!--", "<p class='x>y", "<script>", "&#xD800;&#99999999;", "<a <b> c", "\x00<p>\x00"):
        main_text(page)


def test_rows_of_a_table(spark):
    rows = [(1, "u", "<p>hello</p>", 3), (None, None, None, 4), (1, "u", "<p>hello</p>", 3)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = [tuple(r) for r in html_text.extract(pages).collect()]
    assert sorted(found, key=str) == [(1, "u", "hello", 5), (1, "u", "hello", 5), (None, None, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0
