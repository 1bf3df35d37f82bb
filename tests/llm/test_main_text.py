"""Main text by tree scoring: hand-made pages, odd input, time on damaged markup."""

import time

import pytest

from tripmart.llm import main_text

LONG = "A sentence of the article, with commas, and enough words to count as text."

CASES = {
    "plain": (f"<body><p>{LONG}</p><p>b</p></body>", f"{LONG}\nb"),
    "parts around": (
        f"<header><h1>Site</h1></header><div id='cookie-notice'>We use cookies, all of them, always.</div><nav>x</nav><div><div class=content>"
        f"<h1>Title</h1><p>{LONG}<p>Two <a href=x>link</a>&nbsp;&mdash; end.</div><div class='sidebar'><p>{LONG}</p></div>"
        f"<section id=comments><p>{LONG}{LONG}</p></section><form>{LONG}</form></div><footer>{LONG}</footer>",
        f"Title\n{LONG}\nTwo link — end."),
    "sections of an article": (
        f"<main><article><header><h1>T</h1></header><section><p>{LONG * 9}</p></section><section><p>short</p></section></article>"
        f"<div class=related><p>{LONG}</p></div></main>", f"T\n{LONG * 9}\nshort"),
    "siblings": (
        f"<div><h2>Head</h2><div><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p></div><ul><li><a href=a>go</a></ul><div><a href=b>{LONG}</a></div></div>",
        f"Head\n{LONG}\n{LONG}\n{LONG}"),
    "link lists score nothing": (f"<div>{''.join(f'<p><a href=x>{LONG}</a></p>' for _ in range(9))}</div><div><p>{LONG}</p></div>", LONG),
    "only links": ("<p><a href=x>one, two, three</a></p>", ""),
    "script and comment": (f'<script>var t="</p><p>x";</script><!-- <p>no</p> --><p>{LONG}</p><style>p{{}}</style>', LONG),
    "breaks": (f"<p>a<br>b<br><br>c<br/> <br>d {LONG}</p>", f"a b\nc\nd {LONG}"),
    "references": (f"<p>&lt;b&gt; &amp;amp; &#x41;&#66; &copy &nosuch; {LONG}</p>", f"<b> &amp; AB © &nosuch; {LONG}"),
    "unclosed": (f"<html><head><title>t<b></title><body><div><ul><li>one<li>two, {LONG}</ul><table><tr><td>a<td>b", f"one\ntwo, {LONG}\na\nb"),
    "open head": (f"<head><meta charset=x><p>{LONG}", LONG),
    "inline parts": (f"<p>{LONG} <b>bo</b>ld <span class='ad'>buy</span>end</p>", f"{LONG} bold end"),
    "hidden": (f"<p hidden>{LONG}</p><p style='display: none'>{LONG}</p><div aria-hidden=true>{LONG}</div><p>x, {LONG}</p>", f"x, {LONG}"),
    "body class": (f"<body class='has-sidebar menu'><p>{LONG}</p></body>", LONG),
    "header of an article": (f"<div class=header>{LONG}</div><article><div class=header>By me</div><p>{LONG}</p></article>", f"By me\n{LONG}"),
    "lone signs": (f"<p>1 < 2 & 3 > 2 <3 {LONG}</p>", f"1 < 2 & 3 > 2 <3 {LONG}"),
    "attribute with >": (f"<p title='a > b'>{LONG}</p>", LONG),
    "unfinished tag": (f"<p>{LONG}</p><p clas", LONG),
    "no text": ("<div></div>", ""), "empty": ("", ""), "blank": (" \n ", ""), "text only": (LONG, LONG),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_pages(name):
    page, want = CASES[name]
    assert main_text.main_text(page) == want


def test_odd_rows(spark):
    rows = [(1, "u", "<p>x, y</p>", 5), (1, "u", "<p>x, y</p>", 5), (None, None, None, None), (2, None, "", 1), (3, "v", "<p>" + "w, " * 400_000, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long").selectExpr("*", "text as id")
    got = sorted(map(tuple, main_text.extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "x, y"), (1, "u", "x, y"), (None, None, ""), (2, None, ""), (3, "v", ("w, " * 400_000).strip())], key=repr)
    assert main_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "x, y", "<a " * 100_000, '<a x="' * 100_000, "<script>" * 100_000, "<!--" * 100_000, "<svg>" * 100_000,
    "<b>" * 50_000 + "</b><p>" * 50_000, "<p><a>x" * 50_000, "<" * 200_000, "<div><b>" * 30_000 + "</i>" * 30_000, "</p>" * 100_000])
def test_time_is_linear(page):
    start = time.perf_counter()
    main_text.main_text(page)
    assert time.perf_counter() - start < 20
