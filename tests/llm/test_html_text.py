"""Main text: a linear scan against all runs, markup cases, and whole pages."""

import random
import re
import time
from html import unescape

import pytest

from tidebar.llm.html_text import best_run, extract, main_text, weights_of
from tidebar.llm.queries import op9_html_extraction

SF = "/root/testdata/sf0.001"
LONG = "word " * 30
WEIGHTS = weights_of({("word", True): 900, ("word", False): 9, ("li", False): 50, ("a", False): 50, ("p", True): 20, ("nav", False): 9})


def test_best_run_is_the_best_of_all():
    rng = random.Random(1)
    for _ in range(200):
        x = [rng.randrange(-5, 6) for _ in range(rng.randrange(12))]
        a, b = best_run(x)
        top = max((sum(x[i:j]) for i in range(len(x) + 1) for j in range(i, len(x) + 1)), default=0)
        assert sum(x[a:b]) == max(top, 0)


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("just words", "just words"),
        ("<p>a<p>b &amp; c&nbsp;d\n e<br>f</p>", "a\n\nb & c d e f"),
        ("<p>un<b>broken</b> w<i>ord</i></p>", "unbroken word"),
        (f"<nav><ul><li><a>x y z</a></li></ul></nav><article><h1>T</h1><p>{LONG}</p></article><footer>f g</footer>", f"T\n\n{LONG.strip()}"),
        (f"<ul><li><a>m</a></li><li><a>n</a></li></ul><div><p>{LONG}</p></div>", LONG.strip()),
        (f"<p>{LONG}</p><div class='ad-slot'>buy</div><p>{LONG}</p>", f"{LONG.strip()}\n\n{LONG.strip()}"),
        (f"<div class='page with-sidebar'><p>{LONG}</p></div>", LONG.strip()),
        (f"<article><header class=post-header><h1>T</h1></header><p>{LONG}</p><section id=comments>c d</section></article>", f"T\n\n{LONG.strip()}"),
        (f"<script>var t='</p>{LONG}';</script><style>p{{}}</style><p>x</p><!-- {LONG} -->", "x"),
        ("<p>a < b and 1<2 &am &copy &#8364; &bogus;</p>", "a < b and 1<2 &am © € &bogus;"),
        ("<p>open <b>never closed", "open never closed"),
        ("<!-- never closed <p>x</p>", ""),
        ("<i title='>'>x</i>" + LONG, ("x" + LONG).strip()),
        ("<form>name</form><select><option>one</select>", ""),
    ],
)
def test_markup(html, text):
    assert main_text(html, WEIGHTS) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 3000 + LONG + "</div>" * 3000, WEIGHTS) == LONG.strip()
    assert len(main_text("<p>" + "w " * 500_000, WEIGHTS)) == 999_999


def test_whole_pages(spark):
    rows = op9_html_extraction(spark, SF).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        body = pages[r.page_id].html.split("<article>")[1].split("</article>")[0]
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        blocks = re.split(r"</?(?:h1|p)>", body.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
        blocks = [" ".join(unescape(b).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_pages_without_labels_nulls_and_extra_columns(spark):
    rows = [(1, "u", f"<p>{LONG}", "t", 3), (None, None, None, "t", 3), (1, "u", "", None, 3)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", LONG.strip(), 149), (None, None, "", 0), (1, "u", "", 0)], key=repr)
    assert extract(df.limit(0)).collect() == []


def test_formulas_stay():
    html = f"<article><p>{LONG}so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds {LONG}</p></article>"
    assert main_text(html, WEIGHTS) == f"{LONG}so x=2 holds {LONG.strip()}"


ODD = {
    "cut tags": "<a", "ordinary text": "a<b ", "declarations": "<!", "stray ends": "<b></i>", "open quotes": "<a href=\"x>y ",
    "cut values": "<a b='", "attributes": "<a b=\"c\" ", "comments": "<!--", "processing": "<?x ", "cut scripts": "<script ",
    "rules in bold": "<b><hr>", "cells": "<td><b>", "list items": "<li><i>", "equals": "<a =", "half quotes": "<a b=\"<a c='",
    "spaces": "<a b =           ", "ends": "</", "options": "<p><select><b><hr>", "classes": "<i class = ad ",
}


@pytest.mark.parametrize("piece", ODD.values(), ids=ODD.keys())
@pytest.mark.parametrize("tail", ["", ">", "\"'>"])
def test_odd_pages_take_linear_time(piece, tail):
    html = piece * (1_000_000 // len(piece)) + tail
    began = time.process_time()
    text = main_text(html, WEIGHTS)
    assert time.process_time() - began < 20
    assert not re.search(r"<[a-z/!?]", text)


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<p>{LONG}<a href=\"foo>link</a> {LONG}</p>", f"{LONG}link {LONG.strip()}"),
        ("<p>The <a href='foo>link</a> end, isn't it.</p>", "The t it."),  # the quote ends in isn't
        ("<p class=a\">x</p> <p>\"y\"</p>", "x\n\n\"y\""),
        ("<p>if a<b then c</p>", "if a then c"),
        (f"<p>{LONG}<a href=x title=\"y z\" <b>bold</b> {LONG}</p>", f"{LONG}bold {LONG.strip()}"),
        (f"<article><p>{LONG}</p><p class='social alert'>{LONG}</p><p>{LONG}</p></article>", "\n\n".join([LONG.strip()] * 3)),
        (f"<article><p>{LONG}</p><div class='share'>{LONG}</div><p hidden>{LONG}</p><p>{LONG}</p></article>", "\n\n".join([LONG.strip()] * 2)),
        (f"<p>{LONG}</p><p class='ad'>{LONG}</p>", LONG.strip()),
    ],
)
def test_broken_tags_and_marks(html, text):
    assert main_text(html, WEIGHTS) == text
