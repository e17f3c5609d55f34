from __future__ import annotations

import html as entities
import re

from pyspark.sql import functions as F

from clvspark.llm import html_text, queries
from clvspark.llm.dom_blocks import blocks
from clvspark.llm.frames import table
from clvspark.llm.labelled_pages import labelled_pages

SF = "/root/testdata/sf0.01"


def _article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = [" ".join(entities.unescape(re.sub(r"</?b>", "", re.sub("<br>", " ", p))).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


def test_whole_table(spark):
    pages = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    for r in queries.op5_html_text(spark, SF).collect():
        assert r.text == _article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_layouts_not_trained_on():
    model = html_text.fit()
    pages = labelled_pages(80, seed=501)
    right = sum(p == q for b, y in pages for p, q in zip(model.decode(b), y, strict=True))
    assert right / sum(len(y) for _, y in pages) > 0.98


def test_broken_markup_and_edges(spark):
    rows = [(1, None), (2, ""), (3, "<article><p>One &amp two&nbsp;three<p>Four\n  <b>five</article><!-- open"),
            (4, "<script>never ends"), (5, "<div>" * 2000 + "deep"), (6, "a < b <c d='"), (7, "<article><p>" + "word " * 50_000 + "</p></article>")]
    df = spark.createDataFrame(rows + rows[2:3], "page_id long, html string").withColumn("url", F.lit("u")).withColumn("text", F.lit("clash"))
    got = [(r.page_id, r.text) for r in html_text.extract(df, html_text.fit()).collect()]
    assert got.count((3, "One & two three\nFour five")) == 2
    assert dict(got)[1] == dict(got)[2] == dict(got)[4] == "" and len(dict(got)[7]) == 249_999
    assert html_text.extract(df.limit(0), html_text.fit()).count() == 0
    assert blocks("<ul><li>a<li>b</ul>")[1].text == "b"


def _texts(page):
    return [b.text for b in blocks(page)]


def test_elements_without_end_lose_no_text():
    body = "<body><article><h1>Title</h1><p>One</p></article>"
    for tag in ("svg", "math", "iframe", "object", "template", "noscript", "select", "textarea", "script", "style"):
        assert _texts(f"<{tag} a='b' />{body}") == ["Title", "One"], tag
        if tag not in ("math", "object", "noscript"):  # these hold text
            assert _texts(f"<{tag}/>{body}<{tag}>x</{tag}>") == ["Title", "One"], tag
    for tag in ("svg", "math", "iframe", "object", "template", "noscript", "select", "textarea"):
        assert _texts(f"<{tag}>{body}") == ["Title", "One"], tag
    assert _texts(f"<svg>{body}<svg><text>x</text></svg>") == _texts(f"<template>{body}<template>x</template>") == ["Title", "One"]
    assert _texts("<p>a<svg><title>x</title><svg><text>y</text></svg></svg>b</p>") == ["a b"]
    assert _texts("<p>a<svg><foreignObject><p>x</p></foreignObject></svg>b</p><svg><p>c</p></svg>") == ["a b", "c"]
    assert _texts("<script src=x/>code</script>a<script>'</scripted>'</script >b") == ["a b"]
    assert _texts("<p>so <math><mi>x</mi></math> is</p>") == ["so x is"]


def test_head_without_end():
    for head in ("<head>", "<head></head>", "<head><title>T <b></title><meta charset=x>", "<head><title>T", "<head><script>s</script><style>t</style>\n"):
        for body in ("<body>", "<body class=c>", ""):
            for top in ("<article><header><h1>Title</h1></header>", "<article><h1>Title</h1>"):
                assert _texts(f"<html>{head}{body}{top}<p>One</p></article>") == ["Title", "One"], (head, body, top)
    assert _texts("<head><title>T</title>plain text<p>One") == ["plain text", "One"]
    assert _texts("<head><noscript>x</noscript><template><p>y</p></template></head><p>One") == ["One"]
