import itertools
import random
import time

import pytest
from pyspark.sql import types as T

from casegrid.llm import html

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><header><a href=/>Site</a><p>The best site in the world, about many things.</p></header>
<nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav><div class="notice">We use cookies on this site, and by going on you agree.</div>
<form action=/s><p>Search here for things you like to read about.</p><input></form>%s<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked reading this, thank you so much for writing it up for all of us.</p></div></section>
<aside><p>Related things that you may want to read some day.</p></aside><footer>&copy; somebody &middot; all rights.</footer><script>var t="<p>no</p>";</script></body></html>"""
BODY = "<article><h1>A &amp; B</h1>\n<p>First   paragraph,\nwith <a href=x>a link</a> &#233; and more.<p>Unclosed <b>second<br>one.</p><!-- <p>no</p> --><ul><li>item one</li><li>item two</li></ul><div class='ad'>Buy this thing now, it is cheap.</div><p>Last.</article>"


@pytest.fixture(scope="module")
def weights():
    return html.trained()


def test_main_text(weights):
    want = "A & B\n\nFirst paragraph, with a link é and more.\n\nUnclosed second one.\n\nitem one\n\nitem two\n\nLast."
    assert html.main_text(PAGE % BODY, weights) == want
    assert html.main_text(PAGE % BODY.replace("article>", "main>"), weights) == want
    assert html.main_text(PAGE % BODY.replace("<article>", "<div class='post-content'>").replace("</article>", "</div>"), weights) == want


def test_held_out_skeletons(weights):
    import numpy as np

    right = [g == on for page in html.labelled_pages(150, 77) if page for (b, g), on in zip(page, html.minimum_cut(np.clip(np.array([html.features(b) for b, _ in page]) @ weights, -6, 6).tolist(), html.ties([b for b, _ in page])), strict=True)]
    assert np.mean(right) > 0.98


def test_cut_is_the_least():
    r = random.Random(3)
    for _ in range(150):
        n = r.randint(1, 8)
        costs = [r.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, r.uniform(0, 1.5)) for i in range(n) for j in range(i + 1, n) if r.random() < 0.6]
        energy = lambda x: sum(max(c, 0) if not on else max(-c, 0) for c, on in zip(costs, x, strict=True)) + sum(w for i, j, w in edges if x[i] != x[j])  # noqa: B023, E731
        best = min(map(energy, itertools.product([False, True], repeat=n)))
        assert abs(energy(html.minimum_cut(costs, edges)) - best) < 1e-6


def test_odd_pages(spark, weights):
    pages = [None, "", " ", "<", "<p", "plain words without any tag, but a sentence.", "</div></p>x", "<!-- never closed", "<script>x", "<p>" * 500 + "deep", '<a href="x>open quote <p>words', "<p>same</p>", "<p>same</p>", "&bogus;&#0;&amp;lt;", "<p>word &amp; word</p>" * 20_000]
    rows = spark.createDataFrame([(i, f"u{i}", x, "clash") for i, x in enumerate(pages)] + [(None, None, "<p>a</p>", None)], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html.extracted(rows, ["page_id", "url", "text"]).collect()}
    assert len(got) == len(pages) + 1
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert [got[i]["text"] for i in range(3)] == ["", "", ""]
    assert got[5]["text"] == pages[5] and got[11]["text"] == got[12]["text"]
    assert got[14]["text"].count("\n\n") == 19_999
    assert html.extracted(rows.limit(0), ["page_id"]).count() == 0
    assert [f.name for f in html.extracted(rows, ["page_id", "url", "text"]).schema] == ["page_id", "url", "text", "n_chars"]
    assert isinstance(html.extracted(rows, ["page_id"]).schema["n_chars"].dataType, T.LongType)


THREE = "<html><body><article><p>The first paragraph of this article says something of note.</p>%s<p>The second paragraph goes on with what the first one said.</p><p>The third one ends the article as it should.</p></article></body></html>"


@pytest.mark.parametrize("tag", ["<svg class='i'/>", "<svg>", "<svg><svg><text>no</text></svg><title>no</title></svg>", "<object-view>", "<title-card>", "<template-x>", "<select-menu>", "<svg-icon/>", "<script-note>", "<!-->", "<!--->", "<!-- a --!>", "<iframe src='x'/>", "<textarea>", "<title>", "<noscript>", "<canvas>", "<![CDATA[", "<style>p {}</style >", "<script>a('<p>no')</script\n>"])
def test_no_tag_takes_the_rest_of_the_page(weights, tag):
    assert html.main_text(THREE % tag, weights) == html.main_text(THREE % "", weights)


def test_text_of_formulas_and_objects_stays(weights):
    inside = "<p>We set <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here <svg><title>no</title></svg>in the <object data=a>fall-back</object> sentence.</p>"
    assert "We set x=2 here in the fall-back sentence." in html.main_text(THREE % inside, weights).split("\n\n")


def test_code_without_an_end_takes_the_rest(weights):
    assert html.main_text("<article><p>Words before the code of this page.</p><script>var x = '<p>no';", weights) == "Words before the code of this page."


def test_reduced_networks_have_the_flow_s_cut():
    """Chains with arcs that don't cross, too large to enumerate, against augmenting paths on the whole network."""
    r = random.Random(9)
    for _ in range(60):
        n = r.randint(2, 60)
        parent, parents = [], [0]
        for i in range(n):
            parents = parents[: r.randint(1, len(parents))] + ([i + 1] if r.random() < 0.4 else [])
            parent.append(parents[-1])
        costs = [r.uniform(-1, 1) for _ in range(n)]
        edges = html.ties([html.Block("x", 0, "p", 0, p, r.randint(0, 2)) for p in parent])
        near = [{} for _ in range(n)]
        for i, j, w in edges:
            near[i][j] = near[j][i] = near[i].get(j, 0.0) + w
        energy = lambda x: sum(max(c, 0) if not on else max(-c, 0) for c, on in zip(costs, x, strict=True)) + sum(w for i, j, w in edges if x[i] != x[j])  # noqa: B023, E731
        assert abs(energy(html.minimum_cut(costs, edges)) - energy(html._flow(costs, near))) < 1e-6


@pytest.mark.parametrize("scale", [1e-5, 0.1, 1.0])
def test_close_costs_and_deep_pages_take_no_longer(scale):
    r = random.Random(2)
    found = [html.Block("x", 0, "p", 0, r.choice([1, 1, 2]), 0) for _ in range(20_000)]
    begun = time.monotonic()
    html.minimum_cut([r.uniform(-scale, scale) for _ in found], html.ties(found))
    html.minimum_cut([scale * 1e-3] * 10_000 + [-scale * 1e-3] * 10_000, html.ties(found))
    assert len(html.blocks("<div>" * 20_000 + "x")) == 1
    assert time.monotonic() - begun < 5
