"""HTML extraction (op11): the reader of pages, the field, and what comes out."""

import html
import itertools
import re
from collections import Counter

import numpy as np
import pytest
from brute import SF_DIR
from real_pages import PAGES

from barograph.llm import crf, dom, extraction
from barograph.llm.labelled_pages import MARK, labelled_pages


def blocks(page):
    return [(b.tag, b.text) for b in dom.read(page, None, lambda *_: None)]


@pytest.mark.parametrize(
    ("page", "found"),
    [
        ("", []),
        ("plain  text\n", [("", "plain text")]),
        ("<p>a<p>b</p>c", [("p", "a"), ("p", "b"), ("", "c")]),
        ("<p>a <b>b<br>c</p><p>d</b> e", [("p", "a b c"), ("p", "d e")]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", [("li", "a"), ("li", "b"), ("li", "c"), ("li", "d")]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", [("td", "a"), ("td", "b"), ("td", "c")]),
        ("x<!-- <p>no</p> -->y<script>if (a<b) '</p>'</script>z<style>p{}</style>", [("", "xyz")]),
        ("<title>no</title><div>1 < 2 &amp;&lt; 3 &am; &nbsp; &#8364;</div>", [("div", "1 < 2 &< 3 &am; €")]),
        ('<div title="a > b" class=x>t</div><a href=\'>\'>u</a>', [("div", "t"), ("", "u")]),
        ("<svg><text>no</text></svg><template><p>no</p></template>yes", [("", "yes")]),
        ("a</i></div></p>b<div>c</span>d<hr>e", [("", "a"), ("", "b"), ("div", "cd"), ("div", "e")]),
        ("<p>cut <a href='x", [("p", "cut")]),
        ("<p>cut</", [("p", "cut")]),
        ("<p>a<!-- never ends <p>b", [("p", "a")]),
        ("<script>never ends <p>b", []),
        ("<p>a</P ><DIV>b</div\n><>c<?php echo ?>d", [("p", "a"), ("div", "b"), ("", "<>cd")]),
    ],
)
def test_blocks(page, found):
    assert blocks(page) == found


def test_reading_takes_time_in_proportion():
    page = "<div><span><b><p>" * 30_000 + "x" + "</i></section>" * 30_000 + "<li>" * 30_000
    assert blocks(page) == [("p", "x")]
    assert blocks("<a " * 100_000) == []


@pytest.fixture(scope="module")
def model():
    return extraction.train()


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        scores, kinds = rng.normal(size=n).tolist(), rng.integers(0, 3, n).tolist()
        links, ends = rng.normal(size=(3, 2, 2)).tolist(), rng.normal(size=(2, 2)).tolist()

        def value(labels):
            total = ends[0][labels[0]] + ends[1][labels[-1]] + sum(s for s, x in zip(scores, labels, strict=True) if x)
            return total + sum(links[k][a][b] for k, a, b in zip(kinds[1:], labels, labels[1:], strict=False))

        found = crf.viterbi(scores, kinds, links, ends)
        assert value(found) == pytest.approx(max(map(value, itertools.product((0, 1), repeat=n))))
    assert crf.viterbi([], [], [], []) == []


def test_fit_matches_the_counts_of_the_labels():
    """At the optimum of a field without decay, expected counts equal those of the labels."""
    rng = np.random.default_rng(4)
    chains = []
    for _ in range(40):
        n = int(rng.integers(1, 6))
        labels = [int(x) for x in rng.random(n) < 0.5]
        features = [[x if rng.random() < 0.8 else 1 - x, 2] for x in labels]
        chains.append(crf.Chain(features, [0, *rng.integers(0, 2, n - 1).tolist()], labels))
    model = crf.fit(chains, 3, 2, steps=1500, rate=0.05, decay=0.0)
    expected, seen = np.zeros(3), np.zeros(3)
    for c in chains:
        ways = []
        for labels in itertools.product((0, 1), repeat=len(c.labels)):
            total = model.ends[0][labels[0]] + model.ends[1][labels[-1]] + sum(model.weights[f] for own, x in zip(c.features, labels, strict=True) if x for f in own)
            total += sum(model.links[k][a][b] for k, a, b in zip(c.kinds[1:], labels, labels[1:], strict=False))
            ways.append((np.exp(total), labels))
        whole = sum(w for w, _ in ways)
        for own, k in zip(c.features, range(len(c.labels)), strict=True):
            for f in own:
                expected[f] += sum(w for w, labels in ways if labels[k]) / whole
                seen[f] += c.labels[k]
    assert np.abs(expected - seen).max() < 0.3


def test_held_out_pages(model):
    wrong = total = 0
    for page in labelled_pages(150, seed=77):
        read = dom.read(page, None, lambda *_: None)
        want = Counter(b.text.replace(MARK, "").strip() for b in read if MARK in b.text)
        found = Counter(extraction.main_blocks(page.replace(MARK, ""), model))
        wrong += sum(((want - found) + (found - want)).values())
        total += len(read)
    assert wrong < 0.02 * total


@pytest.mark.parametrize("number", range(len(PAGES)))
def test_pages_of_common_sites(model, number):
    page, article = PAGES[number]
    assert extraction.main_blocks(page, model) == article


def test_whole_table(spark):
    """Every page of the given table holds its main text in one article element."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    found = {r.page_id: r for r in extraction.op11_html_extraction(spark, SF_DIR).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inside)]
        want = "\n".join(x for x in parts if x)
        assert (found[r.page_id].text, found[r.page_id].n_chars, found[r.page_id].url) == (want, len(want), r.url)


def test_odd_pages(spark, model):
    long = "<article>" + "<p>One of very many sentences of a long page, word for word. 😀</p>" * 20_000 + "</article><footer>&copy; me</footer>"
    page, article = PAGES[0]
    rows = [(1, None, None), (2, "u", ""), (3, "u", " \n "), (4, "u", long), (5, "u", page), (5, "u", page), (None, "u", page), (6, "u", "<" * 1000)]
    schema = "page_id long, url string, html string"
    table = spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS text", "'y' AS n_chars", "html AS features")
    found = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in extraction.extract_text(table, model).collect()), key=str)
    text = "\n".join(article)
    assert found[0] == (0, "u", text, len(text))
    assert found[1:4] == [(1, None, "", 0), (2, "u", "", 0), (3, "u", "", 0)]
    assert found[4][3] == len(found[4][2]) and found[4][2].count("\n") == 19_999
    assert found[5:7] == [(5, "u", text, len(text))] * 2
    assert extraction.extract_text(table.filter("page_id < 0"), model).collect() == []
