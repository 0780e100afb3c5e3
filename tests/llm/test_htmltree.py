"""HTML extraction: exact marginals, reading of broken pages, held-out layouts, the query."""

import html
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from charloom.llm import htmltree as T
from charloom.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


def test_marginals_by_enumeration():
    rng = np.random.default_rng(4)
    for _ in range(20):
        trees = []
        for _ in range(2):
            tree = T.Tree()
            for i in range(rng.integers(1, 7)):
                tree.add(int(rng.integers(0, i + 1)), rng.choice(["div", "p", "nav", "h1"]), (), rng.choice([None, "x"]))
            trees.append(tree)
        forest = T.Forest(trees, {})
        unary, pair = rng.normal(size=forest.n), rng.normal(size=(T.OTHER_KIND + 1, 2, 2))
        got, joint = T.marginals(forest, unary, pair)
        weight, state, both = 0.0, np.zeros(forest.n), np.zeros((forest.n, 2, 2))
        for y in itertools.product((0, 1), repeat=forest.n):
            score = sum(unary[i] * y[i] for i in range(forest.n))
            score += sum(pair[forest.kind[i], y[p], y[i]] for i, p in enumerate(forest.parent) if p >= 0)
            w = np.exp(score)
            weight += w
            state += w * np.array(y)
            for i, p in enumerate(forest.parent):
                if p >= 0:
                    both[i, y[p], y[i]] += w
        inner = forest.parent >= 0
        assert np.allclose(got, state / weight) and np.allclose(joint[inner], both[inner] / weight)


@pytest.mark.parametrize("source,blocks", [
    ("a<br>b  c", ["a b c"]),
    ("<p>one<p>two</p>three", ["one", "two", "three"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
    ("<p>x<b>y</b>z &amp; &#233;&lt;", ["xyz & é<"]),
    ("<script>var a='<p>no';</script><p>yes<style>p{}</style>", ["yes"]),
    ("<p title='a>b' data-x=\"c>d\">t</p><!-- <p>no</p> -->u", ["t", "u"]),
    ("a <!-- open <p>b", ["a"]), ("a<script>b", ["a"]), ("a<p class=\"x", ["a"]), ("1 < 2 <3", ["1 < 2 <3"]),
    ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
    ("<p>it's <i>fine</p><p don't>so</p>", ["it's fine", "so"]),
    ("<SCRIPT>x</ScRiPt ><P>A  \n\tB</P>", ["A B"]), ("", []), ("</p></div>", []), ("<title>no</title>", []),
])
def test_blocks(source, blocks):
    assert [x for x in T.read_page(source).text if x is not None] == blocks


def test_deep_and_long():
    deep = "<div>" * 3000 + "<p>end" + "</div>" * 3000
    assert [x for x in T.read_page(deep).text if x] == ["end"]
    long = "<article><p>" + "word and words. " * 50000
    assert T.main_texts([long, deep], T.default_model())[0] == ("word and words. " * 50000).strip()
    assert len(T.read_page("<p a=\"" * 20000).text) < 20002  # read in linear time


def test_held_out_layouts():
    pages, right, wrong = T.labelled_pages(300, 2024), 0, 0
    for page, got in zip(pages, T.main_texts(pages, T.default_model())):
        tree = T.read_page(page)
        want = [x for x, y in zip(tree.text, tree.label) if x is not None and y == 1]
        right += got == "\n".join(want)
        wrong += len(set(want) ^ set(got.split("\n")) - {""})
    assert right >= 0.93 * len(pages) and wrong < 60


SITE = """<!doctype html><html><head><title>T</title><meta name=x></head><body><header id="masthead"><a href="/">The Site</a></header>
<nav class="main-nav"><ul><li><a href="/a">Home</a><li><a href="/b">News and views</a></ul></nav>
<div class="cookie-notice">We use cookies to make the site work. <button>Accept</button></div>
<div class="wrap"><div id="content"><h1>On rivers</h1><p>Rivers carry water &amp; silt from the hills to the sea, slowly.</p>
<div class="advert">Buy now! Only today.</div><p>They bend as they go; <a href="/x">a bend</a> may be cut off.</p>
<ul><li>The Rhine<li>The Loire</ul><blockquote>All rivers run into the sea.</blockquote></div>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/c">On lakes and ponds</a></ul></aside>
<section class="comments"><h2>2 replies</h2><div class="comment"><p>I liked this a lot, thank you for it.</p></div>
<div class="comment"><p>The Rhine is longer than I thought it was.</p></div></section>
<form class="newsletter"><label>Your mail</label><input><button>Send</button></form></div>
<footer>&copy; 2020 The Site. All rights reserved.</footer></body></html>"""


def test_a_written_page():
    assert T.main_texts([SITE], T.default_model())[0] == "\n".join([
        "On rivers", "Rivers carry water & silt from the hills to the sea, slowly.",
        "They bend as they go; a bend may be cut off.", "The Rhine", "The Loire", "All rivers run into the sea."])


def test_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = LLM_QUERIES["op12_html_extraction"](spark, SF).collect()
    assert sorted(r["page_id"] for r in got) == sorted(pages)
    for r in got:
        inside = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inside))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, None, "no markup at all, but a sentence."), (3, "u", "<p>" * 40000 + "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own")).withColumn("n_chars", F.lit(1))
    got = T.extract_text(df).collect()
    assert len(got) == 5 and got[0].asDict() == {"page_id": 1, "url": "u", "text": "", "n_chars": 0}
    assert [r["n_chars"] for r in got if r["page_id"] is None] == [0]
    assert T.extract_text(df.limit(0)).count() == 0


def test_own_labelled_pages():
    rng = random.Random(1)
    writer = T._Writer(rng)
    pages = ["".join(f'<div class="{c}" data-label="{"content" if c == "odd" else "other"}">{writer.sentences(1, 3)}</div>'
                     for c in rng.choices(("odd", "even"), k=6)) for _ in range(40)]
    model = T.train(pages, T.ModelRules(steps=80))
    assert T.main_texts(['<div class=even>No.</div><div class="odd">Yes it is.</div>'], model) == ["Yes it is."]
