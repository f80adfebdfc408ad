"""Main text of pages: blocks, gradients, unseen layouts and the query against the pages' own mark-up."""

import html
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest

from stocktrail.llm import html_text as ht
from stocktrail.llm.html_blocks import blocks
from stocktrail.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark, folder):
    return ht.train(spark.read.parquet(f"{folder}/pages.parquet"))


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert texts("<p>a&amp;b &lt;i&gt;  c\n d</p>tail") == ["a&b <i> c d", "tail"]
    assert texts('<p><b>one<br><p>two</b></p><script>var t="</p>x";</script><style>p{}</style><!-- <p>no</p> -->') == ["one", "two"]
    assert texts("<ul><li>a<li><a href='>'>b</a> c</ul><table><tr><td>d<td>e</table>") == ["a", "b c", "d", "e"]
    assert texts("<head><title>t</title></head><body>x") == ["x"]
    assert texts("a < b and c<d <p>x<unclosed") == ["a < b and c", "x"] or texts("a < b <p>x") == ["a < b", "x"]
    assert texts(None) == texts("") == texts("<p> &nbsp; </p>") == []
    assert texts("<head><title>t</title><meta charset=x><p>article text") == ["article text"]
    assert texts("<head><link rel=x><style>p{}</style>words<p>more") == ["words", "more"]
    assert [b.linked for b in blocks("<p>ab <a>cde</a></p>")] == [3]
    assert [b.path for b in blocks('<div class="Ad box"><p>x')] == [("<div>", "c:ad", "c:box", "<p>")]


@pytest.mark.parametrize("tag", ["span", "div", "b", "li", "p class=x"])
def test_unclosed_tags_take_linear_time(tag):
    began = time.perf_counter()
    found = blocks(f"<{tag}>" * 40_000 + "end" + "</i>" * 40_000)
    assert [b.text for b in found] == ["end"] and time.perf_counter() - began < 5
    assert len(blocks(f"<{tag}>x" * 5_000)) in (1, 5_000)


def test_long_pages_are_trained_on_to_their_end():
    found = list(range(1000))
    runs = ht.spread_runs(found)
    assert len(runs) == ht.PAGE_BLOCKS and runs[0] == 0 and runs[-1] == 999 and runs == sorted(set(runs))
    assert ht.spread_runs(found[:96]) == found[:96]


def test_gradients():
    rng = np.random.default_rng(0)
    m = ht.Labeller.fresh(width=5, hidden=3)
    m.weights = {k: v.astype(np.float64) + rng.normal(0, 0.1, v.shape) for k, v in m.weights.items()}
    x, mask = ht._padded([rng.normal(size=(n, 5)).astype(np.float32) for n in (4, 2, 6)])
    y = (rng.random(mask.shape) > 0.5).astype(np.float32)

    def loss():
        p = m._scores(x, m._states(x, mask)[1])
        return -(np.log(np.where(y > 0, p, 1 - p)) * mask).sum() / mask.sum()

    for name, grad in m.gradients(x, mask, y).items():
        for place in zip(*np.unravel_index(rng.integers(0, grad.size, 5), grad.shape), strict=True):
            old = m.weights[name][place]
            m.weights[name][place] = old + 1e-2
            up = loss()
            m.weights[name][place] = old - 1e-2
            down = loss()
            m.weights[name][place] = old
            assert abs((up - down) / 2e-2 - grad[place]) < 2e-3


def test_pages_of_any_length_score_alike():
    rng = np.random.default_rng(1)
    m = ht.Labeller.fresh()
    pages = [rng.random((n, ht.WIDTH), np.float32) for n in (3, 0, 200, 1, 50)]
    together = m.probabilities(pages)
    for page, got in zip(pages, together, strict=True):
        assert np.allclose(m.probabilities([page])[0], got, atol=1e-5) and len(got) == len(page)


def article_text(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", body)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0] == "<br>" else "", p)).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def test_query_against_the_article(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in pq.read_table(f"{folder}/pages.parquet").to_pylist()}
    rows = QUERIES["op4_html_text"](spark, folder).collect()
    assert len(rows) == len(pages)
    right = sum(r["text"] == article_text(pages[r["page_id"]]["html"]) for r in rows)
    assert right == len(rows)
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"] for r in rows)


def test_layouts_the_sample_does_not_have(spark, model):
    say = "The thing and the other were on it then, he said to them all. " * 3
    page = f"""<html><body><header><h2>Site</h2></header><div class="cookie-notice"><p>We use them all</p></div>
      <main><h1>Title of it</h1><p>{say}</p><div class="ad">Buy on it</div><p>{say}</p></main>
      <aside class="sidebar"><ul><li><a>One</a></li><li><a>Two</a></li></ul></aside>
      <div class="comments"><p>{say}</p><p>No it is not.</p></div><form><label>Mail</label><input></form>
      <footer>Of the site</footer></body></html>"""
    df = spark.createDataFrame([(page,)], "html string")
    got = ht.extract(df, "html", model).first()["text"].split("\n")
    assert got == ["Title of it", say.strip(), say.strip()]


def test_odd_rows(spark, model):
    df = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (3, "<p", "t"), (4, "<script>x", "t")], "page_id int, html string, text string")
    assert [r["text"] for r in ht.extract(df, "html", model).orderBy("page_id").collect()] == ["", "", "", ""]
    assert ht.extract(df.limit(0), "html", model).count() == 0
    long = spark.createDataFrame([("<article>" + "<p>word and more of it.</p>" * 5000 + "</article>",)], "html string")
    assert len(ht.extract(long, "html", model).first()["text"].split("\n")) == 5000
    ht.train(df.limit(0))
