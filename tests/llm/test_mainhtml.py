import html
import itertools
import math
import random
import re

import numpy as np
import pytest

from loadstar.llm import mainhtml as mh
from loadstar.llm.htmlblocks import blocks

SCHEMA = ("page_id bigint, url string, html string, text string, "
          "__html string, n_chars int")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.fixture(scope="module")
def model(spark):
    from conftest import SF001
    return mh.train(spark.read.parquet(f"{SF001}/pages.parquet"))


def plain(page):
    """Main text of the given tables' pages by their one template."""
    art = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    parts = re.split(r"</?(?:p|h1)>", art.replace("<br>", " "))
    lines = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split())
             for p in parts)
    return "\n".join(x for x in lines if x)


def test_blocks():
    assert texts("<p>a<p>b <b>c</b>d<br>e</p>f") == ["a", "b cd e", "f"]
    assert texts("x &lt;y&gt; &amp;amp; &eacute;&nbsp;&#8364;\n\t z") == [
        "x <y> &amp; é € z"]
    assert texts('<script>var t="</p>";</script><style>p{}</style>'
                 "<!-- <p>no</p> --><title>no</title><p>yes") == ["yes"]
    assert texts("<p hidden>a</p><div style='display: none'><p>b</p></div>"
                 "<p aria-hidden=true>c</p>d") == ["d"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == list("abcd")
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == list("abc")
    assert texts("1 < 2 and <3") == ["1 < 2 and <3"]
    assert texts("<p>a</p></div></p>b<p") == ["a", "b"]
    assert texts("<script>never closed <p>a") == []
    assert texts('<a href="x>1</a><p>a</p>') == ["1", "a"]
    assert texts(None) == texts("") == texts("<p> \n </p>") == []
    b = blocks('<div class="Side-Bar navMenu" id=x1><p><a>ab</a>cd')[0]
    assert b.path == (("div", ("side", "bar", "nav", "menu", "x")), ("p", ()))
    assert b.linked == 2


def test_long_and_deep_pages():
    assert len(texts("<div>" * 50_000 + "a" + "<p>b" * 50_000)) == 50_001
    assert len(texts('<a "' * 50_000)) <= 1
    assert texts("<!--" * 100_000) == []
    assert len(texts("</p>" * 100_000 + "x" * 1_000_000)[0]) == 1_000_000


def _score(model, page, labels):
    s = model.start[labels[0]] + model.end[labels[-1]]
    for k, (b, y) in enumerate(zip(page, labels)):
        if y:
            s += sum(model.weights.get(f, 0.0) for f in mh.features(b))
        if k:
            same = mh._box(b) == mh._box(page[k - 1])
            s += model.steps[same][2 * labels[k - 1] + y]
    return s


def test_decoding_finds_the_best_sequence(model):
    page = blocks("<nav><a>a b</a></nav><div><h1>T</h1><p>Some text, of a "
                  "few words.</p></div><div class=post><p>More.</p></div>"
                  "<div class=ad>Buy.</div><footer>© x</footer>")
    best = max(itertools.product((0, 1), repeat=len(page)),
               key=lambda y: _score(model, page, y))
    assert mh.decode(page, model) == list(best)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    main = rng.normal(size=(4, 2)) * 3
    mask = np.array([[1, 1], [1, 1], [1, 1], [1, 0]], dtype=bool)
    same = rng.integers(0, 2, (4, 2))
    start, end = rng.normal(size=2), rng.normal(size=2)
    steps = rng.normal(size=(2, 2, 2))
    one, two = mh._marginals(main, start, end, steps, same, mask)
    for i, n in ((0, 4), (1, 3)):
        total, ones = 0.0, np.zeros((n, 2))
        pairs = np.zeros((n - 1, 2, 2))
        for y in itertools.product((0, 1), repeat=n):
            s = start[y[0]] + end[y[-1]] + sum(
                main[t, i] for t in range(n) if y[t]) + sum(
                steps[same[t, i], y[t - 1], y[t]] for t in range(1, n))
            w = math.exp(s)
            total += w
            for t in range(n):
                ones[t, y[t]] += w
                if t:
                    pairs[t - 1, y[t - 1], y[t]] += w
        assert np.allclose(one[:n, i], ones / total)
        assert np.allclose(two[:n - 1, i], pairs / total)
        assert not one[n:, i].any() and not two[n - 1:, i].any()


def test_all_given_pages(spark):
    import __spark_entry__ as entry
    from conftest import SF01
    rows = {r["page_id"]: r for r in
            spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    got = entry.queries()["op13_html_extraction"](spark, SF01).collect()
    assert len(got) == len(rows)
    for r in got:
        page = rows[r["page_id"]]
        assert r["text"] == plain(page["html"]) and r["url"] == page["url"]
        assert r["n_chars"] == len(r["text"])


def test_unseen_layouts(model):
    from conftest import SF01
    import duckdb
    pages = duckdb.sql(f"SELECT html FROM '{SF01}/pages.parquet' "
                       "WHERE page_id >= 50 ORDER BY page_id").fetchall()
    rng = random.Random(77)
    right = total = whole = 0
    for (page,) in pages:
        known = blocks(page)
        main = [b.text for b, y in zip(known, mh.own_labels(known)) if y]
        rest = [b.text for b, y in zip(known, mh.own_labels(known)) if not y]
        made, want = mh.dressed(rng, main, rest)
        got = mh.decode(blocks(made), model)
        right += sum(a == b for a, b in zip(got, want))
        total += len(want)
        whole += got == want
    assert right / total >= 0.98 and whole / len(pages) >= 0.85


def test_plain_divisions(model):
    page = """<html><body><div id="page"><div class="site-header">My Site</div>
<ul class="menu"><li><a href=/>Home</a></li><li><a href=/>News</a></li></ul>
<div class="cookie-notice">We use cookies, accept them.</div>
<div class="post"><h2>A title of it</h2><p>It was the best of times, it was
the worst of times, and all went home early.</p><div class=ad>Buy this great
thing now, it is cheap.</div><p>Short one.</p><form><label>Name</label></form>
<p>Another paragraph follows here, with more words in it, as usual.</p></div>
<div class="sidebar"><h3>Related</h3><p>An older story about people who went
home at night, and more.</p></div><div class="comments"><h3>2 comments</h3>
<p>I think this is a very good article, thank you for writing it.</p></div>
<div id="footer"><p>(c) 2020 Some company, all rights reserved.</p></div>"""
    assert mh.main_text(page, model).split("\n") == [
        "A title of it", "It was the best of times, it was the worst of "
        "times, and all went home early.", "Short one.",
        "Another paragraph follows here, with more words in it, as usual."]


def test_odd_rows(spark, model):
    page = "<nav>a</nav><article><h1>Title</h1><p>Some text here.</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p> </p>"),
            (4, "u", page), (4, "u", page), (5, "u", "<script>x")]
    got = sorted(map(tuple, mh.extract(frame(spark, rows).repartition(3), model)
                     .collect()), key=str)
    text = "Title\nSome text here."
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "u", "", 0),
                          (4, "u", text, 21), (4, "u", text, 21),
                          (5, "u", "", 0)], key=str)
    assert mh.extract(frame(spark, []), model).collect() == []


def test_no_labelled_pages(spark):
    model = mh.train(frame(spark, [(1, "u", None), (2, "u", "<p>a</p>")]))
    assert mh.main_text("<nav><a>x</a></nav><article><p>A longer sentence, "
                        "with words.</p></article>", model) == (
        "A longer sentence, with words.")
