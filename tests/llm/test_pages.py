"""Main text of pages: the reader of tags, tree matching against plain recursion, induced wrappers, whole results."""

from __future__ import annotations

import functools
import html
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlens.llm import html_tree, wrapper

SCHEMA = "page_id long, url string, html string, host string, text string, outline string"


def text_of(page):
    return wrapper.main_text(page, None, frozenset())


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain  words", "plain words"), ("<p>a<p>b<br>c</p> d", "a\nb c\nd"), ("<P>x <B>y</b>z</P>", "x yz"),
    ("<p>a &amp; b &lt;c&gt; &#233;&eacute; &am &bogus; x&nbsp;y</p>", "a & b <c> éé &am &bogus; x y"),
    ("<ul><li>a<li>b<p>c</ul><table><tr><td>1<td>2<tr><td>3</table>e", "a\nb\nc\n1\n2\n3\ne"),
    ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes<!-- <p>no --></p><!-- open <p>no", "yes"),
    ("<title>T</title><article><h1>T</h1>x</article><p>after", "T\nx"),
    ("<article><header><h2>T</h2><p>by line</p></header><p>x</p><footer>f</footer></article>", "T\nx"),
    ("<form><article><p>x</p><form>f<input></form></article></form>", "x"),
    ("<main><p>a</p><nav>n</nav><div class='side-bar sidebar-left'>s</div><div id=cookie-notice>c</div></main><p>out", "a"),
    ("<article><p>a</p><section class=comments><article class=comment>c</article></section></article><aside><article>r</article></aside>", "a"),
    ("<body class='has-sidebar'><div class='page with-ads'>t</div><div class='ad'>x</div><div role=navigation>n</div>", "t"),
    ("<div><a href=a>Home</a> <a href=b>News</a></div><p>see <a href=c>this</a></p>", "see this"),
    ("<p>1 < 2 and 3 > 2</p><p a='>'>q</p>", "1 < 2 and 3 > 2\nq"),
    ("<article><p>cut <b", "cut <b"), ("<nav><ul><li>x</nav><p>y</p>", "y"), ("<div><p>a</div><p>b</div>", "a\nb"),
])
def test_main_text_of_single_pages(page, want):
    assert text_of(page) == want


def test_deep_and_long_pages_end():
    assert text_of("<div>" * 50_000 + "deep" + "</div>" * 50_000 + "<p>after") == "deep\nafter"
    many = "".join(f"<div class='k{chr(97 + i % 26)}x'><p>t{i}</div>" for i in range(20_000))
    assert text_of(many) == "\n".join(f"t{i}" for i in range(20_000))
    outline = wrapper.outline_of(html_tree.read(many)[0])
    assert outline.count("\n") == 26 * 2 and set(wrapper.align(outline, outline)) == set(range(53))
    plain = "<div><i>a</i></div><section>b</section>" * 500
    assert wrapper.outline_of(html_tree.read(plain)[0]).count("\n") <= 2 * html_tree.SAME_SIBLINGS


def random_tree(rng, depth=0):
    lines = [f"{depth} {rng.choice('abc') if depth else ''}"]
    if depth < 3:
        for _ in range(rng.randint(0, 4)):
            lines += random_tree(rng, depth + 1)
    return lines


def plain_weight(a, b):
    """Simple tree matching by the textbook table."""
    la, ka = wrapper._tree(a)
    lb, kb = wrapper._tree(b)

    @functools.cache
    def w(i, j):
        if la[i] != lb[j]:
            return 0
        m = [[0] * (len(kb[j]) + 1) for _ in range(len(ka[i]) + 1)]
        for x, p in enumerate(ka[i], 1):
            for y, q in enumerate(kb[j], 1):
                m[x][y] = max(m[x][y - 1], m[x - 1][y], m[x - 1][y - 1] + w(p, q))
        return m[-1][-1] + 1
    return w(0, 0)


def test_matching_is_a_largest_simple_tree_matching():
    rng = random.Random(8)
    for _ in range(200):
        a, b = ("\n".join(random_tree(rng)) for _ in range(2))
        matched = wrapper.align(a, b)
        assert sum(m >= 0 for m in matched) == plain_weight(a, b)
        (la, ka), (lb, kb) = wrapper._tree(a), wrapper._tree(b)
        for j, kids in enumerate(kb):
            places = [matched[k] for k in kids if matched[k] >= 0]
            assert places == sorted(set(places)) and all(p in ka[matched[j]] for p in places)
        assert all(m < 0 or la[m] == lb[j] for j, m in enumerate(matched))


def page(i, words, notice="Our shop is closed on Sundays."):
    extra = f"<div>Advice of the day {i}</div>" if i % 3 == 0 else ""
    return (f"<html><body><div>Great Shop</div>{extra}<div><p>{words}</p><p>{notice}</p><p>end of {i}</p></div>"
            f"<div>All rights are kept by us</div></body></html>")


def test_constant_nodes_are_template_without_an_article(spark):
    rows = [(i, f"http://Shop.example/{i}", page(i, f"story number {i} is about {i * 7}"), "h", "t", "o") for i in range(12)]
    rows += [(100 + i, "http://shop.example/copy", rows[0][2], "h", "t", "o") for i in range(40)]  # copies count once
    rows += [(200 + i, f"http://few.example/{i}", page(i, f"only {i}"), "h", "t", "o") for i in range(2)]
    found = {r["page_id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    for i in range(12):
        advice = [f"Advice of the day {i}"] if i % 3 == 0 else []
        assert found[i].split("\n") == [*advice, f"story number {i} is about {i * 7}", f"end of {i}"]
    assert all(found[100 + i] == found[0] for i in range(40))
    assert found[200].split("\n")[0] == "Great Shop" and "closed on Sundays" in found[201]


def test_copies_of_an_article_are_no_template(spark):
    body = "<article><h1>One story</h1><p>told again and again</p></article>"
    rows = [(i, f"http://a.example/{i}", f"<nav>m{i}</nav>{body}<footer>Imprint</footer>", "h", "t", "o") for i in range(30)]
    found = wrapper.extract(spark.createDataFrame(rows, SCHEMA)).select("text").distinct().collect()
    assert [r[0] for r in found] == ["One story\ntold again and again"]


def test_edge_cases(spark):
    rows = [(1, None, None, "h", "t", "o"), (None, "no host", "", "h", "t", "o"), (2, "http:///x", " <p> ", "h", "t", "o"),
            (3, "https://x.example?q", "<p>a", "h", "t", "o"), (3, "https://x.example?q", "<p>a", "h", "t", "o"),
            (4, "https://x.example", "<p>" + "long " * 400_000, "h", "t", "o")]
    got = sorted((tuple(r) for r in wrapper.extract(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    want = [(1, None, "", 0), (None, "no host", "", 0), (2, "http:///x", "", 0), *[(3, "https://x.example?q", "a", 1)] * 2,
            (4, "https://x.example", ("long " * 400_000).strip(), 1_999_999)]
    assert got == sorted(want, key=repr)
    assert wrapper.extract(spark.createDataFrame([], SCHEMA)).columns == ["page_id", "url", "text", "n_chars"]
    assert wrapper.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_all_given_pages(spark):
    pages = spark.read.parquet(os.path.join("/root/testdata/sf0.01", "pages.parquet"))
    given = {r["page_id"]: r["html"] for r in pages.collect()}
    found = wrapper.extract(pages).withColumn("chars", F.length("text"))
    rows = found.collect()
    assert len(rows) == len(given)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", given[r["page_id"]], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == r["chars"]


def test_marks_are_worked_out_once_per_element(monkeypatch):
    """Not once per text and element around it, which is what cost most of the time beside reading."""
    asked = []
    monkeypatch.setattr(wrapper, "_is_article", lambda n, old=wrapper._is_article: asked.append(n) or old(n))
    _, blocks = html_tree.read("<div><section><article>" + "<p>some text</p>" * 50 + "</article></section></div>")
    assert [x for x in wrapper.marked(blocks)] == [(True, True)] * 50
    assert len(asked) == len(set(asked)) <= 54
