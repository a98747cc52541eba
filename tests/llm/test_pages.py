"""The block reader, the network's slopes, and extraction against independent expectations."""

import html
import re

import numpy as np
import pytest

from tidemark.llm import pages


def texts(page):
    return [t for _, t, _ in pages.read_blocks(page)]


@pytest.mark.parametrize("page, want", [
    ("", []),
    ("plain &amp; text", ["plain & text"]),
    ("<p>a<p>b<li>c", ["a", "b", "c"]),
    ("<p>one <b>two</b><i>three</i> four</p>tail", ["one twothree four", "tail"]),
    ("<p>a<br>b \n\t c&nbsp;d</p>", ["a b c d"]),
    ("<p><b>x<br><p>y</p>", ["x", "y"]),
    ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no", ["yes"]),
    ("<script>var t = '<p>no</p>';</script><style>p{}</style><p>yes", ["yes"]),
    ("<script>never closed <p>no", []),
    ("<a title='a > b' href=x>link</a> 1 < 2 &lt;3", ["link 1 < 2 <3"]),
    ("&amp &am &#233;&#x41; &copy; &zzz;", ["& &am éA © &zzz;"]),
    ("<div>a<div>b</div>c</div></div></p>d", ["a", "b", "c", "d"]),
    ("<TABLE><tr><td>1<td>2<tr><td>3</TABLE>", ["1", "2", "3"]),
    ("<p>&am<b>p;</b>", ["&amp;"]),
    ("<", ["<"]), ("<p", []), ("a<b", ["a"]),
    ("<article><p>a <svg class=icon/> b</p><p>c <svg class='x' /> d</article>", ["a b", "c d"]),
    ("<p>a<svg><title>no</title><path d=x /><text>one</text><text>two</text></svg>b</p><p>c", ["a one two b", "c"]),
    ("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be, <math alt=y /> so</p>d", ["let x=2 be, so", "d"]),
    ("<p>a <svg> b</p><p>c <math> d</p><p>e", ["a b", "c d", "e"]),
    ("<p>a</p><object data=x><p>instead</p></object><p>b", ["a", "instead", "b"]),
    ("<p>a</p><object data=x><p>b</p><noscript><p>c</p>", ["a", "b", "c"]),
    ("<p>a<xmp>1 <b> &lt; 2</xmp>b<xmp>open", ["a", "1 <b> &lt; 2", "b", "open"]),
    ("<template><p>no<template>no</template><p>no</template><p>a<template><p>b", ["a", "b"]),
    ("<svg><style/><script href=x /></svg><p>a</p><iframe src=x /><p>b</p><iframe>no", ["a", "b"]),
    ("<p>a</p><textarea>never closed <p>no", ["a"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_paths_and_links():
    found = pages.read_blocks('<body><nav class="Top-Menu"><a href=x>home</a></nav><article id=main><p>see <a>it</a> now</article>')
    assert found[0][0] == (("body", ()), ("nav", ("menu", "top")))
    assert found[0][1:] == ("home", 4) and found[1][1:] == ("see it now", 2)
    assert not pages.is_main(found[0][0]) and pages.is_main(found[1][0])


def test_slopes_match_differences():
    rng = np.random.default_rng(0)
    net = pages.Labeller(2)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = rng.normal(size=(3, 5, pages.PATH_CELLS + pages.WORD_CELLS + pages.MEASURES))
    lengths = np.array([5, 3, 1])
    mask, y = np.arange(5) < lengths[:, None], rng.random((3, 5)) > 0.5
    _, grads = net.slopes(x, mask, lengths, y)
    for name in net.w:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in net.w[name].shape)
            was = net.w[name][at]
            value = []
            for step in (1e-3, -1e-3):
                net.w[name][at] = was + step
                value.append(net.slopes(x, mask, lengths, y)[0])
            net.w[name][at] = was
            assert grads[name][at] == pytest.approx((value[0] - value[1]) / 2e-3, abs=2e-4)


def test_labels_do_not_depend_on_company():
    """Pages are labelled alike alone and among longer ones."""
    rng = np.random.default_rng(4)
    net = pages.Labeller(3)
    vectors = [rng.normal(size=(n, pages.PATH_CELLS + pages.WORD_CELLS + pages.MEASURES)).astype(np.float32) for n in (4, 0, 9, 1)]
    together = net.probabilities(vectors)
    for v, p in zip(vectors, together, strict=True):
        assert np.allclose(net.probabilities([v])[0], p, atol=1e-5)


def want(page):
    """The test tables' pages have one article of headings and paragraphs."""
    inner = re.search(r"(?s)<article>(.*)</article>", page).group(1)
    parts = re.split(r"</?(?:p|h1)>", re.sub("</?b>", "", inner).replace("<br>", " "))
    parts = [" ".join(html.unescape(x).split()) for x in parts]
    return "\n\n".join(x for x in parts if x)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def labeller(table):
    return pages.train(table)


def test_pages_of_the_table(table, labeller):
    got = {r.page_id: r for r in pages.main_texts(table, labeller).collect()}
    for r in table.collect():
        own = got[r.page_id]
        assert own.text == want(r.html) and own.n_chars == len(own.text) and own.url == r.url


def test_other_kinds_of_blocks(labeller):
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies.</div>
    <nav><ul><li><a href=a>Home</a></li></ul></nav><article><h1>Title here</h1><p>First words of it.</p>
    <div class="advert">Buy now.</div><p>Second words of it.</p><form><p>Your name</p></form></article>
    <aside><p>Most read today.</p></aside><section class="comments"><p>Nice article, thanks.</p></section>
    <footer>Copyright us</footer></body></html>"""
    found = pages.read_blocks(page)
    chance = labeller.probabilities([pages.block_vectors(found)])[0]
    assert [t for (_, t, _), p in zip(found, chance, strict=True) if p >= 0.5] == ["Title here", "First words of it.", "Second words of it."]


def test_drawings_and_formulas_cost_no_text(labeller):
    parts = ["Title here", "First words of it.", "Let x=2 be so.", "Said in another way.", "Last words of it."]
    page = f"""<html><head><title>T</title></head><body><nav><ul><li><a href=a>Home</a></li></ul></nav><article><h1>{parts[0]}</h1>
    <p>First <svg class=icon/> words of it.</p><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be so.</p>
    <object data=x><p>{parts[3]}</p></object><p>{parts[4]}</p></article><footer>Copyright us</footer></body></html>"""
    found = pages.read_blocks(page)
    chance = labeller.probabilities([pages.block_vectors(found)])[0]
    assert [t for (_, t, _), p in zip(found, chance, strict=True) if p >= 0.5] == parts


def test_defined_results(spark, labeller):
    long = "<article>" + "<p>one two three.</p>" * 4000 + "<p>" + "x" * 100_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>"), (3, "w", long), (3, "w", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "'t' as text", "2 as n_chars")
    got = sorted(pages.main_texts(df, labeller).collect(), key=lambda r: (r.page_id or 0, r.n_chars))
    assert [(r.page_id, r.url, r.text) for r in got[:3]] == [(None, "v", ""), (1, "u", ""), (2, None, "")]
    assert got[3] == got[4] and got[3].text == "\n\n".join(["one two three."] * 4000 + ["x" * 100_000])
    assert pages.main_texts(df.limit(0), pages.train(df.limit(0))).count() == 0
