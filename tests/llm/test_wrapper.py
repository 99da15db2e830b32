from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from galegrid.llm import wrapper as W

SCHEMA = "page_id bigint, url string, html string, text string"


def page(i, body=None, extra=""):
    paragraphs = body or "".join(f"<p>Para {i}.{k} with <b>bold</b>ness &amp; more</p>" for k in range(i % 4 + 1))
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>"
        f"<header class='site-header'><h2>Site</h2></header><nav><ul>{'<li><a href=/x>Menu</a></li>' * (i % 3 + 1)}</ul></nav>"
        f"<div class=\"ad banner-{i}\">Buy {i}</div><div class='cookie-notice'>We use cookies</div>"
        f"<article><h1>Head {i}</h1>{paragraphs}{extra}</article>"
        f"<aside>Aside {i}</aside><div id='comments'><article class='comment'><p>Reader {i}</p></article></div>"
        f"<form><p>Sign up</p><input name=q></form><footer><p>Foot</p></footer></body></html>"
    )


def expected(i):
    return " ".join([f"Head {i}", *[f"Para {i}.{k} with boldness & more" for k in range(i % 4 + 1)]])


@pytest.fixture(scope="module")
def read(spark):
    rows = [(i, f"http://a{i % 3}.example.com/p/{i}", page(i), "old") for i in range(40)]
    return {r.page_id: r.text for r in W.main_text(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()}


def test_article_without_the_rest(read):
    assert read == {i: expected(i) for i in range(40)}


def one(spark, html, n=1):
    rows = [(k, "http://h.example/x", html, None) for k in range(n)]
    (found,) = {r.text for r in W.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    return found


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("just text &lt;b&gt; &#233; &copy", "just text <b> é ©"),
        ("<p>open<p>again<br>line", "open again line"),
        ("<article><p>cut</p><p>off", "cut off"),
        ("<main><p>a  b\n c</p></main><p>out</p>", "a b c"),
        ("<div class='post-content'><p>in</p></div><div class='sidebar'>side</div>", "in"),
        ("<article><p>x</p><script>bad()</p></script><p>y</p></article>", "x y"),
        ("<article><p>x</p><!-- <p>no</p> --><p>y</p><noscript>js</noscript></article>", "x y"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
        ("<article><ul><li>one<li>two</ul><p>in<i>line</i> 1 < 2</p></article>", "one two inline 1 < 2"),
        ("<ARTICLE><P CLASS=x>UP</P></ARTICLE>", "UP"),
        ("<article><p title='a > b'>q</p><div class='share'>Share me</div></article>", "q"),
        ("<article><p>t</p></article><script>never closed <p>x", "t"),
        ("</p></div><article>bare</article>", "bare"),
        ("<article><p>one</p><button>go<p>two three</p></article>", "one go two three"),
        ("<article><p>a</p><svg><g><p>x</p></svg><p>b</p><svg/><p>c</p><SELECT><option>o</SELECT ><video><p>d</p></article>", "a b c d"),
        ("<article><p>a</p><noscript><p>no</p></noscript><p>b</p><script>x<p>y</p></article>", "a b"),
    ],
)
def test_pages(spark, html, text):
    assert one(spark, html) == text


def test_same_on_many_copies(spark):
    """Pages that are all alike keep their article."""
    assert one(spark, page(3), n=20) == expected(3)


def test_long_and_deep_pages(spark):
    deep = "<div>" * 20_000 + "<p>deep</p>" + "</div>" * 20_000
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    assert one(spark, deep) == "deep"
    assert one(spark, long) == " ".join(["word"] * 50_000)


def test_template_texts_in_the_article_go(spark):
    rows = [(i, "http://t.example/x", page(i, extra="<div><div>Follow us</div></div>"), None) for i in range(30)]
    found = {r.page_id: r.text for r in W.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: expected(i) for i in range(30)}


def test_edges(spark):
    rows = [(1, None, page(1), None), (1, None, page(1), None), (None, "no scheme", page(2), None), (4, "http://é.İ.x/", None, None)]
    out = W.main_text(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["page_id", "url", "html", "text"]
    assert sorted((r.text for r in out.collect())) == sorted([expected(1), expected(1), expected(2), ""])
    assert W.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_alignment_resolves_mismatches():
    learned = W.parse("<div><h1>a</h1><p>x</p><p>y</p></div>")[0]
    W.align(learned, W.parse("<div><p>z</p><ul><li>1<li>2</ul></div>")[0], learn=True)
    W.align(learned, W.parse("<div><h1>b</h1><p>z</p><ul><li>1</ul><p>w</p></div>")[0], learn=True)
    assert W.expression(learned) == "<div>(<h1>#</h1>)?(<p>#</p>)+(<ul>(<li>#</li>)+</ul>)*</div>"
    assert W.expression(W.unflat(W.flat(learned))) == W.expression(learned)


def test_one_wrapper_for_each_host(spark):
    rows = [(i, f"http://a{i % 3}.example.com/p/{i}", page(i), None) for i in range(40)]
    made = W.wrappers(spark.createDataFrame(rows, SCHEMA).repartition(9))
    found = {r.host: W.expression(W.unflat(r.wrapper)) for r in made.collect()}
    assert set(found) == {f"a{k}.example.com" for k in range(3)}
    assert all("(<p>#</p>)+" in e for e in found.values())
    assert made.where(F.col("host") == "a0.example.com").count() == 1


def test_templates_mixed_on_a_host(spark):
    bodies = [
        "<article><h1>Head {0}</h1><p>Long article text number {0} that goes on</p></article>",
        "<main><h1>Head {0}</h1><p>Text of main {0}</p></main>",
        "<div class='content'><h1>Head {0}</h1><p>Text of content {0}</p></div>",
        "<div><h1>Head {0}</h1><p>Plain text {0}</p></div>",
    ]
    texts = ["Long article text number {0} that goes on", "Text of main {0}", "Text of content {0}", "Plain text {0}"]
    for url in ("http://m.example/x", None):
        rows = [(i, url, f"<body><nav>Menu</nav>{bodies[i % 4].format(i)}<footer>Foot</footer></body>", None) for i in range(40)]
        found = {r.page_id: r.text for r in W.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
        assert found == {i: f"Head {i} {texts[i % 4].format(i)}" for i in range(40)}


@pytest.mark.parametrize("copies", [7, 8, 30])
def test_copies_of_a_page_keep_what_only_they_have(spark, copies):
    own = "<dl><dt>Term</dt><dd>Meaning</dd></dl><figure><figcaption>Caption</figcaption></figure><div>Own block</div>"
    rows = [(i, "http://c.example/x", page(i), None) for i in range(20)]
    rows += [(100 + k, "http://c.example/y", page(50, extra=own), None) for k in range(copies)]
    found = {r.page_id: r.text for r in W.main_text(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert all(found[i] == expected(i) for i in range(20))
    assert {found[100 + k] for k in range(copies)} == {f"{expected(50)} Term Meaning Caption Own block"}


def test_columns_with_the_names_of_helpers_stay(spark):
    df = spark.createDataFrame([("https://a.b/c", "<article><p>one</p></article>", "mine", 5)], "url string, html string, _host string, _WRAPPER int")
    row = W.main_text(df).first().asDict()
    assert row["text"] == "one" and row["_host"] == "mine" and row["_WRAPPER"] == 5
