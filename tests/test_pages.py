"""Page helper and page pass."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.functions.page_tree import (
    Page,
    anchors,
    cleaned,
    content_html,
    content_text,
    listings,
    next_href,
)
from folioflow.operators import pages


def clean(html, wrap=False):
    return cleaned(Page(html), wrap)[0]


def words(html, wrap=True):
    return cleaned(Page(html), wrap)[1]


def test_chrome_goes_and_content_stays():
    page = "<header>Top</header><main id='m'>Ruling <nav><a href='/x'>On</a></nav>of <em>May</em></main><footer>End</footer>"
    assert clean(f"<body>{page}</body>") == '<main id="m">Ruling of <em>May</em></main>'
    assert clean("<body><style>p{}</style><main>R</main><noscript>no</noscript>") == "<main>R</main>"
    assert clean("<div class='wide content'><ul><li>One</ul></div>") == '<div class="wide content"><ul><li>One</li></ul></div>'


def attached(spark, html):
    rows = spark.createDataFrame([(html,)], "html string")
    return pages.extract_pages(rows, "html", ["anchors"], []).select(pages.attachment("anchors")).first()[0]


def test_nested_attachment_links_take_linear_time(spark):
    page = Page("<div class='content'>" + "<a href='/x'><div>" * 60_000 + "</div>")
    start = time.process_time()
    assert not any(a["says"] for a in anchors(page))
    assert time.process_time() - start < 5
    words = "<div class='content'><a href='/far'>x</a>" + "<a href='/n'><div>" * 1000 + "Full <b>Case</b>\n report"
    assert attached(spark, words) == "/n"


@pytest.mark.parametrize("html", ["", "<html><body></body></html>", "<", "&", "<!--", "<a", "</", "<a b='"])
def test_poor_pages_do_not_raise(html):
    for wrap in (True, False):
        cleaned(Page(html), wrap)
    page = Page(html)
    assert content_html(page) == "" and content_text(page) == ""
    assert anchors(page) == [] and listings(page) == [] and next_href(page) is None


def test_wrapped_page():
    assert clean("<p>x", True) == S.PAGE_OPEN + "<body><p>x</p></body>" + S.PAGE_CLOSE
    assert clean("<body class='b'>x</body>", True) == S.PAGE_OPEN + '<body class="b">x</body>' + S.PAGE_CLOSE


@pytest.mark.parametrize(
    "node",
    [
        '<article class="x case-detail y">N</article>',
        '<div class="case-content">N</div>',
        '<div id="main-content">N</div>',
        '<div class="a content">N</div>',
        "<main>N</main>",
    ],
)
def test_each_content_selector(node):
    html = f"<body><p>before</p>{node}<p>after</p></body>"
    assert clean(html) == node
    assert content_html(Page(html)) == node


def test_priority_beats_order():
    html = "<main>M</main><div class='content'>D</div><article class='case-detail'>A</article>"
    assert words(html) == "A"
    assert content_text(Page(html)) == "A"


def test_chrome_inside_content_and_content_inside_chrome():
    assert words("<main>a<nav>n</nav>b<header>h<p>i</p></header></main>") == "a b"
    assert words("<header><main>in</main></header><div class='content'>out</div>") == "out"
    assert content_text(Page("<main>a<script>s()</script></main>")) == "a s()"


def test_body_fallback_leaves_the_head_out():
    html = "<html><head><title>T</title></head><body>B<noscript>n</noscript></body></html>"
    assert words(html) == "B"
    assert words("<title>T</title><p>B") == "B"


def test_text_of_first_selector_with_any_text_node():
    html = "<article class='case-detail'></article><div class='content'> </div><main>M</main>"
    page = Page(html)
    assert content_html(page) == '<article class="case-detail"></article>'
    assert content_text(page) == ""
    assert content_text(Page("<div class='content'></div><main>M</main>")) == "M"


def test_nested_matches_count_once():
    assert content_text(Page("<div class='content'>a<div class='content'>b</div>c</div>")) == "a b c"


def test_implied_ends_and_strays():
    assert words("<p><b>a<br><p>b</p></i>c") == "a b c"
    assert words("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == "a b c d e"
    assert clean("<main><p>a<div>b</div></main>") == "<main><p>a</p><div>b</div></main>"
    assert clean("<main><b>a</div>b</b></main>") == "<main><b>ab</b></main>"


def test_raw_text_comments_and_references():
    assert words("<body><script>if (a<b) '</p>'</script>x &amp; &lt;y&gt; &#65;&#x42; &nope; &copy 1") == (
        "x & <y> AB &nope; &copy 1"
    )
    assert clean("<main>a<!-- c -->b</main>") == "<main>a<!-- c -->b</main>"
    assert clean("<main a=1 b='x\"y' A=2 checked>&amp;</main>") == (
        '<main a="1" b="x&quot;y" checked="">&amp;</main>'
    )


def test_deep_pages_are_no_problem():
    depth = 20_000
    assert words("<div>" * depth + "x" + "</div>" * depth) == "x"
    assert words("<b>" * depth + "x") == "x"
    assert words("<b>" * depth + "<hr></i>" * depth + "x") == "x"
    assert words("<a b='" * depth + "x") == ""


@pytest.mark.parametrize(
    "html, want",
    [
        ("<div class='content'><a href='b.doc'>x</a><a href='a.pdf'>y</a></div>", "a.pdf"),
        ("<div class='content'><a href='b.docx'>x</a><a href='a.doc'>y</a></div>", "a.doc"),
        ("<div class='content'><a href='b.docx'>x</a></div>", "b.docx"),
        ("<div class='related-items related-file'><a class='download' href='d'>x</a></div>", "d"),
        ("<div class='related-items'><a class='download' href='d'>x</a></div>", None),
        ("<div class='related-item-content'><a class='x download' href='e'>x</a></div>", "e"),
        ("<div class='my-content-x'><a href='f'>The FULL\n case <i>Report</i></a></div>", "f"),
        ("<div class='my-content-x'><a href='g.pdf?x'>x</a></div>", "g.pdf?x"),
        ("<div class='content'><a href='a.PDF'>x</a></div>", None),
        ("<a href='a.pdf'>x</a>", None),
        (
            "<div class='related-item-content'><a class='download' href=''>x</a></div>"
            "<div class='content'><a href='h'>full case report</a></div>",
            "h",
        ),
    ],
)
def test_attachment_rules(spark, html, want):
    assert attached(spark, html) == want


RESULTS = """
<ul>
<li class="each-item clearfix"><h2 class="title"><a href="/t1">One &amp; <b>two</b></a></h2>
<span class="date">1/2/2024</span><span class="refNO">ADJ-1</span><p class="description">D</p>
<a class="btn btn-primary" href="/b1">View</a></li>
<li class="clearfix other each-item"><h2 class="title"><a href="/t2">T2</a></h2></li>
<li class="each-item clearfix"><h2 class="title"><a href="/t3">T3</a></h2><a class="btn btn-primary" href="">V</a></li>
<li class="each-item clearfix"><h2 class="title">T4</h2></li>
<li class="each-item">not one</li>
</ul><a class="next" href="?page=2">Next</a><a class="next" href="?page=3">Next</a>
"""


def test_listings():
    found = listings(Page(RESULTS))
    assert [f["href"] for f in found] == ["/b1", "/t2", "", None]
    assert found[0] == {
        "position": 0, "identifier": "ADJ-1", "title": "One & ", "description": "D",
        "case_number": "ADJ-1", "record_date": "1/2/2024", "href": "/b1",
    }
    assert next_href(Page(RESULTS)) == "?page=2"


def test_listing_rows(spark):
    df = spark.createDataFrame([("u", RESULTS), ("v", "<p>"), ("w", None)], "url string, html string")
    rows = pages.listings(df, "html", ["url"], "Src").orderBy("position").collect()
    assert [(r.url, r.position, r.source_page_url, r.source) for r in rows] == [
        ("u", 0, "/b1", "Src"), ("u", 1, "/t2", "Src"),
    ]
    counts = {r.url: r.n_listings for r in pages.listings_per_page(df, "html", ["url"]).collect()}
    assert counts == {"u": 4, "v": 0, "w": 0}


def test_one_python_node_and_hash_outside(spark):
    df = spark.createDataFrame([(1, "<p>x")], "id long, html string")
    done = pages.clean_pages(df, "html", ["id"]).where(F.col("cleaned_text") != "")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    row = done.first()
    assert row.file_hash == hashlib.sha256(row.cleaned_html.encode()).hexdigest()


def test_a_bad_page_does_not_end_the_job(spark, monkeypatch):
    df = spark.createDataFrame([(1, "<p>x"), (2, None)], "id long, html string")
    rows = pages.extract_pages(df, "html", ["cleaned_text"], ["id"]).orderBy("id").collect()
    assert [(r.cleaned_text, r.error) for r in rows] == [("x", None), (None, None)]

    def broken(html, facts, wrap):
        raise ValueError("bad page")

    monkeypatch.setattr(pages, "_read_page", broken)
    run = {}
    source = df.select("id", "html")
    monkeypatch.setattr(type(source), "mapInArrow", lambda self, f, schema: run.setdefault("f", f))
    pages.extract_pages(df, "html", ["cleaned_text"], ["id"])
    out = list(run["f"](iter(source.toArrow().to_batches())))
    errors = [e for batch in out for e in batch.column("error").to_pylist()]
    assert errors == ["ValueError: bad page", None]


def routed(spark, *rows):
    df = spark.createDataFrame(
        [(u, t, None if b is None else bytearray(b)) for u, t, b in rows], S.CAPTURED_PAGES
    )
    return {r.url: r for r in pages.document_pages(df).collect()}


def test_declared_charsets(spark):
    body = "<main>caf\xe9 </main>".encode("latin-1").replace(b" ", b" \x80\x93\x81")
    western = "<main>caf\xe9 €“\x81</main>"
    names = ["windows-1252", '"ISO-8859-1"', " 'Latin1' ", "US-ASCII; x=y", "utf-8", "koi8-r"]
    rows = [(f"http://h/{i}", f"Text/HTML; a=b ; CharSet={n}", body) for i, n in enumerate(names)]
    got = routed(spark, *rows, ("http://h/a", "text/html", body), ("http://h/b", None, "<main>é€</main>".encode()), ("http://h/c", "text/html; charset=latin1", None))
    assert [got[f"http://h/{i}"].content_html for i in range(4)] == [western] * 4
    assert {got[f"http://h/{i}"].content_html for i in (4, 5, "a")} == {"<main>caf\ufffd \ufffd\ufffd\ufffd</main>"}
    assert got["http://h/b"].content_html == "<main>é€</main>" and got["http://h/c"].error is None
    assert {r.content_type for r in got.values()} == {"text/html"}


def test_document_pages(spark):
    long = "w " * 60
    got = routed(
        spark,
        ("http://h/a.pdf", "text/html", b"%PDF"),
        ("http://h/b", "application/pdf; x", b"%PDF"),
        ("http://h/c", "", f"<main>{long}</main>".encode()),
        ("http://h/d/", "text/html", b"<div class='content'><a href='../e.pdf'>x</a></div>"),
        ("http://h/f", "Text/HTML; charset=x", b"<main>short</main>"),
        ("http://h/g.doc", "", b""),
    )
    assert {u: r.route for u, r in got.items()} == {
        "http://h/a.pdf": "file", "http://h/b": "file", "http://h/c": "html",
        "http://h/d/": "follow", "http://h/f": "html_fallback", "http://h/g.doc": "file",
    }
    assert got["http://h/d/"].follow_url == "http://h/e.pdf"
    assert bytes(got["http://h/b"].content_bytes) == b"%PDF" and got["http://h/b"].content_html is None
    assert got["http://h/c"].content_type == "text/html" and got["http://h/c"].content_bytes is None
    assert got["http://h/g.doc"].content_type == "application/octet-stream"
    assert got["http://h/a.pdf"].content_type == "text/html"
    assert got["http://h/f"].content_html == "<main>short</main>"
    assert all(r.link_to_doc == u for u, r in got.items())


def test_text_gate_counts_code_points(spark):
    rows = [
        (f"http://h/{n}{c}", "text/html", f"<main>{c * n}</main>".encode())
        for n in (99, 100)
        for c in ("x", "é", "😀")
    ]
    got = routed(spark, *rows)
    assert {u: r.route for u, r in got.items()} == {
        u: "html" if "100" in u else "html_fallback" for u, _, _ in rows
    }


def test_links_of_results_pages(spark):
    based = '<head><base href="/en/"></head>' + RESULTS
    df = spark.createDataFrame(
        [("http://h/s?page=1", RESULTS), ("http://h/b", based), ("http://h/last", "<p>")], "url string, html string"
    )
    edges = {r.src: r.dst for r in pages.next_pages(df, "html", "url").collect()}
    assert edges == {"http://h/s?page=1": "http://h/s?page=2", "http://h/b": "http://h/en/?page=2"}
    rows = pages.listings(df, "html", ["url"], "Src", "url").collect()
    assert {r.document_url for r in rows} == {"http://h/b1", "http://h/t2"}
