import random
import time

import edges
import pytest
from folioflow.llm import extraction

SITE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body class='page-{n}'>"
    "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies on this site and that is long.</div>"
    "<div id='wrap'><div class='post post-{n}'><h2>Title {n}</h2><p>First &amp; <b>bold\n  text</b> here.</p><p>Second<br>line &lt;{n}&gt; &eacute;</p>"
    "<form><p>Name</p><input></form><div class='ad'>Buy</div><ul><li>one</li><li>two</li></ul></div>"
    "<aside><p>Side text that is rather long, longer than the article maybe, as it goes on and on.</p></aside>"
    "<div class='comments'><p>A reader's comment, longer than the article itself, on and on and on and on and on.</p></div></div><footer>foot</footer></body></html>"
)
WANT = "Title {n}\nFirst & bold text here.\nSecond line <{n}> é\none\ntwo"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_main_text(spark):
    rows = [(n, f"https://Host.example.org/{n}", SITE.format(n=n)) for n in range(6)]
    found = {r.page_id: r for r in extraction.extract(pages(spark, rows)).collect()}
    for n, url, _ in rows:
        assert found[n].text == WANT.format(n=n) and found[n].url == url
        assert found[n].n_chars == len(found[n].text)


def test_host_vote_beats_one_page(spark):
    odd = SITE.format(n=9).replace("<div id='wrap'>", "<div class='blurb'><p>" + edges.prose(1, 200) + "</p></div><div id='wrap'>")
    rows = [(n, f"http://h/{n}", SITE.format(n=n)) for n in range(5)] + [(9, "http://h/9", odd), (10, "http://alone/1", odd)]
    found = {r.page_id: r.text for r in extraction.extract(pages(spark, rows)).collect()}
    assert found[9] == WANT.format(n=9)  # its host's path, not the blurb
    assert found[10].startswith(edges.prose(1, 200))  # no host to learn from


def test_votes_count_per_host_and_break_ties_by_path(spark):
    cast = spark.createDataFrame([("h", "b"), ("h", "a"), ("h", "b"), ("g", "z"), ("g", "y")], "host string, path string")
    assert edges.rows(extraction.winners(cast)) == [("g", "y"), ("h", "b")]


def test_edge_rows(spark):
    rows = [(1, "http://h/1", None), (2, None, ""), (3, "not a url", "<p>plain"), (None, "http://h/2", "<div><p>x</div>"), (3, "not a url", "<p>plain"), (4, "http://h/3", "no markup &amp; more"), (5, "http://h/4", "<p>a</p>" * 20_000)]
    docs = pages(spark, rows).selectExpr("*", "'x' as host", "'y' as path", "'z' as text", "1 as n_chars")
    found = edges.rows(extraction.extract(docs).selectExpr("page_id", "url", "n_chars"))
    assert found == sorted([(1, "http://h/1", 0), (2, None, 0), (3, "not a url", 5), (3, "not a url", 5), (None, "http://h/2", 1), (4, "http://h/3", 16), (5, "http://h/4", 39_999)], key=repr)
    assert extraction.extract(pages(spark, [])).collect() == []


@pytest.mark.parametrize("markup", ["<div>" * 100_000, "<a href='" * 50_000, "<" * 300_000, "<!--" * 100_000, "<div class='a'>x" * 10_000 + "</section>" * 50_000, "<p class=\"x" * 50_000])
def test_broken_markup_takes_linear_time(markup):
    start = time.process_time()
    extraction.Page(markup).text("html/body")
    assert time.process_time() - start < 5


def test_title_and_lead_outside_the_body_container_stay(spark):
    long = edges.prose(3, 120)
    split = "<html><body><nav>Menu</nav><article><h1><a href='/'>Title {n}</a></h1><p>lead {n}</p><div class='entry-content'><p>" + long + "</p></div></article></body></html>"
    body = "<html><body><div class='entry-content'><p>" + long + "</p></div></body></html>"
    other = "<html><body><article><p>" + long + "</p></article><div class='entry-content'><p>small</p></div></body></html>"
    lead = body.replace("<div", "<p>lead</p><div")
    rows = [(n, f"http://a/{n}", split.format(n=n)) for n in range(3)] + [(n, f"http://b/{n}", body) for n in range(10, 14)]
    rows += [(14, "http://b/14", other), (15, "http://b/15", lead), (16, "http://b/16", body.replace("<div", "<div><h1>Title</h1></div><div"))]
    found = {r.page_id: r.text for r in extraction.extract(pages(spark, rows)).collect()}
    assert all(found[n] == f"Title {n}\nlead {n}\n{long}" for n in range(3))
    assert all(found[n] == long for n in range(10, 14))
    assert [found[14], found[15], found[16]] == [f"{long}\nsmall", f"lead\n{long}", f"Title\n{long}"]


LONG = edges.prose(4, 60)


@pytest.mark.parametrize(
    "around",
    [
        "<div class='content has-sidebar'>{}</div>",
        "<div id='page' class='site no-sidebar'>{}</div>",
        "<div class='layout with-comments'>{}</div>",
        "<div class='page-widget'>{}</div>",
        "<div title='the hidden cost'>{}</div>",
        "<div class='hidden lg:block' data-class='ad'>{}</div>",
        "<div><svg class='i'/>{}</div><p><svg></svg></p>",
        "<div><iframe src='x' />{}</div>",
        "<div><div><button></div>{}</div>",
        "<div><button>{}</div><div><button>Go</button></div>",
        "<div><script>var a = '<div>';</script><button><div>Menu</div></button>{}</div>",
    ],
)
def test_an_article_is_not_lost_by_its_wrapper(around):
    page = "<html><body><div class='sidebar'><p>side</p></div>" + around.format(f"<p>{LONG}</p>") + "<div class='comments'><p>me too</p></div><p hidden>no</p><div hidden>no</div></body></html>"
    found = extraction.Page(page).text(None)
    assert LONG in found and "side" not in found.split() and "me too" not in found and "Menu" not in found and "Go" not in found


def test_names_of_discussions_and_hidden_parts_still_go():
    page = f"<html><body><div><p>{LONG}</p></div><div id='comments-area'><article><p>{LONG * 3} yes</p></article></div><div hidden><p>secret</p></div><div class='site-footer'><p>foot</p></div></body></html>"
    assert extraction.Page(page).text(None) == LONG


@pytest.mark.parametrize("markup", ["<div><svg>" * 50_000 + "</div>" * 50_000 + "</svg>", "<button>" * 100_000, "<div><svg></div>" * 50_000, "<div " + "a " * 300_000 + ">x"])
def test_unclosed_elements_take_linear_time(markup):
    start = time.process_time()
    extraction.Page(markup).text("html/body")
    assert time.process_time() - start < 5


@pytest.mark.parametrize(
    "part",
    [
        "<p class='ad'>gone now</p>", "<p class='cookie-notice'>gone now</p>", "<ul><li class='comment'>gone now</li></ul>", "<p>some <span class='ad'>gone now</span></p>",
        "<div class='post-comments-wrapper'><p>gone now</p></div>", "<div class='google-ad-box'>gone now</div>", "<div id='cookiebar'>gone now</div>",
        "<ins class='adsbygoogle'>gone now</ins>", "<ins class='adsbygoogle'><div>gone now</div></ins>", "<section class='user-reviews'><p>gone now</p></section>",
        "<ul><li class='reply'>gone now<li class='reply'>gone now</ul>", "<p class='sponsored'>gone now<p>", "<p hidden>gone now</p>", "<p><b style='display:none'>gone now</b></p>",
        "<p><span class='ad'><span>gone</span> now</span></p>", "<h3 class='newsletter-signup'>gone now</h3>",
    ],
)
def test_adverts_notices_and_comments_on_any_element_go(part):
    page = "<html><body><article><h1>Title</h1><p>" + LONG + "</p>" + part + "<p>" + LONG + " end</p></article></body></html>"
    found = extraction.Page(page).text(None)
    assert "gone" not in found and found.startswith("Title\n" + LONG) and found.endswith("\n" + LONG + " end")


@pytest.mark.parametrize(
    "part, kept",
    [
        ("<div class='alert-level'><p>Level three</p></div>", "Level three"),
        ("<p class='notice-period'>Three months</p>", "Three months"),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", "so x=1 holds"),
        ("<p>so <math><semantics><mi>x</mi><annotation encoding='tex'>\\x</annotation></semantics></math> holds</p>", "so x holds"),
        ("<p>one <span class='lead'>two</span> three</p>", "one two three"),
        ("<p>one <span class='ad'>no</span> three</p>", "one three"),
        ("<p class='first'>one<p class='second'>two", "one\ntwo"),
        ("<ul><li class='point'>one<li>two</ul>", "one\ntwo"),
        ("<p class='adapted'>Adapted</p><p id='address'>Road 1</p><p class='commentary'>We say</p><p class='addition'>more</p>", "Adapted\nRoad 1\nWe say\nmore"),
        ("<h1 class='header'>Title</h1>", "Title"),
    ],
)
def test_parts_of_the_article_stay(part, kept):
    page = "<html><body><article><p>" + LONG + "</p>" + part + "</article></body></html>"
    assert extraction.Page(page).text(None) == f"{LONG}\n{kept}"


@pytest.mark.parametrize("markup", ["<span class='ad'>" * 100_000, "<p class='ad'>x" * 100_000, "<li class='comment'><p class='ad'>" * 50_000, "<span class='ad'><p>" * 50_000])
def test_judged_elements_take_linear_time(markup):
    start = time.process_time()
    extraction.Page(markup).text("html/body")
    assert time.process_time() - start < 6


NOISE = [
    "<nav><a href='/'>noise menu</a></nav>", "<div class='ad'>noise</div>", "<p class='ad'>noise</p>", "<form><p>noise</p></form>", "<aside><p>noise noise noise</p></aside>",
    "<div class='cookiebar'>noise</div>", "<script>noise()</script>", "<style>noise</style>", "<p class='cookie-notice'>noise</p>", "<!-- noise -->", "<div hidden>noise</div>",
    "<ins class='adsbygoogle'>noise</ins>", "<div role='search'>noise</div>", "<button>noise</button>",
]
OUTSIDE = [*NOISE, "<header><p>noise head</p></header>", "<footer>noise foot</footer>", "<div id='comments'><p>noise reader</p></div>", "<ul class='breadcrumbs'><li>noise</li></ul>"]


def generated(host, n):
    """(html, text): a page of a host, put together from blocks that are its text and parts that are not."""
    rng = random.Random(f"{host}/{n}")
    shape = random.Random(host)
    opening, closing = shape.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div class='post'>", "</div>"), ("<div id='c'><div class='entry-{n}'>", "</div></div>")])
    blocks, out = [f"<h1>Page {n}</h1>"], [f"Page {n}"]
    for i in range(rng.randrange(2, 9)):
        words = edges.prose(n * 50 + i, rng.randrange(8, 40))
        kind = rng.randrange(5)
        if kind == 0:
            blocks.append(f"<p>{words} <span class='ad'>noise</span>&amp; more")
            out.append(f"{words} & more")
        elif kind == 1:
            blocks.append(f"<ul><li>{words}<li class='reply'>noise<li>two &lt;{i}&gt;</ul>")
            out += [words, f"two <{i}>"]
        elif kind == 2:
            blocks.append(f"<blockquote><p>{words}</p><p>é\n  {i}</p></blockquote>")
            out += [words, f"é {i}"]
        elif kind == 3:
            blocks.append(f"<table><tr><td>{words}</td><td>{i}</td></tr></table>")
            out += [words, str(i)]
        else:
            blocks.append(f"<p>{words}<br>line <a href='#'>link</a></p>")
            out.append(f"{words} line link")
        if rng.random() < 0.4:
            blocks.append(rng.choice(NOISE))
    before, after = ["".join(rng.sample(OUTSIDE, 3)) for _ in range(2)]
    return f"<html><head><title>noise</title></head><body>{before}{opening.format(n=n)}{''.join(blocks)}{closing}{after}</body></html>", "\n".join(out)


def test_generated_pages_give_the_text_they_were_made_of(spark):
    made = [(h * 100 + n, f"https://host{h}.example/{n}", *generated(f"host{h}", n)) for h in range(12) for n in range(12)]
    found = {r.page_id: r.text for r in extraction.extract(pages(spark, [m[:3] for m in made])).collect()}
    wrong = [(i, found[i], text) for i, _, _, text in made if found[i] != text]
    assert wrong == []
