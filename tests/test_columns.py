"""Column functions against hand-worked values and the standard library."""

import datetime as dt
import hashlib
import random
import re
from pathlib import PurePosixPath
from urllib.parse import unquote, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from folioflow.functions import dates, naming, payload, text, urls


def values(spark, rows, expression, schema="v string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.coalesce(1).select(expression).collect()]


def test_clean_text(spark):
    rows = [None, "", "  ", "a\t\nb", " x  y ", "\x1ca\x1fb\x85", "plain"]
    want = [None if v is None else " ".join(v.split()) or None for v in rows]
    assert values(spark, rows, text.clean_text("v")) == want
    assert values(spark, rows[1:], text.collapse("v")) == [" ".join(v.split()) for v in rows[1:]]


def test_every_python_space_counts(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert values(spark, ["x" + s + "y" for s in spaces], text.clean_text("v")) == ["x y"] * len(spaces)


def test_normalise_date(spark):
    rows = {
        "31/01/2024": "2024-01-31",
        "1/2/2024": "2024-02-01",
        "2024-1-5": "2024-01-05",
        "2024-01-05": "2024-01-05",
        "31/02/2024": "31/02/2024",
        "001/01/2024": "001/01/2024",
        "1/1/24": "1/1/24",
        "2024-02-30": "2024-02-30",
        "2024/01/05": "2024/01/05",
        "garbage": "garbage",
    }
    assert values(spark, list(rows), dates.normalise_date("v")) == list(rows.values())
    assert values(spark, [None], dates.normalise_date("v")) == [None]
    assert values(spark, ["5/1/2024", "x"], dates.record_day("v")) == [dt.date(2024, 1, 5), None]


def test_parse_date_is_strict(spark):
    assert values(spark, [" 01/03/2024 ", "1/3/2024"], dates.parse_date("v")) == [dt.date(2024, 3, 1)] * 2
    for bad in ("31/02/2024", "2024-01-01", "x"):
        with pytest.raises(Exception):
            values(spark, [bad], dates.parse_date("v"))


def test_month_keys(spark):
    day = F.to_date("v")
    assert values(spark, ["2024-01-15", "2024-03-31"], dates.previous_month_key(day)) == [
        "2023-12-01", "2024-02-01",
    ]
    assert values(spark, ["2024-02-15"], dates.day_first(F.last_day(day))) == ["29/02/2024"]


URLS = [
    "https://h.example/en/cases/2024/ADJ-00012345",
    "https://h.example/en/report.final.pdf?x=1#top",
    "https://h.example/a/b/",
    "https://h.example",
    "https://h.example/a;p=1",
    "https://h.example/a;x/b;y;z",
    "https://h.example/a b|c.PDF",
    "//h.example/x.html",
    "/rooted/y.doc",
    "rel/z.",
    "?q=1",
    "#f",
    "  https://h.example/lead",
    "https://h.example/ta\tb",
    "https://h.example/.hidden",
    "https://user@h.example:80/p.q",
    "https://h.example/ stem .html",
    "mailto:a@b.c",
]


def test_url_path_and_slug(spark):
    paths = [urlparse(u).path for u in URLS]
    assert values(spark, URLS, urls.path("v")) == paths
    stems = [p.rsplit("/", 1)[-1].rsplit(".", 1)[0].strip().upper() or None for p in paths]
    assert values(spark, URLS, urls.slug("v")) == stems


def test_unquote(spark):
    rows = ["a%20b", "a+b", "%zz%41", "100%", "%C3%A9", "%2Ftmp%2f", "plain"]
    assert values(spark, rows, urls.unquote("v")) == [unquote(r) for r in rows]


def test_suffix(spark):
    rows = ["a/.pdf", "x.", "x.tar.gz", "a.PDF/", "a.pdf/.", "..", "..foo", "noext", "", ".", "a/b.c/d"]
    want = []
    for r in rows:
        found = PurePosixPath(r).suffix.lower().lstrip(".")
        want.append(found or None)
    assert values(spark, rows, urls.suffix("v")) == want


def test_resolve_matches_the_standard_library(spark):
    bases = [
        "https://h.example/en/a/b.html?x=1#top", "https://h.example", "http://h.example/d/",
        "https://h.example/a;p/c;q?z",
    ]
    hrefs = [
        "", "/x", "/x/../y", "x", "./x", "../x", "../../../x", "a/b/../c", "a/./b", "..", ".",
        "?q=2", "#frag", "?q#f", "//other/y?z", "http://abs/p", "x//y", "/x//y", "a/..",
        "x?y#z", "x;r", "/", "../", "y z.pdf", "../é.pdf",
    ]
    pieces = ["..", ".", "a", "b.pdf", "", "c d"]
    rng = random.Random(5)
    hrefs += ["/".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(150)]
    rows = [(b, h) for b in bases for h in dict.fromkeys(hrefs) if not h.startswith("//") or h == "//other/y?z"]
    got = values(spark, rows, urls.resolve("b", "h"), "b string, h string")
    wrong = [(b, h, g, urljoin(b, h)) for (b, h), g in zip(rows, got) if g != urljoin(b, h)]
    assert not wrong


def test_host_allowed(spark):
    rows = ["https://h.example/x", "https://www.h.example/", "https://xh.example", "https://H.EXAMPLE:8/", "/x"]
    assert values(spark, rows, urls.host_allowed("v", ["h.example"])) == [True, True, False, True, False]


def test_content_type(spark):
    rows = ["text/html; charset=utf-8", " Application/PDF ", "", None, ";x"]
    assert values(spark, rows, naming.content_type("v")) == ["text/html", "application/pdf", "", "", ""]


def test_extensions(spark):
    rows = [
        ("application/pdf;x", "a.doc", "http://h/b.html", "pdf"),
        ("", "Ruling.DOCX", "http://h/b.html", "docx"),
        ("", "", "http://h/a%2Eb%2ERTF?x=.pdf", "rtf"),
        ("application/xhtml+xml", None, "http://h/b", "html"),
        (None, None, None, "bin"),
        ("text/plain", ".hidden", "http://h/", "bin"),
        ("application/vnd.ms-word.document.macroenabled.12", None, None, "docm"),
    ]
    schema = "t string, f string, u string, want string"
    assert values(spark, rows, naming.landing_extension("t", "f", "u"), schema) == [r[3] for r in rows]
    processed = ["text/html", "application/xhtml+xml", "TEXT/HTML", "application/msword", None]
    assert values(spark, processed, naming.processed_extension("v")) == ["html", "bin", "bin", "doc", "bin"]


def test_resolve_identifier(spark):
    url = "https://h/x/adj-1.html"
    rows = [
        ("12345", url, "T", "ADJ-1"),
        ("12345", "", "T", "12345"),
        ("REF 1", url, "T", "REF 1"),
        (None, url, "T", "ADJ-1"),
        (None, "https://h/", "T", "T"),
        (None, "", None, None),
        ("١٢", url, "T", "ADJ-1"),
    ]
    schema = "r string, u string, t string, want string"
    assert values(spark, rows, naming.resolve_identifier("r", "u", "t"), schema) == [r[3] for r in rows]


def test_landing_key(spark):
    rows = [
        ("Src X", "Labour Court", "2024-01", "A/B c", "Src X/labour_court/2024-01/a_b c.html"),
        (None, "", None, "X", "unknown/unknown/unknown/x.html"),
        ("./s//t", "b", "m", "X", "s/t/b/m/x.html"),
        ("s", "./b/.", "m", "X", "s/b/m/x.html"),
        ("s", "/b", "m", "X", "/b/m/x.html"),
    ]
    schema = "s string, b string, m string, i string, want string"
    got = values(spark, rows, naming.landing_key("s", "b", "m", "i", F.lit("html")), schema)
    assert got == [r[4] for r in rows]


def test_processed_key(spark):
    rows = [
        ("Labour Court", "2024-01", "A/b", "Labour_Court/2024-01/A/b.pdf"),
        (None, None, None, "unknown/unknown/.pdf"),
    ]
    schema = "b string, m string, i string, want string"
    assert values(spark, rows, naming.processed_key("b", "m", "i", F.lit("pdf")), schema) == [r[3] for r in rows]


def test_is_binary_document(spark):
    rows = [
        ("application/pdf", "http://h/x", True),
        ("APPLICATION/MSWORD; a", "http://h/x", True),
        ("text/html", "http://h/X.PDF?y", True),
        ("text/html", "http://h/x.docm", False),
        ("text/html", "http://h/x?y=.pdf", False),
        (None, None, False),
    ]
    schema = "t string, u string, want boolean"
    assert values(spark, rows, naming.is_binary_document("t", "u"), schema) == [r[2] for r in rows]


def test_payload_and_hash(spark):
    rows = [
        (bytearray(b"\x00\xff"), "h", "l", b"\x00\xff"),
        (bytearray(b""), "hé", "l", "hé".encode()),
        (None, "", "l", b"l"),
        (None, None, None, b""),
    ]
    schema = "b binary, h string, l string, want binary"
    body = payload.build_payload("b", "h", "l")
    assert [bytes(v) for v in values(spark, rows, body, schema)] == [r[3] for r in rows]
    assert values(spark, rows, payload.content_hash(body), schema) == [
        hashlib.sha256(r[3]).hexdigest() for r in rows
    ]
    known = "b94d27b9934d3e08a52e52d7da7dabfac484efe37a5380ee9088f7ace2efcde9"
    assert values(spark, ["hello world"], payload.content_hash("v")) == [known]


def test_decode_bytes(spark):
    raw = b"a\xffb\xc3\xa9\xe2\x82"
    got = values(spark, [(bytearray(raw),)], text.decode_bytes("v"), "v binary")[0]
    assert got == raw.decode("utf-8", errors="replace")
    assert re.search("�", got)
