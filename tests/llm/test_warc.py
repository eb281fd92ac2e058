import glob
import gzip
import hashlib

import edges
from folioflow.llm import warc
from folioflow.session import new_folder

SCHEMA = "page_id long, url string, html string"
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def brute(rows):
    newest = {}
    for number, _, html in rows:
        if len((html or "").encode()) >= 1000:
            newest[html] = max(newest.get(html, -1), -1 if number is None else number)
    out, told = [], set()
    for number, _, html in rows:
        raw = (html or "").encode()
        first = newest.get(html)
        # Of equal rows one is the response.
        revisit = first is not None and ((-1 if number is None else number) != first or html in told)
        if not revisit and first is not None:
            told.add(html)
        out.append((number, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit and first >= 0 else None))
    return sorted(out, key=repr)


def archived(spark, rows, parts=3, **options):
    folder = new_folder(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(parts), folder, **options)
    return folder


def report(spark, folder):
    return edges.rows(warc.resolved(warc.captures(warc.read_records(spark, folder))).select(*COLUMNS))


BIG = "<p>" + edges.prose(1, 200) + "</p>"
EMBEDDED = "<pre>\r\n\r\n\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:fake>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\nWARC/1.1\r\n\r\n</pre>"
PAGES = [
    (1, "http://a.example/1", BIG),
    (2, "http://a.example/2", BIG),
    (9, "http://a.example/9", BIG),
    (3, "http://a.example/3", "small"),
    (4, "http://a.example/4", "small"),  # equal, but small
    (5, None, None),
    (6, "http://a.example/six and\r\nmore: x", ""),
    (7, "http://a.example/WARC/1.1/spec", "é中文😀" * 400),
    (8, "http://b.example/8", EMBEDDED),
    (10, "http://b.example/10", "WARC/1." * 500),
    (11, "http://b.example/11", EMBEDDED + BIG),
    (12, "http://b.example/12", "\r\n\r\n" * 300),
    (13, "http://b.example/13", "x" * 1000),
    (14, "http://b.example/14", "x" * 1000),
    (15, "http://b.example/15", "y" * 999),
    (16, "http://b.example/16", "y" * 999),
    (17, "u", "z" * 2_000_000),
    (18, "u", edges.prose(18, 300)),
    (18, "u", edges.prose(18, 300)),  # the same row again
    (None, "u", edges.prose(19, 300)),
    (None, None, None),
]


def test_against_brute_force(spark):
    for parts in (1, 5):
        assert report(spark, archived(spark, PAGES, parts)) == brute(PAGES)


def test_many_copies(spark):
    rows = [(i, f"http://h.example/{i}", edges.prose(i % 3 and i, 200)) for i in range(900)]
    assert report(spark, archived(spark, rows, 8)) == brute(rows)


def parse(folder):
    """Records of the archives, by a sequential reader of its own."""
    out = []
    for name in glob.glob(folder.removeprefix("file://") + "/*.gz"):
        data = gzip.open(name).read()
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            lines = data[at:end].decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = [line.split(": ", 1) for line in lines[1:]]
            size = int(dict(fields)["Content-Length"])
            out.append((dict(fields), data[end + 4 : end + 4 + size]))
            assert data[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
            at = end + 8 + size
    return out


def test_archives_are_valid(spark):
    found = parse(archived(spark, PAGES))
    assert len(found) == 3 * len(PAGES)
    names = [f["WARC-Record-ID"] for f, _ in found]
    assert len(set(names)) == len(names)
    main = {f["WARC-Record-ID"]: (f, b) for f, b in found if f["WARC-Type"] in warc.CAPTURES}
    for f, _ in found:
        if f["WARC-Type"] in ("request", "metadata"):
            assert f["WARC-Concurrent-To"] in main
    for f, block in main.values():
        body = block.split(b"\r\n\r\n", 1)[1]
        if f["WARC-Type"] == "response":
            assert "sha1:" + hashlib.sha1(body).hexdigest() == f["WARC-Payload-Digest"]
        else:
            target, original = main[f["WARC-Refers-To"]]
            assert body == b"" and target["WARC-Type"] == "response" and target["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]


def test_payloads_come_back(spark):
    captured = warc.captures(warc.read_records(spark, archived(spark, PAGES)))
    full = [bytes(r.payload).decode() for r in captured.where("kind = 'response'").collect()]
    assert set(full) == {h or "" for _, _, h in PAGES}
    row = captured.where("target_uri = 'http://a.example/3'").first()
    assert [r.block for r in row.requests] == ["GET http://a.example/3 HTTP/1.1\r\nHost: a.example\r\n\r\n"] and [m.block for m in row.metadata] == ["page_id: 3\r\n"]


def write(spark, records):
    folder = new_folder(spark, "warc-test")
    spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(folder)
    return folder


def raw(kind, name, block, *headers):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", *headers, f"content-length: {len(block)}"]
    return "WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n" + block


def test_foreign_archives(spark):
    """Either record may name the other, several times; other kinds are passed over; what is cut off is damaged."""
    folder = write(
        spark,
        [
            raw("warcinfo", "<i>", "software: x"),
            raw("response", "<a>", "HTTP/1.1 200 OK\r\n\r\nbody", "Content-Type: application/http", "WARC-Concurrent-To: <q>", "WARC-Concurrent-To: <m>"),
            raw("request", "<q>", "GET /", "WARC-Concurrent-To: <a>"),
            raw("metadata", "<m>", "a: b"),
            raw("metadata", "<n>", "c: d", "WARC-Concurrent-To: <a>", "WARC-Concurrent-To: <lost>"),
            raw("response", "<r>", "plain", "Content-Type: text/plain"),
            raw("revisit", "<v>", "", "WARC-Refers-To: <gone>", "WARC-Payload-Digest: sha1:ABC"),
            raw("response", "<cut>", "HTTP/1.1 200 OK\r\n\r\nbody", "Content-Type: application/http").replace("content-length: 23", "content-length: 99"),
        ],
    )
    records = warc.read_records(spark, folder)
    assert records.count() == 8 and [r.record_id for r in records.where("damaged").collect()] == ["<cut>"]
    found = {r.record_id: r for r in warc.captures(records).collect()}
    assert set(found) == {"<a>", "<r>", "<v>", "<cut>"}
    a = found["<a>"]
    assert bytes(a.payload) == b"body" and [r.record_id for r in a.requests] == ["<q>"] and [m.block for m in a.metadata] == ["a: b", "c: d"]
    assert bytes(found["<r>"].payload) == b"plain" and found["<r>"].requests == []
    revisit = [r for r in warc.resolved(warc.captures(records)).collect() if r.record_type == "revisit"][0]
    assert (revisit.payload_bytes, revisit.payload_digest, revisit.refers_to) == (None, "abc", None)


def test_plain_archives_are_read_in_splits(spark):
    rows = [(i, f"http://h.example/{i}", edges.prose(i, 300) + ("WARC/1.1" if i == 40 else "")) for i in range(120)]
    folder = new_folder(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    lines = spark.read.option("lineSep", "\r\n\r\n").text(folder)
    plain = new_folder(spark, "warc-test")
    lines.coalesce(1).write.option("lineSep", "\r\n\r\n").text(plain)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert report(spark, plain) == brute(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_edge_rows(spark):
    pages = edges.clashing(spark).withColumnsRenamed({"doc_id": "page_id", "text": "html"}).withColumn("url", edges.F.col("source"))
    folder = new_folder(spark, "warc-test")
    warc.write_archives(pages, folder)
    assert report(spark, folder) == brute([(d, s, t) for d, t, _, s in edges.ROWS])
    assert report(spark, archived(spark, [])) == []


def test_records_without_payloads_give_the_same_report(spark):
    folder = archived(spark, PAGES)
    records = warc.read_records(spark, folder, payloads=False)
    assert records.where("kind = 'response' and block is not null").count() == 0
    assert edges.rows(warc.resolved(warc.captures(records)).select(*COLUMNS)) == brute(PAGES)


def test_payload_is_not_shuffled(spark):
    """Only narrow columns meet the joins of the report."""
    captured = warc.captures(warc.read_records(spark, archived(spark, PAGES[:6])))
    plan = captured.select("record_id", "payload_bytes", "payload_sha1", "metadata")._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    assert "payload#" not in plan[:join]
