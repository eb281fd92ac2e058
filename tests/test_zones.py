"""Landing, transform and streams over zone tables."""

import datetime as dt
import hashlib
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.operators import months, pages
from folioflow.operators.cases import prepare_cases
from folioflow.operators.pages import document_pages
from folioflow.plans.land import land, stored_content
from folioflow.plans.transform import KEPT, process_rows, processed_content, transform
from folioflow.plans.zones import build_cases, capture_cases, run_metrics, run_zones
from folioflow.sources import captures, zones
from folioflow.sources.zones import landing_zone, processed_zone
from folioflow.streaming.changes import change_detector, stream_changes
from folioflow.streaming.landing import stream_landing

T1, T2 = dt.datetime(2024, 6, 1), dt.datetime(2024, 7, 1)


def case(identifier, seq, html=None, raw=None, **given):
    row = dict.fromkeys(S.INCOMING_CASES.names)
    row.update(
        source="Src", body="Labour Court", identifier=identifier, partition_date="2024-01",
        content_type="text/html", link_to_doc="http://h/d", seq=seq, content_html=html, content_bytes=raw,
    )
    row.update(given)
    return row


def frame(spark, rows):
    return spark.createDataFrame(rows, S.INCOMING_CASES)


def by_id(df):
    return {r.identifier: r for r in df.collect()}


BATCH = [
    case("A", 1, "<main>a</main>"),
    case("A", 2, "<main>a</main>", title=" T  2 "),
    case("B/1", 3, None, bytearray(b"%PDF"), content_type="application/pdf", body="Equality Tribunal"),
    case(None, 4, "x"),
    case("C", 5, "<body>c<nav>n</nav></body>", partition_date="2024-02"),
    case("D", 6, None, bytearray(b"\xff<p>d"), partition_date="2024-02"),
    case("E", 7, None, None, content_type="", link_to_doc="http://h/e"),
]


def test_landing(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    outcomes = land(frame(spark, BATCH), zone, 0, T1)
    assert sorted((r.seq, r.outcome) for r in outcomes.collect()) == [
        (1, "stored"), (2, "unchanged"), (3, "stored"), (4, "dropped"), (5, "stored"), (6, "stored"), (7, "stored"),
    ]
    rows = by_id(zone.cases.read())
    assert set(rows) == {"A", "B/1", "C", "D", "E"}
    assert rows["A"].scrape_status == "unchanged" and rows["A"].title == "T 2"
    assert rows["B/1"].path_to_file == "Src/equality_tribunal/2024-01/b_1.pdf"
    assert rows["C"].scraped_at == T1
    content = {r.path_to_file: (bytes(r.content), r.content_type, r.file_hash) for r in zone.content.read().collect()}
    assert content["Src/labour_court/2024-01/e.bin"][:2] == (b"http://h/e", "application/octet-stream")
    assert content["Src/equality_tribunal/2024-01/b_1.pdf"][0] == b"%PDF"
    assert all(hashlib.sha256(c[0]).hexdigest() == c[2] for c in content.values())
    assert len(content) == 5


def test_landing_twice_changes_nothing_but_status(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, BATCH), zone, 0, T1)
    first, content = by_id(zone.cases.read()), zone.content._all().count()
    again = land(frame(spark, BATCH), zone, 1, T2)
    assert {r.outcome for r in again.collect()} == {"unchanged", "dropped"}
    second = by_id(zone.cases.read())
    for key, row in first.items():
        a, b = row.asDict(), second[key].asDict()
        assert b.pop("scrape_status") == "unchanged" and b.pop("scraped_at") == T2
        a.pop("scrape_status"), a.pop("scraped_at")
        assert a == b
    assert zone.content._all().count() == content


def test_a_replayed_batch_lands_once(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, BATCH), zone, 0, T1)
    again = land(frame(spark, BATCH), zone, 0, T2)
    assert "stored" in {r.outcome for r in again.collect()}
    assert {r.scraped_at for r in zone.cases.read().collect()} == {T1}


def test_a_batch_that_failed_half_way_lands_again(spark, tmp_path, monkeypatch):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, BATCH), zone, 0, T1)
    before = by_id(zone.cases.read())
    late = [case("A", 1, "new", partition_date="2024-05")]

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(zone.cases, "publish", fail)
        with pytest.raises(RuntimeError):
            land(frame(spark, late), zone, 1, T2)
    assert by_id(zone.cases.read()) == before
    land(frame(spark, late), zone, 1, T2)
    assert by_id(zone.cases.read())["A"].partition_date == "2024-05"
    assert zone.content.read().count() == 6


def test_splitting_a_batch_changes_nothing(spark, tmp_path):
    rng = random.Random(4)
    rows = [
        case(
            f"k{rng.randrange(8)}", i, rng.choice(["x", "y"]),
            partition_date=rng.choice(["2024-01", "2024-02"]), body=rng.choice(["P", "Q q"]),
        )
        for i in range(60)
    ]
    whole, split = landing_zone(spark, str(tmp_path / "w")), landing_zone(spark, str(tmp_path / "s"))
    land(frame(spark, rows), whole, 0, T1)
    out = [land(frame(spark, part), split, n, T1) for n, part in enumerate((rows[:25], rows[25:40], rows[40:]))]
    assert by_id(whole.cases.read()) == by_id(split.cases.read())
    one = {r.path_to_file: bytes(r.content) for r in whole.content.read().collect()}
    many = {r.path_to_file: bytes(r.content) for r in split.content.read().collect()}
    assert one == many
    assert sum(o.count() for o in out) == 60


def test_moved_rows_leave_their_partition(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, [case("A", 1, "x"), case("B", 2, "y", body="Other")]), zone, 0, T1)
    land(frame(spark, [case("A", 1, "x", partition_date="2024-03")]), zone, 1, T2)
    rows = by_id(zone.cases.read())
    assert rows["A"].partition_date == "2024-03" and rows["A"].path_to_file.endswith("/2024-01/a.html")
    assert zone.cases.scan_months("2024-01", "2024-01").count() == 1
    assert [r.identifier for r in zone.cases.scan_months("2024-02", "2024-12").collect()] == ["A"]
    assert [r.identifier for r in zone.cases.scan_months("2024-01", "2024-12", "Other").collect()] == ["B"]
    folders = {(r.zone_body, r.folder) for r in zone.cases._index()[1] if r.zone_body}
    assert folders == {("other", 0), ("labour_court", 1)}


def test_unsupplied_column_is_kept(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    row = {n: None for n in S.LANDING_CASES.names} | {"identifier": "A", "file_name": "f.doc", "title": "t"}
    zone.cases.publish(0, spark.createDataFrame([row], S.LANDING_CASES), S.LANDING_CASES.names)
    land(frame(spark, [case("A", 1, "x", file_name="g.doc")]), zone, 1, T1)
    got = by_id(zone.cases.read())["A"]
    assert got.file_name == "f.doc" and got.title is None and got.body == "Labour Court"


def test_colliding_keys_share_the_later_payload(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, [case("A/1", 1, "one"), case("a_1", 2, "two")]), zone, 0, T1)
    content = zone.content.read().collect()
    assert [bytes(r.content) for r in content] == [b"two"]
    located = zone.content.attach(zone.cases.keys("path_to_file"))
    assert {bytes(r.content) for r in located.collect()} == {b"two"}


def test_transform(spark, tmp_path):
    landing = landing_zone(spark, str(tmp_path / "l"))
    processed = processed_zone(spark, str(tmp_path / "p"))
    land(frame(spark, BATCH), landing, 0, T1)
    outcomes = transform(landing, processed, 0, "2024-01", "2024-02", T2)
    assert {(r.identifier, r.outcome) for r in outcomes.collect()} == {(i, "ok") for i in ("A", "B/1", "C", "D", "E")}
    rows = by_id(processed.cases.read())
    assert rows["A"].path_to_file == "Labour_Court/2024-01/A.html" and rows["A"].processed_at == T2
    assert rows["B/1"].path_to_file == "Equality_Tribunal/2024-01/B/1.pdf"
    assert rows["E"].path_to_file == "Labour_Court/2024-01/E.bin"
    assert rows["A"].title == "T 2" and rows["A"].scrape_status == "unchanged"
    content = {r.path_to_file: r for r in processed_content(processed).collect()}
    assert bytes(content["Labour_Court/2024-02/C.html"].content).decode() == (
        S.PAGE_OPEN + "<body>c</body>" + S.PAGE_CLOSE
    )
    assert "�" in bytes(content["Labour_Court/2024-02/D.html"].content).decode()
    assert bytes(content["Equality_Tribunal/2024-01/B/1.pdf"].content) == b"%PDF"
    for key, row in rows.items():
        found = content[row.path_to_file]
        assert row.file_hash == found.file_hash == hashlib.sha256(bytes(found.content)).hexdigest()


def test_transform_outcomes(spark, tmp_path):
    landing = landing_zone(spark, str(tmp_path / "l"))
    processed = processed_zone(spark, str(tmp_path / "p"))
    land(frame(spark, BATCH), landing, 0, T1)
    names = S.LANDING_CASES.names
    extra = [
        dict.fromkeys(names) | {"identifier": "N", "partition_date": "2024-01", "path_to_file": ""},
        dict.fromkeys(names) | {"identifier": "M", "partition_date": "2024-01", "path_to_file": "s/b/2024-01/gone.pdf"},
        dict.fromkeys(names) | {"identifier": "U", "partition_date": "unknown", "path_to_file": "p"},
    ]
    landing.cases.publish(1, spark.createDataFrame(extra, S.LANDING_CASES), names)
    got = by_id(transform(landing, processed, 0, "2024-01", "2024-01", T2))
    assert {k: r.outcome for k, r in got.items()} == {
        "A": "ok", "B/1": "ok", "E": "ok", "N": "skipped", "M": "failed",
    }
    assert got["M"].reason == "no content"
    assert set(by_id(processed.cases.read())) == {"A", "B/1", "E"}
    one = transform(landing, processed, 1, "2024-01", "2024-12", T2, body="Equality Tribunal")
    assert set(by_id(one)) == {"B/1"}
    # Every row of the range is processed again, changed or not.
    assert by_id(processed.cases.read())["B/1"].processed_at == T2


def carrying(plan: str, *columns: str) -> list[str]:
    """Exchanges and Python nodes below whose output a column of these names may stand."""
    lines = plan.splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange" in line or "Python" in line or "InArrow" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1 :]:
                own = len(below) - len(below.lstrip(" :+-"))
                if own <= depth or "Exchange" in below:
                    break
                if "Project [" in below or "FileScan" in below:
                    shown = below.split("FileScan parquet ")[-1].split("] Batched")[0]
                    if any(f"{c}#" in shown for c in columns):
                        found.append(line.strip())
                    break
    return found


def large(spark):
    """Plans as they are for tables that no task could broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")


def small(spark):
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_payloads_stay_put_for_small_metadata(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, BATCH), zone, 0, T1)
    located = zone.content.attach(zone.cases.read().select("identifier", "path_to_file"))
    assert located.count() == 5
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(zone.content.attach(zone.cases.read().select("identifier", "path_to_file")))
        stored = plan_of(stored_content(frame(spark, BATCH), zone.staged("decisions", 0)))
    finally:
        small(spark)
    for text in (plan, stored):
        assert carrying(text, "content", "content_bytes", "content_html") == []


def test_only_the_join_with_stored_rows_moves_payloads(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, BATCH), zone, 0, T1)
    large(spark)
    try:
        read = plan_of(zone.content.attach(zone.cases.read().select("identifier", "path_to_file")))
        written = plan_of(stored_content(frame(spark, BATCH), zone.staged("decisions", 0)))
    finally:
        small(spark)
    assert len(carrying(read, "content")) == 1
    assert written.count("Exchange hashpartitioning(seq") == 2  # payloads and winners, nothing else by seq
    assert "Python" not in read + written and "REBALANCE" not in read + written


def test_change_detection_and_captures_carry_no_payload(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    captured, found = captured_pages(spark), found_listings(spark)
    incoming = build_cases(found, captured, ["seq"], zone, 0)
    assert not {"content_bytes", "content_html"} & set(incoming.cases.columns)
    large(spark)
    try:
        plan = plan_of(prepare_cases(incoming.cases))
    finally:
        small(spark)
    assert carrying(plan, "content_bytes", "content_html") == []


def test_one_file_is_prepared_by_many_tasks(spark, tmp_path):
    """The rows of a batch are normalised on all cores, though one task reads them; payloads stay with that task."""
    rows = [case(f" id {i} ", i, f"text {i % 7}") for i in range(300)]
    frame(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    incoming = spark.read.schema(S.INCOMING_CASES).parquet(str(tmp_path / "in"))
    prepared = prepare_cases(incoming)
    # In the step below the exchange, payloads stand within the hash only.
    below = plan_of(prepared).split("REPARTITION_BY_NUM")[1].split("Project [")[1].splitlines()[0]
    assert "content_" not in re.sub(r"sha2\(.*, 256\)", "", below).replace("content_type", "") and "sha2(" in below
    tasks = prepared.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in tasks) < 150
    got = {r.seq: (r.identifier, r.file_hash) for r in prepared.collect()}
    assert got == {i: (f"id {i}", hashlib.sha256(f"text {i % 7}".encode()).hexdigest()) for i in range(300)}


def test_binaries_do_not_meet_python(spark, tmp_path):
    landing = landing_zone(spark, str(tmp_path / "l"))
    land(frame(spark, BATCH), landing, 0, T1)
    rows = process_rows(landing.content.attach(landing.cases.read().select(*KEPT)))
    pages = document_pages(captured_pages(spark))
    for plan, payload in ((plan_of(rows), "content#"), (plan_of(pages), "body#")):
        python = [line for line in plan.splitlines() if "MapInArrow" in line]
        assert len(python) == 1 and "raw#" not in python[0] and payload not in python[0]


def test_unpublished_content_is_not_read(spark, tmp_path, monkeypatch):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, [case("A", 1, "old")]), zone, 0, T1)

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(zone.cases, "publish", fail)
        with pytest.raises(RuntimeError):
            land(frame(spark, [case("A", 1, "new")]), zone, 1, T2)
    located = zone.content.attach(zone.cases.read().select("identifier", "path_to_file"))
    assert [bytes(r.content) for r in located.collect()] == [b"old"]


def test_hash_probe(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, BATCH), zone, 0, T1)
    have = {r.path_to_file: r.file_hash for r in zone.content.read().collect()}
    path, file_hash = sorted(have.items())[0]
    asked = spark.createDataFrame([(path, file_hash), (path, "other"), ("no/such/key", file_hash)], "path_to_file string, file_hash string")
    assert [tuple(r) for r in zone.content.holds(asked).collect()] == [(path, file_hash)]


def test_the_index_does_not_grow_with_batches(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    for batch in range(5):
        land(frame(spark, [case(f"k{batch}", batch, "x")]), zone, batch, T1)
    files = [p for p in (tmp_path / "cases" / "index").rglob("part-*")]
    assert len(files) == 2 and zone.cases.read().count() == 5


def test_a_small_batch_opens_its_own_buckets(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    land(frame(spark, [case(f"k{i}", i, "x") for i in range(300)]), zone, 0, T1)
    one = frame(spark, [case("k7", 1, "x")])
    state = zone.cases.state(one)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ (?:=|IN)", plan)
    assert [r.identifier for r in state.collect()] == ["k7"]


def test_states_are_merged_and_stay_right(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zones, "DELTAS", 2)
    zone = landing_zone(spark, str(tmp_path))
    for batch in range(5):
        rows = [case(f"k{batch}", 1, "new"), case("same", 2, "x"), case("moved", 3, "y", partition_date=f"2024-0{batch + 1}")]
        land(frame(spark, rows), zone, batch, T1)
    table = {r.identifier: (r.file_hash, r.path_to_file) for r in zone.cases.read().collect()}
    states = {r.identifier: (r.file_hash, r.path_to_file) for r in zone.cases.state(zone.cases.read()).collect()}
    assert states == table and len(table) == 7
    assert sum(r.zone_month is None for r in zone.cases._index()[1]) <= 2
    assert table["moved"][1].endswith("/2024-01/moved.html")


def test_run_zones_reports_each_partition(spark, tmp_path):
    landing = landing_zone(spark, str(tmp_path / "l"))
    processed = processed_zone(spark, str(tmp_path / "p"))
    report = run_zones(frame(spark, BATCH), landing, processed, 0, "2024-01", "2024-12", T1)
    got = {(r.body, r.partition_date): r for r in report.collect()}
    assert (got["Labour Court", "2024-01"].stored, got["Labour Court", "2024-01"].unchanged) == (2, 1)
    assert got["Labour Court", "2024-01"].dropped == 1 and got["Labour Court", "2024-02"].processed == 2
    kept = run_metrics(processed).collect()
    assert {r.v for r in kept} == {0} and len(kept) == 3
    pending = months.pending_partitions(landing.cases.read(), processed.cases.read())
    assert pending.count() == 0


def captured_pages(spark):
    long = "word " * 40
    return spark.createDataFrame(
        [
            ("http://h/1", "text/html", bytearray(f"<main>{long}</main>".encode())),
            ("http://h/2", "text/html", bytearray(b"<div class='content'><a href='/f.pdf'>x</a></div>")),
            ("http://h/f.pdf", "application/pdf", bytearray(b"%PDF")),
        ],
        S.CAPTURED_PAGES,
    )


def found_listings(spark):
    found = spark.createDataFrame(
        [("Src", "B", "2024-01", f"ID{i}", f"http://h/{i}#x", i) for i in (1, 2, 3)],
        "source string, body string, partition_date string, identifier string, document_url string, seq long",
    )
    for name in ("title", "description", "case_number", "record_date"):
        found = found.withColumn(name, F.lit(None).cast("string"))
    return found.withColumn("source_page_url", F.col("document_url"))


def test_build_cases_from_pages(spark, tmp_path):
    zone = landing_zone(spark, str(tmp_path))
    incoming = build_cases(found_listings(spark), captured_pages(spark), ["seq"], zone, 0)
    outcomes = land(incoming, zone, 0, T1)
    assert {r.identifier: (r.outcome, r.reason) for r in outcomes.collect()} == {
        "ID1": ("stored", None), "ID2": ("stored", None), "ID3": ("failed", "no captured page"),
    }
    rows = by_id(zone.cases.read())
    assert {k: r.link_to_doc for k, r in rows.items()} == {"ID1": "http://h/1", "ID2": "http://h/f.pdf"}
    assert rows["ID2"].path_to_file == "Src/b/2024-01/id2.pdf"
    content = {r.path_to_file: r for r in zone.content.read().collect()}
    assert bytes(content["Src/b/2024-01/id2.pdf"].content) == b"%PDF"
    assert all(hashlib.sha256(bytes(r.content)).hexdigest() == r.file_hash == rows[i].file_hash for i in rows for r in [content[rows[i].path_to_file]])


def test_a_results_page_that_cannot_be_read_is_a_failed_row(spark, tmp_path, monkeypatch):
    zone = landing_zone(spark, str(tmp_path))
    real = pages.extract_pages

    def broken(rows, html, facts, keep, wrap=True):
        read = real(rows, html, facts, keep, wrap)
        if "listings" not in facts:
            return read
        return read.withColumn("error", F.when(F.col("url").endswith("2"), "ValueError: bad")).withColumn(
            "listings", F.when(~F.col("url").endswith("2"), F.col("listings"))
        )

    monkeypatch.setattr(pages, "extract_pages", broken)
    item = '<li class="each-item clearfix"><h2 class="title"><a href="/1">t</a></h2><span class="refNO">R</span></li>'
    results = spark.createDataFrame([("http://h/r1", item + '<a class="next" href="/r2">n</a>'), ("http://h/r2", item)], "url string, html string")
    starts = spark.createDataFrame([("http://h/r1", "B", "2024-01")], "url string, body string, partition_date string")
    incoming = capture_cases(starts, results, captured_pages(spark), "Src", zone, 0)
    got = [(r.identifier, r.partition_date, r.outcome, r.reason) for r in land(incoming, zone, 0, T1).collect()]
    assert sorted(got, key=repr) == [("R", "2024-01", "stored", None), ("R2", "2024-01", "failed", "ValueError: bad")]


def test_read_files(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"%PDF")
    (tmp_path / "b.html").write_text("<p>x")
    (tmp_path / "c.xyz").write_text("z")
    got = {r.url.rsplit("/", 1)[1]: (r.content_type, bytes(r.body)) for r in captures.read_files(spark, str(tmp_path)).collect()}
    assert got == {"a.PDF": ("application/pdf", b"%PDF"), "b.html": ("text/html", b"<p>x"), "c.xyz": ("", b"z")}


def stream_parts(spark, folder, df, n):
    """One file per part, written one after the other."""
    for i in range(n):
        df.where(F.col("seq") % n == i).coalesce(1).write.mode("append").parquet(folder)


def test_stream_landing_converges(spark, tmp_path):
    rng = random.Random(8)
    rows = [case(f"k{rng.randrange(6)}", i, rng.choice(["x", "y", "z"])) for i in range(40)]
    rows.sort(key=lambda r: r["seq"] % 3)
    folder = str(tmp_path / "in")
    stream_parts(spark, folder, frame(spark, rows), 3)
    zone = landing_zone(spark, str(tmp_path / "zone"))
    for _ in range(2):  # the second run finds nothing new
        cases = captures.stream_files(spark, folder, S.INCOMING_CASES, files_per_batch=1)
        stream_landing(cases, zone, str(tmp_path / "ckpt"), lambda: T1).awaitTermination()
    assert zone.cases.last_batch() == 2

    batches = landing_zone(spark, str(tmp_path / "batches"))
    for i in range(3):
        land(frame(spark, [r for r in rows if r["seq"] % 3 == i]), batches, i, T1)
    assert by_id(zone.cases.read()) == by_id(batches.cases.read())


def test_stream_changes_equal_the_model(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"k{rng.randrange(9)}", i, rng.choice(["A", "B", None]), f"key{i}") for i in range(120)]
    rng.shuffle(rows)
    schema = "identifier string, seq long, file_hash string, object_key string"
    df = spark.createDataFrame(rows, schema)
    folder = str(tmp_path / "in")
    stream_parts(spark, folder, df, 3)
    existing = {"k0": ("A", "old0"), "k1": ("B", ""), "k2": (None, "old2")}
    state = spark.createDataFrame([(k, *v) for k, v in existing.items()], "identifier string, file_hash string, path_to_file string")
    query = (
        stream_changes(captures.stream_files(spark, folder, df.schema, 1), state)
        .writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()

    known, want = dict(existing), []
    for identifier, seq, file_hash, key in sorted(rows, key=lambda r: (r[1] % 3, r[1])):
        old = known.get(identifier)
        status, path = ("unchanged", old[1]) if old and old[0] == file_hash and old[1] else ("stored", key)
        known[identifier] = (file_hash, path)
        want.append((identifier, seq, status, path))
    assert sorted((r.identifier, r.seq, r.scrape_status, r.path_to_file) for r in got) == sorted(want)


class MapOfState:
    """A state handle whose map counts what it is asked."""

    def __init__(self):
        self.held, self.looks, self.writes = {}, 0, 0

    def getMapState(self, name, key, value):
        return self

    def getValue(self, key):
        self.looks += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self.held[key] = value


def test_a_call_judges_many_identifiers():
    """At most a look and a write per identifier and micro-batch, one call for all of them, missing values included."""
    rng = random.Random(9)
    state, detector = MapOfState(), change_detector()
    detector.init(state)
    existing = {"k0": ("A", "old0"), "k1": ("B", ""), "k2": (None, "old2"), "k3": ("A", None), None: ("B", "old")}
    given = pd.DataFrame([(7, k, *v) for k, v in existing.items()], columns=["bucket", "identifier", "file_hash", "path_to_file"])
    for part in (given.iloc[:2], given.iloc[2:]):
        detector.handleInitialState((7,), part, None)
    known = dict(existing)
    for number in range(3):
        names = [None, *(f"k{i}" for i in range(40))]
        rows = [(7, rng.choice(names), i, rng.choice(["A", "B", None]), rng.choice([f"key{i}", f"key{i}", None])) for i in range(200)]
        rng.shuffle(rows)
        parts = [pd.DataFrame(rows[i::3], columns=["bucket", "identifier", "seq", "file_hash", "object_key"]) for i in range(3)]
        state.looks = state.writes = 0
        got = pd.concat(list(detector.handleInputRows((7,), iter(parts), None)))

        before, want = dict(known), []
        for _, identifier, seq, file_hash, key in sorted(rows, key=lambda r: r[2]):
            old_hash, old_path = known.get(identifier, (None, None))
            stored = not old_path or old_hash != file_hash
            # As a window of the batch has it: the head is judged by the path from before it.
            if identifier in [w[0] for w in want]:
                stored = old_hash != file_hash
            path = key if stored and key is not None else old_path
            known[identifier] = (file_hash, path)
            want.append((identifier, seq, "stored" if stored else "unchanged", path))
        plain = [tuple(None if pd.isna(v) else v for v in r) for r in got[["identifier", "seq", "scrape_status", "path_to_file"]].itertuples(index=False)]
        assert sorted(plain, key=lambda r: r[1]) == want
        assert state.held == {(k,): v for k, v in known.items()}
        assert state.looks == (0 if number == 0 else len({r[1] for r in rows}))
        assert state.writes == sum(known[k] != before.get(k) for k in known)


def test_stream_changes_with_a_missing_identifier(spark, tmp_path):
    schema = "identifier string, seq long, file_hash string, object_key string"
    df = spark.createDataFrame([(None if i % 4 == 0 else f"k{i % 4}", i, "A" if i < 16 else "B", f"key{i}") for i in range(24)], schema)
    folder = str(tmp_path / "in")
    stream_parts(spark, folder, df, 2)
    state = spark.createDataFrame([(None, "A", "old"), ("k1", "A", "old1")], "identifier string, file_hash string, path_to_file string")
    query = (
        stream_changes(captures.stream_files(spark, folder, df.schema, 1), state)
        .writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {r.seq: (r.identifier, r.scrape_status, r.path_to_file) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 24
    assert got[0] == (None, "unchanged", "old") and got[16] == (None, "stored", "key16") and got[20] == (None, "unchanged", "key16")
    assert got[1] == ("k1", "unchanged", "old1") and got[2] == ("k2", "stored", "key2")
