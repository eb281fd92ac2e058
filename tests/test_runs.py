"""Runs by key, the list of files, fields supplied per row, and what is built on them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import schemas as S
from folioflow.operators import links, metrics, pages
from folioflow.operators.upsert import fold_fields
from folioflow.plans.land import land
from folioflow.sources import captures, runs, zones
from folioflow.sources.zones import landing_zone
from folioflow.streaming import changes

PAIRS = T.StructType([T.StructField("k", T.StringType()), T.StructField("value", T.StringType())])
T1 = dt.datetime(2024, 6, 1)


def table(spark, tmp_path):
    return runs.KeyTable(spark, str(tmp_path / "t"), "k", PAIRS)


def pairs(spark, held):
    return spark.createDataFrame(list(held.items()), PAIRS)


@pytest.mark.parametrize("deltas", [2, 3])
def test_lookups_equal_a_dictionary(spark, tmp_path, monkeypatch, deltas):
    monkeypatch.setattr(runs, "RANGE_ROWS", 40)
    rng = random.Random(deltas)
    kept, held = table(spark, tmp_path), {}
    for batch in range(9):
        fresh = {f"é{rng.randrange(300):03d}": f"{batch}/{i}" for i in range(rng.choice([0, 5, 90]))}
        kept.add(batch, pairs(spark, fresh), deltas)
        held |= fresh
        kept.add(batch, pairs(spark, {"é000": "replayed"}), deltas)  # added before: does nothing
    asked = [f"é{i:03d}" for i in range(0, 320, 3)]
    got = {r.k: r.value for r in kept.lookup(spark.createDataFrame([(a,) for a in asked], "k string")).collect()}
    assert got == {a: held[a] for a in asked if a in held}
    levels = [r.n for r in kept._published()[2].groupBy("level").agg(F.count_distinct("folder").alias("n")).collect()]
    assert max(levels) < deltas and kept.upto() == 8


def test_a_small_batch_opens_few_ranges(spark, tmp_path, monkeypatch):
    """A million keys in ranges of 5,000, and a batch of 1,000 neighbours."""
    monkeypatch.setattr(runs, "RANGE_ROWS", 5_000)
    kept = table(spark, tmp_path)
    many = spark.range(1_000_000).select(F.format_string("case-%08d", "id").alias("k"), F.col("id").cast("string").alias("value"))
    kept.add(0, many)
    kept.add(1, many.where("id % 1000 = 7"))
    entries = kept._published()[2]
    assert entries.where("folder = 0").count() == 200  # as many tasks wrote it
    batch = spark.range(1000).select(F.format_string("case-%08d", F.col("id") + 432_100).alias("k"))
    opened = kept.runs.ranges(batch, entries)
    assert len(opened) <= 4
    found = kept.lookup(batch)
    assert {f.split("/t/")[1].split("/part")[0] for f in found.inputFiles()} == {f"keys/v={r.folder}/bucket={r.bucket}" for r in opened}
    assert found.count() == 1000 and found.agg(F.max(F.col("value").cast("long"))).first()[0] == 433_099


def landed(spark, tmp_path, rows):
    zone = landing_zone(spark, str(tmp_path))
    zone.cases.publish(0, spark.createDataFrame(rows, S.LANDING_CASES), S.LANDING_CASES.names)
    return zone


def row(identifier, **given):
    return dict.fromkeys(S.LANDING_CASES.names) | {"identifier": identifier, "body": "Labour Court", "partition_date": "2024-01"} | given


def test_a_scan_of_a_month_lists_its_files_only(spark, tmp_path):
    """The list names ten thousand partitions; the folders of all others do not exist, and are not missed."""
    zone = landed(spark, tmp_path, [row("A"), row("B", partition_date="2024-02"), row("C", body="Other")])
    listed = zone.cases._published()[2]
    month = F.date_format(F.add_months(F.lit("1900-01-01").cast("date"), (F.col("id") % 1250).cast("int")), "yyyy-MM")
    ghosts = spark.range(10_000).select(
        F.concat(F.lit("body_"), F.floor(F.col("id") / 1250).cast("string")).alias("zone_body"), month.alias("zone_month"),
        F.concat(F.lit("data/v=0/none/"), F.col("id").cast("string")).alias("path"), F.lit(0).cast("long").alias("folder"),
        F.lit("A").alias("low"), F.lit("C").alias("high"), F.lit(1).cast("long").alias("rows"), F.lit(0).cast("long").alias("v"),
    )
    rows = listed.drop("slot").unionByName(ghosts, allowMissingColumns=True).collect()
    spark.createDataFrame(rows, T.StructType(zone.cases._INDEX.fields[:-1])).write.mode("overwrite").parquet(str(tmp_path / "cases/index/slot=0"))
    assert zone.cases._files(zone.cases._published()[2]).count() == 10_003
    found = zone.cases.scan_months("2024-01", "2024-01", "Labour Court")
    assert [r.identifier for r in found.collect()] == ["A"] and len(found.inputFiles()) == 1
    # 2024 is beyond the ghosts' months, which end in 2004.
    assert zone.cases.month_files("2024-01", "2024-12").count() == 3


def test_a_batch_rewrites_only_the_partitions_it_touches(spark, tmp_path):
    zone = landed(spark, tmp_path, [row("A"), row("B", partition_date="2024-02"), row("C", body="Other")])
    zone.cases.publish(1, spark.createDataFrame([row("A", title="t")], S.LANDING_CASES), S.LANDING_CASES.names)
    files = {(r.zone_body, r.zone_month): r.folder for r in zone.cases._index()[1] if r.zone_body}
    assert files == {("labour_court", "2024-01"): 1, ("labour_court", "2024-02"): 0, ("other", "2024-01"): 0}
    ranges = {(r.low, r.high, r.rows) for r in zone.cases._index()[1] if r.zone_body}
    assert ranges == {("A", "A", 1), ("B", "B", 1), ("C", "C", 1)}


def test_lookup_of_rows(spark, tmp_path):
    zone = landed(spark, tmp_path, [row(f"k{i:02d}", title=str(i), partition_date=f"2024-{i % 12 + 1:02d}") for i in range(40)])
    asked = spark.createDataFrame([("k03",), ("k17",), ("none",)], "identifier string")
    found = zone.cases.lookup(asked)
    assert {r.identifier: r.title for r in found.collect()} == {"k03": "3", "k17": "17"}
    assert sum('/data/' in f for f in found.inputFiles()) == 2


def fold_model(existing, incoming, fields):
    out = {k: dict(v) for k, v in existing.items() if k in {r["k"] for r in incoming}}
    for r in sorted(incoming, key=lambda r: r["seq"]):
        mine = out.setdefault(r["k"], dict.fromkeys(fields))
        for f in r["supplied"] or []:
            if f in mine:
                mine[f] = r[f]
    return out


def test_fields_supplied_per_row_equal_a_sequential_model(spark):
    rng = random.Random(3)
    fields = ["a", "b", "c"]
    existing = {f"k{i}": {f: rng.choice(["old", None]) for f in fields} for i in range(20)}
    incoming = [
        {"k": rng.choice(["hot", f"k{rng.randrange(30)}"]), "seq": seq, "supplied": rng.choice([None, [], rng.sample([*fields, "zz"], 2)])}
        | {f: rng.choice(["x", "y", None]) for f in fields}
        for seq in rng.sample(range(1000), 200)
    ]
    kind = "k string, seq long, supplied array<string>, a string, b string, c string"
    old = spark.createDataFrame([(k, v["a"], v["b"], v["c"]) for k, v in existing.items()], "k string, a string, b string, c string")
    new = spark.createDataFrame([(r["k"], r["seq"], r["supplied"], r["a"], r["b"], r["c"]) for r in incoming], kind).repartition(5)
    got = {r.k: {f: r[f] for f in fields} for r in fold_fields(old, new, "k", "seq", "supplied").collect()}
    assert got == fold_model(existing, incoming, fields)
    plan = fold_fields(old, new, "k", "seq", "supplied")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") > 0


def test_published_fields_move_and_keep(spark, tmp_path):
    zone = landed(spark, tmp_path, [row("A", title="t", file_name="f", file_hash="h", path_to_file="p"), row("B", title="u")])
    kind = T.StructType([*S.LANDING_CASES.fields, T.StructField("seq", T.LongType()), T.StructField("supplied", T.ArrayType(T.StringType()))])
    rows = [
        row("A", title=None) | {"seq": 2, "supplied": ["title"]},
        row("A", partition_date="2024-05", title="early") | {"seq": 1, "supplied": ["partition_date", "title"]},
        row("N", body="New", title="n") | {"seq": 3, "supplied": ["title"]},
    ]
    zone.cases.publish_fields(1, spark.createDataFrame(rows, kind), "seq", "supplied")
    got = {r.identifier: r for r in zone.cases.read().collect()}
    assert (got["A"].title, got["A"].partition_date, got["A"].file_name, got["A"].body) == (None, "2024-05", "f", "Labour Court")
    assert (got["N"].title, got["N"].body, got["N"].partition_date, got["B"].title) == ("n", None, None, "u")
    state = {r.identifier: (r.file_hash, r.zone_month) for r in zone.cases.state(zone.cases.read()).collect()}
    assert state["A"] == ("h", "2024-05") and state["N"] == (None, "unknown")
    zone.cases.publish_fields(1, spark.createDataFrame(rows[:1], kind), "seq", "supplied")  # published before
    assert zone.cases.last_batch() == 1


def case(identifier, seq, html, **given):
    values = dict.fromkeys(S.INCOMING_CASES.names) | {
        "source": "Src", "body": "Labour Court", "identifier": identifier, "partition_date": "2024-01", "content_type": "text/html",
        "link_to_doc": "http://h/d", "seq": seq, "content_html": html,
    }
    return values | given


def test_versions_follow_the_published_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zones, "DELTAS", 2)
    zone = landing_zone(spark, str(tmp_path))
    frame = lambda rows: spark.createDataFrame(rows, S.INCOMING_CASES)
    for batch in range(4):
        land(frame([case("A", 1, f"v{batch}"), case(f"only{batch}", 2, "x")]), zone, batch, T1)
        if batch != 1:  # two batches are caught up at once
            paths = zone.cases.read().select("path_to_file")
            newest = {r.path_to_file.split("/")[-1]: r.version for r in zone.content.versions(paths).collect()}
            assert newest["a.html"] == batch and newest["only0.html"] == 0
    held = zone.content.attach(zone.cases.read().select("identifier", "path_to_file")).collect()
    assert {r.identifier: bytes(r.content) for r in held} == {"A": b"v3"} | {f"only{b}": b"x" for b in range(4)}
    gone = zone.content.unreferenced(zone.cases.read().where("identifier <> 'only2'")).collect()
    assert sorted((r.path_to_file.split("/")[-1], r.v, r.reason) for r in gone) == [("a.html", 0, "replaced"), ("a.html", 1, "replaced"), ("a.html", 2, "replaced"), ("only2.html", 2, "no row")]


def test_a_chain_of_64_attachments(spark, monkeypatch):
    rounds = []
    real = links.stored_count
    monkeypatch.setattr(links, "stored_count", lambda df: (lambda out: rounds.append(out[1]) or out)(real(df)))
    pages_ = [(f"http://h/{i}", "follow", f"http://h/{i + 1}") for i in range(64)] + [("http://h/64", "file", None)]
    got = links.attach_documents(
        spark.createDataFrame([(1, "http://h/0"), (2, "http://h/10"), (3, "http://h/64#x")], "position int, document_url string"),
        spark.createDataFrame(pages_, "url string, route string, follow_url string"), ["position"],
    ).collect()
    assert {r.position: r.final_url for r in got} == {1: None, 2: None, 3: "http://h/64"}
    assert len(rounds) <= 14 and rounds[0] <= 66


def test_land_changes_equal_one_batch(spark, tmp_path):
    """A third of the rows on one identifier, three micro-batches, a replay, and state from before."""
    rng = random.Random(6)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(20)}", i, rng.choice(["A", "B", None]), f"key{i}") for i in range(600)]
    schema = "identifier string, seq long, file_hash string, object_key string"
    state = spark.createDataFrame([("hot", "A", "old"), ("k1", "B", ""), ("k2", None, "old2")], "identifier string, file_hash string, path_to_file string")
    folder, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for part in range(3):
        spark.createDataFrame(rows[part * 200 : part * 200 + 200], schema).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = captures.stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, 100)
        changes.land_changes(stream, folder, ckpt, state, 15).awaitTermination()
    want = changes.detect_changes(spark.createDataFrame(rows, schema), state)
    names = ["identifier", "seq", "scrape_status", "path_to_file"]
    got = changes.read_changes(spark, folder)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, want.select(*names).collect()))
    assert {r.batch for r in got.select("batch").distinct().collect()} == {0, 1, 2}


def test_a_page_of_broken_bytes_fails_alone(spark):
    df = spark.createDataFrame([(1, bytearray(b"<p>x")), (2, bytearray(b"<p>\xc3(\xff")), (3, None)], "id long, raw binary").selectExpr("id", "cast(raw AS string) AS html")
    got = {r.id: (r.cleaned_text, r.error) for r in pages.extract_pages(df, "html", ["cleaned_text"], ["id"]).collect()}
    assert got[1] == ("x", None) and got[3] == (None, None)
    assert got[2][0] is None and got[2][1].startswith("UnicodeDecodeError")


def test_summaries_of_batches_add_up(spark):
    def summary(outcomes):
        rows = [(b, "2024-01", o) for b, o in outcomes]
        return metrics.partition_summary(spark.createDataFrame(rows, "body string, partition_date string, outcome string"))

    batches = [[("A", "stored"), (None, "failed")], [("A", "unchanged"), ("A", "stored")], [("B", "dropped")]]
    parts = [summary(b).withColumn("v", F.lit(v)) for v, b in enumerate(batches)]
    merged = metrics.merged_summaries(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    whole = summary([row for b in batches for row in b])
    names = [c for c in S.RUN_METRICS.names if c != "elapsed_seconds"]
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, merged.select(*names).collect()), key=key) == sorted(map(tuple, whole.select(*names).collect()), key=key)
    assert {r.body: r.runs for r in merged.collect()} == {"A": 2, None: 1, "B": 1}
