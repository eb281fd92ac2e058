"""Normalisation, change detection and upsert against sequential models."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.operators import cases, metrics, upsert


def case(seq, **given):
    row = dict.fromkeys(S.INCOMING_CASES.names)
    row.update(seq=seq, source="Src", body="Labour Court", partition_date="2024-01")
    row.update(given)
    return row


def test_normalize_cases(spark):
    rows = [
        case(1, identifier=" A\t1 ", title="  ", record_date="1/2/2024", body=" Labour \n Court"),
        case(2, identifier="123", source_page_url="http://h/x/slug.html", title=" T  1 "),
        case(3, title=" T \xa0 1 ", description="\n"),
        case(4, identifier=" ", record_date="soon"),
    ]
    df = spark.createDataFrame(rows, S.INCOMING_CASES)
    got = {r.seq: r for r in cases.normalize_cases(df).collect()}
    assert [got[i].identifier for i in (1, 2, 3, 4)] == ["A 1", "SLUG", "T 1", None]
    assert got[1].body == "Labour Court" and got[1].title is None
    assert got[1].record_date == "2024-02-01" and got[4].record_date == "soon"
    assert got[3].description is None


def test_prepare_splits_off_rejects(spark):
    rows = [case(1, identifier="A", content_html="x"), case(2), case(3, identifier="B")]
    df = spark.createDataFrame(rows, S.INCOMING_CASES).withColumn(
        "error", F.when(F.col("seq") == 3, "ValueError: bad")
    )
    prepared = cases.prepare_cases(df)
    assert not {"content_bytes", "content_html", "error"} & set(prepared.columns)
    assert [r.identifier for r in cases.valid(prepared).collect()] == ["A"]
    bad = {r.seq: (r.outcome, r.reason) for r in cases.rejected(prepared).collect()}
    assert bad == {2: ("dropped", "no identifier"), 3: ("failed", "ValueError: bad")}


def model(incoming, existing):
    state = dict(existing)
    out = []
    for identifier, seq, file_hash, key in sorted(incoming, key=lambda r: r[1]):
        known = state.get(identifier)
        if known and known[0] == file_hash and known[1]:
            status, path = "unchanged", known[1]
        else:
            status, path = "stored", key
        state[identifier] = (file_hash, path)
        out.append((identifier, seq, status, path))
    return sorted(out)


def frames(spark, incoming, existing):
    return (
        spark.createDataFrame(
            incoming, "identifier string, seq long, file_hash string, object_key string"
        ),
        spark.createDataFrame(
            [(k, *v) for k, v in existing.items()],
            "identifier string, file_hash string, path_to_file string",
        ),
    )


def detected(spark, incoming, existing, **options):
    rows = cases.detect_changes(*frames(spark, incoming, existing), **options)
    got = rows.select("identifier", "seq", "scrape_status", "path_to_file").collect()
    return sorted(tuple(r) for r in got)


@pytest.mark.parametrize(
    "hashes, existing",
    [
        ("AA", {}),
        ("ABA", {}),
        ("A", {"k": ("A", "old")}),
        ("AAB", {"k": ("A", "old")}),
        ("A", {"k": ("B", "old")}),
        ("A", {"k": (None, "old")}),
        ("AA", {"k": ("A", "")}),
        ("AA", {"k": ("A", None)}),
        (["A", None, "A"], {}),
        ([None, None], {"k": (None, "old")}),
        ([None], {"k": (None, "")}),
    ],
)
def test_small_changes(spark, hashes, existing):
    incoming = [("k", i, h, f"key{i}") for i, h in enumerate(hashes)]
    want = model(incoming, existing)
    assert detected(spark, incoming, existing) == want
    assert detected(spark, incoming, existing, rows_per_group=1) == want


@pytest.mark.parametrize("rows_per_group", [1, 7, 50, 10_000])
def test_changes_equal_the_sequential_model(spark, rows_per_group):
    rng = random.Random(rows_per_group)
    seqs = rng.sample(range(-5_000, 100_000), 1500)
    # One key holds a third of all rows.
    keys = ["hot" if rng.random() < 0.34 else f"k{rng.randrange(120)}" for _ in seqs]
    incoming = [(k, s, rng.choice(["A", "B", "C", None]), f"{k}/{s}") for k, s in zip(keys, seqs)]
    existing = {
        k: (rng.choice(["A", "B", None]), rng.choice(["", None, f"old/{k}"]))
        for k in [*(f"k{i}" for i in range(80)), "hot", "other"]
    }
    got = detected(spark, incoming, existing, rows_per_group=rows_per_group)
    assert got == model(incoming, existing)


def test_hot_key_is_spread_over_ranges(spark):
    incoming = [("hot", i, "A", f"k{i}") for i in range(1000)]
    df, _ = frames(spark, incoming, {"x": ("A", "p")})
    ranged = cases._seq_ranges(df, 100).groupBy("_range").count().collect()
    assert len(ranged) >= 10 and max(r["count"] for r in ranged) <= 150


@pytest.mark.parametrize("rows", [10_000, 999])
def test_an_outlier_does_not_fill_a_range(spark, rows):
    """Gaps of 2^33 between parts and one row far out, on a hot identifier among others."""
    seqs = [i + (i % 3 << 33) for i in range(rows - 1)] + [1 << 50]
    incoming = [("hot", s, "AB"[s % 2], f"k{s}") for s in seqs] + [(f"k{i % 40}", i, "A", f"c{i}") for i in range(800)]
    df, _ = frames(spark, incoming, {"x": ("A", "p")})
    sizes = {tuple(r)[:2]: r["count"] for r in cases._seq_ranges(df, 100).groupBy("identifier", "_range").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert sum(hot) == rows and max(hot) <= 300 and len(hot) >= rows / 300
    assert {r for k, r in sizes if k != "hot"} == {0}
    assert detected(spark, incoming, {"hot": ("A", "old")}, rows_per_group=100) == model(incoming, {"hot": ("A", "old")})


def test_status_and_path_of_a_moved_case(spark):
    """Unchanged content keeps the key of its old month."""
    rows = [case(1, identifier="A", content_html="x", partition_date="2024-02", content_type="text/html")]
    prepared = cases.valid(cases.prepare_cases(spark.createDataFrame(rows, S.INCOMING_CASES)))
    file_hash = prepared.first().file_hash
    _, state = frames(spark, [("q", 1, "", "")], {"A": (file_hash, "Src/labour_court/2024-01/a.html")})
    row = cases.detect_changes(prepared, state).first()
    assert (row.scrape_status, row.path_to_file) == ("unchanged", "Src/labour_court/2024-01/a.html")
    assert row.object_key == "Src/labour_court/2024-02/a.html"


def test_upsert_semantics(spark):
    old = spark.createDataFrame(
        [("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)], "k string, n int, note string"
    )
    new = spark.createDataFrame([("a", None), ("d", 4)], "k string, n int")
    got = {r.k: (r.n, r.note) for r in upsert.upsert(old, new, "k", ["n"]).collect()}
    assert got == {"a": (None, "x"), "b": (2, "y"), "c": (3, None), "d": (4, None)}


def test_upsert_equals_set_model(spark):
    rng = random.Random(3)
    state = {f"k{i}": {"a": i, "b": i, "c": i} for i in range(40)}
    schema = "k string, a int, b int, c int"
    table = spark.createDataFrame([(k, v["a"], v["b"], v["c"]) for k, v in state.items()], schema)
    batch = [
        (f"k{rng.randrange(60)}", seq, rng.choice([None, seq]), rng.choice([None, -seq]))
        for seq in range(200)
    ]
    for k, _, a, b in batch:
        state.setdefault(k, {"a": None, "b": None, "c": None}).update(a=a, b=b)
    incoming = spark.createDataFrame(batch, "k string, seq long, a int, b int")
    got = upsert.upsert_latest(table, incoming, "k", "seq", ["a", "b"])
    assert {r.k: {"a": r.a, "b": r.b, "c": r.c} for r in got.collect()} == state


def test_counters(spark):
    rows = [("b", "2024-02", o) for o in ["stored", "stored", "unchanged", "failed", "dropped"]]
    landed = spark.createDataFrame([*rows, ("c", "unknown", "stored")], "body string, partition_date string, outcome string")
    got = {r.body: r.asDict() for r in metrics.landing_counters(landed, ["body"]).collect()}
    assert got["b"] == {"body": "b", "stored": 2, "unchanged": 1, "failed": 1, "dropped": 2, "success": False}
    assert got["c"]["success"] is True

    done = spark.createDataFrame(
        [("b", "2024-02", o) for o in ["ok", "skipped", "failed"]] + [("d", "2024-03", "ok")],
        landed.schema,
    )
    result = metrics.transform_result(done, "2024-01", "2024-03").first()
    assert tuple(result) == ("2024-01", "2024-03", 3, 1)
    summary = metrics.partition_summary(landed, done, elapsed_seconds=2.0)
    assert summary.columns == S.RUN_METRICS.names
    assert [f.dataType for f in summary.schema] == [f.dataType for f in S.RUN_METRICS]
    got = {r.body: r for r in summary.collect()}
    assert str(got["b"].end_date) == "2024-02-29" and got["b"].processed == 2
    nothing = spark.createDataFrame([(None, None, "stored"), (None, None, "ok")], landed.schema)
    whole = metrics.partition_summary(nothing.where("outcome = 'stored'"), nothing.where("outcome = 'ok'"), nothing)
    assert [(r.stored, r.processed, r.pages_scraped) for r in whole.collect()] == [(1, 1, 2)]
    assert got["b"].transform_failed == 1 and got["c"].start_date is None and got["d"].stored == 0


def test_statistics(spark):
    exported = spark.createDataFrame(
        [
            (0, '{"landing_pipeline/stored": 3, "elapsed_time_seconds": 1.5, "finish": "2024-01-01 00:00:00"}'),
            (1, "{}"),
            (2, "broken"),
        ],
        "return_code int, json string",
    )
    got = metrics.read_statistics(exported, "json", "return_code").orderBy("return_code").collect()
    assert (got[0].stored, got[0].elapsed_seconds, got[0].unchanged, got[0].success) == (3, 1.5, 0, True)
    assert got[0].raw_stats["finish"] == "2024-01-01 00:00:00" and got[1].raw_stats == {}
    assert (got[1].stored, got[1].success) == (0, False) and got[2].dropped == 0
    named = metrics.export_statistics(spark.sql("SELECT 3L AS stored, DATE '2024-01-01' AS day"))
    assert named.first().statistics == '{"landing_pipeline/stored":3,"day":"2024-01-01"}'
