import hashlib
import re
from collections import Counter

import edges
import numpy as np
from folioflow.llm import shared, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    least = {}
    for i, w in words:
        for k in range(len(w) - 12):
            run = tuple(w[k : k + 13])
            least[run] = min(least.get(run, order(i)), order(i))
    out = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - 12) if least[tuple(w[k : k + 13])] < order(i) for j in range(13)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def passages():
    shared_text = edges.prose(77, 40)
    rows = [(i, f"{edges.prose(i, i % 11)} {shared_text} {edges.prose(900 + i, 15)}") for i in range(60)]
    rows += [(100 + k, " ".join(shared_text.split()[k : k + 13])) for k in range(20)]  # every alignment
    rows += [(200 + k, " ".join(shared_text.split()[k : k + 12])) for k in range(9)]  # one word short
    rows += [(300, f"{edges.prose(5, 30)} {edges.prose(5, 30)}"), (301, edges.prose(5, 30)), (301, edges.prose(5, 14)), (None, shared_text), (None, shared_text)]
    return rows


def test_difference_cover():
    differences = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert differences == set(range(substring.PERIOD))
    assert substring.ANCHOR + substring.PERIOD - 1 == substring.WINDOW


def test_against_brute_force(spark):
    rows = passages() + [(d, t) for d, t, *_ in edges.ROWS if (d or 0) != 9]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = edges.rows(substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256"))
    assert got == brute(rows)


def test_slices_and_buckets_change_nothing(spark, monkeypatch):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(substring, "SLICE_BYTES", 700)
    monkeypatch.setattr(shared, "BUCKET_BYTES", 100)
    got = edges.rows(substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256"))
    assert got == brute(rows)


def test_gatherings_change_nothing(spark, monkeypatch):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(substring, "SLICE_BYTES", 700)
    for held in (1, 90):
        monkeypatch.setattr(substring, "KEYS_HELD", held)
        got = edges.rows(substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256"))
        assert got == brute(rows)


def test_a_key_of_all_slices_has_one_entry_per_gathering(monkeypatch):
    monkeypatch.setattr(shared, "TOLD_EACH", 7)
    slices = [(np.array([5, 1000 + i], np.uint64), np.zeros(2, np.int64), np.array([[i, i]])) for i in range(500)]
    for limit, gatherings in ((1 << 20, 1), (100, 10)):
        entries = Counter()
        for batch in shared.pack_slices(iter(slices), 9, limit):
            for bucket, lo in zip(*[batch.column(c).to_pylist() for c in ("bucket", "lo")]):
                entries[bucket >= 0] += len(shared._unpack(lo))
                assert bucket >= 0 or len(shared._unpack(lo)) <= 7
        # The hot key once a gathering and each other key; an answer for each row of the hot key.
        assert entries == {True: 500 + gatherings, False: 500}


def test_edge_rows(spark):
    found = substring.remove_repeats(edges.clashing(spark), with_text=True).collect()
    assert len(found) == len(edges.ROWS)
    assert {r.n_removed for r in found if r.doc_id == 2} == {60}
    assert substring.remove_repeats(edges.empty(spark)).collect() == []
