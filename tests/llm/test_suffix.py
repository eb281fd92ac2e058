import hashlib
import time
from collections import Counter

import edges
import numpy as np
import pytest
from folioflow.llm import bytesdup, common, suffixes
from pyspark.sql import functions as F


def cases():
    rng = np.random.default_rng(1)
    for _ in range(200):
        strings = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 60)).astype(np.uint8)) for _ in range(rng.integers(1, 5))]
        yield strings + [strings[0]] * int(rng.integers(0, 2)), int(rng.integers(1, 20))


def test_suffix_array_orders_by_depth():
    for strings, depth in cases():
        text = b"".join(strings)
        order = suffixes.suffix_array(np.frombuffer(text, np.uint8), depth)
        beginnings = [text[i : i + depth] for i in order]
        assert sorted(order.tolist()) == list(range(len(text))) and beginnings == sorted(beginnings)


def test_repeats_against_counting():
    for strings, length in cases():
        text = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.array([len(s) for s in strings])
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(text))
        order, same = suffixes.repeats(text, left, length)
        got = np.zeros(len(text), bool)
        got[order[same]] = True
        got[order[:-1][same[1:]]] = True
        raw = bytes(text)
        count = Counter(raw[i : i + length] for i in range(len(raw)) if left[i] >= length)
        assert got.tolist() == [left[i] >= length and count[raw[i : i + length]] > 1 for i in range(len(raw))]


def brute(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + 200] for _, b in raw for k in range(len(b) - 199))
    out = []
    for i, b in raw:
        mark = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                mark[k] += 1
                mark[k + 200] -= 1
        gone = np.cumsum(mark[:-1]) > 0
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows():
    passage = edges.prose(77, 80)
    out = [(i, f"{edges.prose(i, 40 + i)} {passage} {edges.prose(500 + i, 45)}") for i in range(25)]
    out += [(100 + k, passage[k : k + 200]) for k in range(0, 60, 7)] + [(200, passage[:199]), (201, "a" * 900), (202, "ab" * 400), (203, "b" + "a" * 300)]
    out += [(300, f"{edges.prose(5, 60)} {edges.prose(5, 60)}"), (None, edges.prose(6, 60)), (None, edges.prose(6, 60)), (301, "é" * 150 + edges.prose(8, 50)), (302, "é" * 150)]
    return out + [(d, t) for d, t, *_ in edges.ROWS if (d or 0) not in (9, 10)]


NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("split", [4096, 2])
def test_against_brute_force(spark, monkeypatch, split):
    monkeypatch.setattr(bytesdup, "SPLIT_ROWS", split)  # 2: nearly every shared anchor is dealt to several shards
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(6)
    assert edges.rows(bytesdup.remove_repeats(docs).select(*NAMES)) == brute(rows())


def test_edge_rows(spark):
    found = bytesdup.remove_repeats(edges.clashing(spark)).collect()
    assert len(found) == len(edges.ROWS)
    whole = [r for r in found if r.doc_id == 10][0]  # one byte over and over
    assert (whole.n_bytes, whole.n_removed, whole.n_spans) == (300_000, 300_000, 1)
    assert bytesdup.remove_repeats(edges.empty(spark)).collect() == []


def test_sliding_least():
    values = np.random.default_rng(3).integers(0, 1000, 237).astype(np.uint64)
    for width in (1, 2, 101, 237):
        want = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert bytesdup.sliding_least(values, width).tolist() == want


def test_shared_strings_of_many_lists():
    rng = np.random.default_rng(5)
    lists = []
    for _ in range(60):
        keys = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 40, 30), rng.integers(0, 6, 30))})
        lists.append(tuple(np.array(c, np.uint64) << np.uint64(60) | np.array(c, np.uint64) for c in zip(*keys)))
    pairs = [p for lo, hi in lists for p in zip(lo.tolist(), hi.tolist())]
    count = Counter(pairs)
    assert bytesdup.shared_strings(lists).tolist() == [count[p] > 1 for p in pairs]


def test_merge_of_many_parts_is_fast():
    keys = [np.sort(np.random.default_rng(1).integers(0, 1 << 63, 50).astype(np.uint64)) for _ in range(1)][0]
    began = time.perf_counter()
    found = bytesdup.shared_strings([(keys, keys)] * 16_000)
    assert found.all() and time.perf_counter() - began < 2


def test_equal_spans():
    strings = [b"x" * 210, b"ab" * 120, b"x" * 210, b"x" * 211, b"ab" * 120, b"x" * 210]
    sizes = np.array([len(x) for x in strings])
    first, times = bytesdup._equal_spans(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert first.tolist() == [0, 1, 0, 3, 1, 0] and times.tolist() == [3, 2, 3, 1, 2, 3]


def test_rows_that_share_half_a_key_stay_apart(spark, monkeypatch):
    whole = common.row_key
    monkeypatch.setattr(common, "row_key", lambda: whole().withField("a", F.lit(7).cast("long")).alias("row_key"))
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(6)
    assert edges.rows(bytesdup.remove_repeats(docs).select(*NAMES)) == brute(rows())
