import hashlib
import random
from collections import Counter
from zlib import crc32

import edges
from folioflow.llm import sharding


def brute_capacity(sizes, shards):
    """Smallest largest sum of a contiguous partition, by dynamic programming."""
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [0] + [min(max(best[j], total[i] - total[j]) for j in range(i)) for i in range(1, len(sizes) + 1)]
    return best[-1]


def test_capacity_against_dynamic_programming():
    random.seed(6)
    for _ in range(100):
        sizes = [random.randrange(1, 50) for _ in range(random.randrange(1, 25))]
        shards = random.randrange(1, 9)
        assert sharding.smallest_capacity(sizes, shards) == brute_capacity(sizes, shards)


def check(spark, rows, one_shard_groups=True):
    found = sharding.law_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = sorted([(i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t in rows], key=repr)
    assert sorted([(r.doc_id, r["size"], r.text_crc32) for r in found], key=repr) == want
    by = {}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
        by.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in shard) == list(range(len(shard))) for shard in by.values())
    assert all(len({r.shard for r in found if r.text_crc32 == c}) == 1 for c in {r.text_crc32 for r in found})
    return {s: sum(r["size"] for r in shard) for s, shard in by.items()}


def groups(rows):
    size = Counter()
    for _, t in rows:
        size[hashlib.md5((t or "").encode()).hexdigest()] += len((t or "").encode()) + 1
    return [size[k] for k in sorted(size)]


def test_law_is_the_minimax(spark):
    rows = [(i, edges.prose(i % 350, 5 + i % 60)) for i in range(800)]
    held = check(spark, rows)
    assert max(held.values()) == brute_capacity(groups(rows), 8)
    assert min(held.values()) > 0.85 * max(held.values())


def test_a_group_larger_than_a_share_stands_alone(spark):
    rows = [(i, "hot " * 50) for i in range(100)] + [(1000 + i, edges.prose(i, 20)) for i in range(300)]
    held = check(spark, rows)
    hot = 100 * 201
    rest = [v for v in held.values() if v != hot]
    assert hot in held.values() and len(rest) == 7 and max(rest) - min(rest) < 300


def test_cuts_open_few_prefixes(spark, monkeypatch):
    opened = []
    real = sharding._open
    monkeypatch.setattr(sharding, "_open", lambda g, n, which: opened.append(len(which)) or real(g, n, which))
    monkeypatch.setattr(sharding, "STEP", 1)
    rows = [(i, edges.prose(i, 12)) for i in range(3000)]
    held = check(spark, rows[:0] + rows)
    assert max(held.values()) == brute_fill(groups(rows))
    assert max(opened) < 60  # of 3,000 groups


def brute_fill(sizes):
    return sharding.smallest_capacity(sizes, 8)


def test_edge_rows(spark):
    check(spark, [(d, t) for d, t, *_ in edges.ROWS])
    check(spark, [(1, "a")])
    assert sharding.law_bytes(edges.empty(spark)).collect() == []
    assert sharding.law_bytes(edges.clashing(spark)).count() == len(edges.ROWS)


def test_plan_is_native(spark):
    plan = sharding.law_bytes(edges.docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
