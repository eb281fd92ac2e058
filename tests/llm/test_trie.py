import hashlib
import random
import zlib
from collections import defaultdict

import edges
import numpy as np
import pytest
from folioflow.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def brute(rows):
    """Nodes as sequences of turns."""
    convs = rebuild(rows)
    held = defaultdict(list)
    for c, ts in sorted(convs.items()):
        for d in range(len(ts) + 1):
            held[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in held:
        if node:
            children[node[:-1]].append(node)
    out, leaves, saved = [], {}, {}
    for node in sorted(held, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[n] for n in below) if below else 1
        last = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[n] for n in below) + (len(held[node]) - 1) * last
        ends = ",".join(str(c) for c in held[node] if len(convs[c]) == len(node))
        parent = held[node[:-1]][0] if node else None
        out.append((held[node][0], len(node), parent, len(held[node]), len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return edges.rows(trie.prefix_trie(frame, **options).select(*COLUMNS))


def forest(n, seed=0):
    """Conversations with shared beginnings of every depth, copies, gaps in ids and long ones."""
    rng = random.Random(seed)
    rows, kept = [], []
    for i in range(n):
        turns = list(rng.choice(kept)) if kept and rng.random() < 0.6 else [("user", "hello")] if i % 3 else []
        turns = turns[: rng.randrange(0, len(turns) + 1)] if rng.random() < 0.5 else turns
        turns = turns + [(rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "ccc", str(rng.random())])) for _ in range(rng.randrange(0, 6))]
        kept.append(turns)
        c = i * 2 + (i % 7 == 0)
        rows += [(c, 3 * t, role, text) for t, (role, text) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("options", [{}, {"most": 3, "size": 2}, {"most": 16, "size": 4, "most_turns": 20}])
def test_against_brute_force(spark, options):
    rows = forest(250)
    assert found(spark, rows, **options) == brute(rows)


def test_hot_prefix_and_copies(spark):
    rows = [(c, t, "user", f"shared {t}") for c in range(400) for t in range(12 if c % 3 else 9)]
    rows += [(c, 12, "user", f"own {c}") for c in range(0, 400, 2)]
    assert found(spark, rows, most=32, size=5) == brute(rows)


def test_a_long_conversation_is_many_segments(spark):
    rows = [(1005, t, "user", f"turn {t}") for t in range(3000)] + [(c, t, "user", f"turn {t}") for c in (1006, 1007, 1030) for t in range(c - 700)] + forest(20)
    assert found(spark, rows, size=64) == brute(rows)


def test_nulls_ties_and_empty_turns(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, -3, "user", ""),
        (5, 1, "user", "x"), (6, 1, "user", "x"), (10, 0, "a", "b"), (-7, 0, "user", "n"), (-7, 1, "user", "m"),
        (2**62, 0, "user", "x"), (None, 0, "user", "lost"), (11, 0, "", None), (12, 0, None, ""),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    long = [(1, 0, "user", "z" * 3_000_000), (2, 0, "user", "z" * 3_000_000)]
    assert found(spark, long) == brute(long)


def test_other_columns_do_not_matter(spark):
    rows = forest(40)
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = frame.selectExpr("*", *[f"'x' AS {c}" for c in ("pos", "lo", "hi", "bytes", "segment", "depth", "before", "_range", "_local", "h", "base", "lead")])
    assert edges.rows(trie.prefix_trie(clashing).select(*COLUMNS)) == brute(rows)


def test_bitsets():
    rng = np.random.default_rng(4)
    for n in (1, 7, 8, 9, 130):
        mask = rng.random(n) < 0.4
        bits = trie.bitset(mask)
        assert trie.members(bits, n).tolist() == np.flatnonzero(mask).tolist()
        assert not mask.any() or trie.lowest(bits) == int(np.flatnonzero(mask)[0])
