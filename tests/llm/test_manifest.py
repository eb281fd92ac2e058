import hashlib
import zlib
from collections import defaultdict

import edges
import pytest
from folioflow.llm import manifest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [None if v is None else str(v) for v in (row[0], row[1], row[2], row[3], text)]
    return digest("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def runs(levels, at):
    for nodes in levels[:-1]:
        yield at % 16, nodes[at // 16 * 16 : at // 16 * 16 + 16]
        at //= 16


def brute(rows):
    """The contract, node by node."""
    held = defaultdict(list)
    for row in rows:
        held[row[1]].append(row)
    order = sorted(held, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        held[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = {s: tree([leaf(r, r[4]) for r in held[s]]) for s in order}
    trunk = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, row in enumerate(held[s]):
            path = [*runs(trees[s], i), *runs(trunk, k)]
            proof = digest("".join(n for place, run in path for j, n in enumerate(run) if j != place))
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(row, text)
            for place, run in path:
                node = digest("".join(run[:place]) + node + "".join(run[place + 1 :]))
            out.append((row[0], leaf(row, row[4]), trees[s][-1][0], trunk[-1][0], proof, node, node == trunk[-1][0]))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    return edges.rows(manifest.manifest(docs, manifest.tampered(), **options).select(*COLUMNS))


def corpus(n, source):
    return [(i * 3 - 20, source(i), "en" if i % 4 else None, None if i % 9 == 0 else i, f"Text {i % 50} ÄB" if i % 11 else None) for i in range(n)]


@pytest.mark.parametrize("height", [1, 2, 3])
def test_against_brute_force(spark, height):
    # A third of all rows in one source, forty small ones (two levels of subroots), sources of one row and none.
    rows = corpus(1500, lambda i: "hot" if i % 3 == 0 else None if i % 7 == 0 else f"s{i % 40}" if i < 1490 else f"one{i}")
    got = found(spark, rows, height=height)
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < 400


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_whole_and_partial_runs(spark, n):
    rows = corpus(n, lambda i: "only")
    assert found(spark, rows, height=1) == brute(rows)


def test_any_change_breaks_the_root(spark):
    rows = corpus(60, lambda i: "ab"[i % 2])
    docs = spark.createDataFrame(rows, SCHEMA)
    root = manifest.manifest(docs).first().root
    assert {r.verified for r in manifest.manifest(docs).collect()} == {True}
    assert {r.verified for r in manifest.manifest(docs, F.concat("text", F.lit("."))).where("doc_id % 11 = 0").collect()} <= {True, False}
    for changed in (rows[1:], rows[:5] + [(*rows[5][:3], 99, rows[5][4])] + rows[6:], [(r[0], "c", *r[2:]) for r in rows]):
        assert manifest.manifest(spark.createDataFrame(changed, SCHEMA)).first().root != root


def test_edge_rows(spark):
    rows = [(d, s, l, len(t) if t else None, t) for d, t, l, s in edges.ROWS]
    assert found(spark, rows) == brute(rows)
    docs = edges.clashing(spark)  # its n_chars is no number
    assert manifest.manifest(docs.withColumn("n_chars", F.lit(1)), manifest.tampered()).count() == len(rows)
    assert manifest.manifest(edges.empty(spark).withColumn("n_chars", F.lit(1))).collect() == []
