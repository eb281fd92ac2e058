import random
import re

import edges
import numpy as np
import xxhash
from folioflow.llm import components, simhash


def brute_print(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_classes(prints, bits=4):
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= bits and root(a) != root(b):
                label[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in prints}


def check(got, rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    classes = brute_classes({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[classes[p]] = min(least.get(classes[p], i), i)
    assert got == sorted([(i, f"{p:016x}", least.get(classes[p])) for i, p in prints], key=repr)


def near(number, copies):
    """Copies of a long text that differ in one word each."""
    words = edges.prose(number, 400).split()
    return [" ".join([*words[: k * 7], f"w{number}x{k}", *words[k * 7 + 1 :]]) for k in range(copies)]


def test_classes_against_brute_force(spark):
    rows = [(d, t) for d, t, *_ in edges.ROWS]
    rows += [(1000 + 100 * g + k, t) for g in range(4) for k, t in enumerate(near(20 + g, 30))]
    rows += [(2000 + i, " ".join(edges.WORDS[(i >> b) & 1] for b in range(6))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(edges.rows(simhash.classes(docs)), rows)
    assert simhash.classes(edges.empty(spark)).collect() == []


def test_links_connect_what_brute_force_connects(spark):
    random.seed(4)
    centres = [random.getrandbits(64) for _ in range(40)]
    prints = {c ^ sum(1 << b for b in random.sample(range(64), random.randrange(0, 5))) for c in centres for _ in range(25)} | {0, 2**64 - 1, 15, 31}
    want = brute_classes(prints)
    rows = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    frame = spark.createDataFrame(rows, "fp long").repartition(4)
    for blocks in (1, 2):
        links = simhash.links(frame, 4, blocks)
        label = {p: p for p in prints}
        as_int = lambda x: int(np.int64(x).view(np.uint64))
        found = [(as_int(r.a), as_int(r.b)) for r in links.collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in found)
        for a, b in found:
            x, y = label[a], label[b]
            if x != y:
                label = {p: min(x, y) if v in (x, y) else v for p, v in label.items()}
        assert label == want


def test_a_large_cell_gives_a_forest(spark):
    prints = np.unique(np.array([1 << a | 1 << b for a in range(32) for b in range(32)], np.uint64))
    left, right = simhash._forest(prints, 4)
    assert len(left) == len(prints) - 1
    assert (np.bitwise_count(left ^ right) <= 4).all()


def test_components_of_paths_stars_and_rings(spark):
    path = [(i, i + 1) for i in range(0, 70)]
    star = [(500, i) for i in range(501, 560)]
    ring = [(1000 + i, 1000 + (i * 7 + 7) % 49) for i in range(49)]
    links = spark.createDataFrame([*path, *star, *ring, (9000, 9000)], "a long, b long")
    found = {r.node: r.component for r in components.components(links, "a", "b").collect()}
    assert all(found[i] == 0 for i in range(71)) and all(found[i] == 500 for i in range(500, 560))
    assert all(found[1000 + i] == min(1000 + j for j in range(i % 7, 49, 7)) or found[1000 + i] == 1000 for i in range(49))
    assert components.components(links.limit(0), "a", "b").collect() == []


def test_deduplicate_keeps_the_least_row_whole(spark):
    docs = edges.clashing(spark)
    kept = simhash.deduplicate(docs)
    assert kept.schema.names == docs.schema.names
    classes = {}
    for r in simhash.classes(docs).collect():
        classes.setdefault(r.component_id, []).append(r.doc_id)
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted(classes, key=repr)
    assert set(map(repr, edges.rows(kept))) <= set(map(repr, edges.rows(docs)))


def test_a_hot_cell_is_compared_in_blocks(spark, monkeypatch):
    """A family around one fingerprint holds a third of all: no group compares more than two blocks, and no link is lost."""
    random.seed(8)
    centre = random.getrandbits(64)
    family = {centre ^ sum(1 << b for b in random.sample(range(64), k)) for k in (1, 2, 3) for _ in range(150)}
    prints = list(family | {random.getrandbits(64) for _ in range(900)})
    frame = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints], "fp long").repartition(4)
    want = brute_classes(set(prints))
    groups = []
    real = simhash.C.map_arrow

    def seen(df, step, schema):
        if "cell" in df.columns:
            groups.append(df.groupBy("cell").count().agg({"count": "max"}).first()[0])
        return real(df, step, schema)

    monkeypatch.setattr(simhash.C, "map_arrow", seen)
    found = simhash.links(frame, most=40).collect()
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a, b in ((r.a % (1 << 64), r.b % (1 << 64)) for r in found):
        assert (a ^ b).bit_count() <= 4
        label[max(root(a), root(b))] = min(root(a), root(b))
    assert {p: root(p) for p in prints} == want
    assert groups[0] > 40 and groups[1] <= 2 * 40


def test_cells_handed_on_whatever_the_batches(spark):
    """Numbers of a large cell go on over batches; small cells around it are compared."""
    rng = np.random.default_rng(2)
    cells = np.sort(np.concatenate([np.full(95, 7), np.repeat(np.arange(20), 3)])).astype(np.int64)
    prints = rng.integers(0, 4, len(cells)).astype(np.int64)
    for size in (1, 13, 40, 200):
        batches = [simhash.pa.RecordBatch.from_arrays([simhash.pa.array(cells[i : i + size]), simhash.pa.array(prints[i : i + size])], ["cell", "fp"]) for i in range(0, len(cells), size)]
        out = [b for b in simhash._links(2, 10)(iter(batches))]
        late = [(c, p, n) for b in out for c, p, n in zip(*[x.to_pylist() for x in b.columns]) if n is not None]
        assert [n for _, _, n in late] == [i // 10 for i in range(98)] and {c for c, _, _ in late} == {7}
        assert [p for _, p, _ in late] == prints[cells == 7].tolist()
