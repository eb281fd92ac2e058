import random

import edges
import numpy as np
import pyarrow as pa
from folioflow.llm import tiling

ITEMS = [(1, edges.prose(501, 30)), (2, edges.prose(502, 12)), (3, "too short"), (4, None), (None, edges.prose(503, 20)), (5, edges.prose(501, 30))]
SCHEMA = "item_id long, text string"


def benchmark(spark):
    return spark.createDataFrame(ITEMS, SCHEMA)


def brute_tiles(document, item, least):
    """Greedy string tiling by trying every pair of places for the longest unmarked match."""
    free_d, free_i, out = [True] * len(document), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(document)):
                n = 0
                while i + n < len(item) and d + n < len(document) and free_i[i + n] and free_d[d + n] and item[i + n] == document[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        if best[0] < least:
            return sum(n for n, _, _ in out)
        n, i, d = best
        free_i[i : i + n], free_d[d : d + n] = [False] * n, [False] * n
        out.append(best)


def test_tiles_against_brute_force():
    random.seed(2)
    for _ in range(300):
        item = [random.randrange(4) for _ in range(random.randrange(1, 25))]
        document = [random.randrange(4) for _ in range(random.randrange(1, 40))]
        if random.random() < 0.5:
            document += item[len(item) // 2 :] + item[: len(item) // 2]
        found = tiling.tiles(document, item, 3)
        assert all(document[d : d + n] == item[i : i + n] and n >= 3 for d, i, n in found)
        used = [p for _, i, n in found for p in range(i, i + n)]
        assert len(used) == len(set(used))
        assert abs(len(used) - brute_tiles(document, item, 3)) <= 3  # falling lengths are visited by halves


def flags(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in tiling.contamination(docs, benchmark(spark)).collect()}


def test_whole_reordered_partial_and_clean(spark):
    words = ITEMS[0][1].split()
    around = edges.prose(600, 50)
    reordered = " ".join([*words[20:], "x", *words[10:20], "y", *words[:10]])
    found = flags(
        spark,
        [
            f"{around} {ITEMS[0][1]} {around}",
            f"{around} {ITEMS[0][1].upper().replace(' ', ', ')}!",
            reordered,
            f"{around} {' '.join(words[:10])} {around}",  # a third only
            around,
            "too short",
            " ".join(w for word in words for w in (word, "gap")),
        ],
    )
    assert [found[i].contaminated for i in range(7)] == [True, True, True, False, False, False, False]
    assert found[0].best_item == 1 and found[0].items == [1, 5] and found[0].coverage == 1.0


def test_blocks_give_the_same(spark, monkeypatch):
    docs = edges.docs(spark).union(spark.createDataFrame([(70 + i, f"{edges.prose(i, 9)} {t}", "en", "a") for i, (_, t) in enumerate(ITEMS) if t], edges.SCHEMA))
    whole = edges.rows(tiling.contamination(docs, benchmark(spark)))
    monkeypatch.setattr(tiling, "BLOCK_WORDS", 20)
    assert edges.rows(tiling.contamination(docs, benchmark(spark))) == whole
    assert sum(r[1] for r in whole) == 4  # the two short texts aside


def test_edge_rows(spark):
    docs = edges.clashing(spark)
    assert tiling.contamination(docs, benchmark(spark)).where("contaminated").count() == 0
    kept = tiling.decontaminate(docs, benchmark(spark))
    assert kept.schema.names == docs.schema.names and edges.rows(kept) == edges.rows(docs)
    none = spark.createDataFrame([], SCHEMA)
    assert edges.rows(tiling.decontaminate(docs, none)) == edges.rows(docs)
    assert tiling.contamination(edges.empty(spark), benchmark(spark)).collect() == []


def test_scripts_without_blanks_and_their_punctuation(spark):
    items = [(1, "天地玄黄宇宙洪荒日月盈昃辰宿列张"), (2, "ภาษาไทยไม่มีช่องว่างระหว่างคำ"), (3, "いろはにほへと、ちりぬるを。わかよたれそ"), (4, "« één » – deux… trois “quatre” cinq")]
    texts = ["前言" + items[0][1] + "后记", "ก" + items[1][1] + "ข", "古い歌：" + items[2][1].replace("、", " ") + "！", "een éen één deux trois quatre, cinq", "天地人和", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.items for r in tiling.contamination(docs, spark.createDataFrame(items, SCHEMA)).collect()}
    assert found == {0: [1], 1: [2], 2: [3], 3: [4], 4: [], 5: []}


def test_words_of_mixed_scripts():
    words, first = tiling.word_ids(pa.array(["abc中文d", "中", "", "é、é", "É😀", "abc 中 文 d"]))
    assert first.tolist() == [0, 4, 5, 5, 7, 8, 12]
    assert words[:4].tolist() == words[8:].tolist() and words[1] == words[4] and words[5] == words[6]


def test_many_blocks_are_taken_one_after_the_other(spark, monkeypatch):
    """Fifty blocks: the rows are read by no Python node, and each block had one of its own."""
    items = [(i, edges.prose(900 + i, 12)) for i in range(400)]
    docs = spark.createDataFrame([(i, f"{edges.prose(i, 20)} {items[i * 7][1]} {items[i * 7 + 3][1]}") for i in range(40)] + [(99, edges.prose(5000, 60)), (100, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items, SCHEMA)
    whole = edges.rows(tiling.contamination(docs, bench))
    monkeypatch.setattr(tiling, "BLOCK_WORDS", 90)
    assert len(list(tiling.blocks(bench))) >= 50
    plans = []
    real = tiling.stored
    monkeypatch.setattr(tiling, "stored", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    found = tiling.contamination(docs, bench)
    assert edges.rows(found) == whole and sum(r[1] for r in whole) == 40
    assert all(p.count("MapInArrow") <= 1 for p in plans) and sum(p.count("MapInArrow") for p in plans) >= 50
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_short_items_are_listed(spark):
    bench = spark.createDataFrame([(1, "one two"), (2, "one two three four five"), (3, None), (4, "")], SCHEMA)
    assert sorted((r.item_id, r.n_words) for r in tiling.not_searched(bench).collect()) == [(1, 2), (3, 0), (4, 0)]


def test_contamination_against_brute_force(spark):
    """The whole query: every pair of a document and an item tiled, seeds or not."""
    rng = np.random.default_rng(11)
    vocabulary = np.array(edges.WORDS)
    items = [(i if i else None, " ".join(vocabulary[rng.integers(0, 16, rng.integers(3, 30))])) for i in range(25)]
    texts = []
    for i in range(60):
        parts = [items[k][1].split() for k in rng.integers(0, 25, 2)]
        words = [w for part in parts for w in part[: rng.integers(1, len(part) + 1)]] + list(vocabulary[rng.integers(0, 16, 10)])
        texts.append((i, " ".join(words) if i % 9 else None))
    texts += texts[:5]
    want = []
    for doc, text in texts:
        own = []
        for number, item in items:
            ids = lambda t: (tiling.word_ids(pa.array([t]))[0] & np.uint64((1 << 60) - 1)).tolist()
            wanted = ids(item)
            if len(wanted) >= tiling.SEED and text:
                share = sum(n for _, _, n in tiling.tiles(ids(text), wanted)) / len(wanted)
                if share >= tiling.THRESHOLD:
                    own.append((-share, tiling.C.NO_ID if number is None else number))
        want.append((doc, bool(own), len(own), sorted(n for _, n in own), min(own)[1] if own else None, -min(own)[0] if own else 0.0))
    got = tiling.contamination(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, SCHEMA))
    fix = lambda r: (*r[:4], None if r[4] == tiling.C.NO_ID else r[4], round(r[5], 9))
    assert sorted(map(fix, edges.rows(got)), key=repr) == sorted(map(fix, want), key=repr)
