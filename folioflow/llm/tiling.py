"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits in lower case, parted by blanks and by the punctuation of any script; in scripts
written without blanks every code point is a word. A document and a benchmark item meet if they share
a seed of `SEED` words. Such pairs are tiled: the longest unmarked words that run alike in both, found by
running Karp-Rabin over falling lengths, are marked again and again, never twice the same word. A document is
contaminated if tiles of at least `SEED` words cover at least `THRESHOLD` of an item's words; the order of
the tiles in the document does not matter, so reordered passages count.

Items go to the tasks in blocks of at most about `BLOCK_WORDS` words, whatever the size of the benchmark: one block after the
other, each with a scan of the documents and a written table of what it found, so that a task holds one block. Those tables
have a row per contaminated text. They are joined to the documents by 128 bits of the text: while small they are broadcast by
their measured size, and no text is shuffled; else Spark splits the join where a text has many copies.

Edge cases: null text and null items have no words; an item of fewer than `SEED` words matches nothing
(`not_searched` lists them); of items covered alike the smallest item_id is named, null last; repeated rows get a row each; with an
empty benchmark nothing is contaminated; an empty table gives an empty table; other columns are carried
if asked for.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm import common as C
from folioflow.session import stored

SEED = 5
THRESHOLD = 0.6
BLOCK_WORDS = 2_000_000
PRIME = (1 << 61) - 1
RADIX = 1_000_003

FIELDS = "items array<long>, best_item long, coverage double"
_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_BETWEEN = ~(((_LOWER >= 97) & (_LOWER <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57)) | (_BYTES >= 0x80))
# Code points of scripts written without blanks: first and last of a range.
_UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029),
    (0x3031, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
]
BETWEEN, WORD, ALONE = 0, 1, 2


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """BETWEEN, WORD or ALONE of every code point from 0x80 on."""
    out = np.full(0x200000, WORD, np.uint8)
    for first, last in _UNSPACED:
        out[first : last + 1] = ALONE
    for point in range(0x80, 0x20000):  # no punctuation beyond
        if unicodedata.category(chr(point))[0] in "PZ" or 0x80 <= point < 0xA0:
            out[point] = BETWEEN
    return out


def _word_bounds(data: np.ndarray, offsets: np.ndarray):
    """As `common.word_bounds`, with the kinds of all code points."""
    leads = np.flatnonzero(data >= 0xC0)
    if not len(leads):
        return C.word_bounds(data, offsets, _BETWEEN)
    kind = np.where(_BETWEEN, BETWEEN, WORD).astype(np.uint8)[data]
    lead = data[leads].astype(np.int32)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & (0x7F >> size)
    last = len(data) - 1
    for i in range(1, 4):
        more = size > i
        point = np.where(more, (point << 6) | (data[np.minimum(leads + i, last)] & 0x3F), point)
    found = _kinds()[point]
    for i in range(4):
        more = (size > i) & (leads + i <= last)
        kind[leads[more] + i] = found[more]
    begins = kind != BETWEEN
    inside = begins.copy()
    begins[1:] &= ~inside[:-1] | (((data[1:] & 0xC0) != 0x80) & ((kind[1:] == ALONE) | (kind[:-1] == ALONE)))
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_ids(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit words of all rows and each row's first."""
    data, offsets = C.text_bytes(text)
    starts, ends, first = _word_bounds(data, offsets)
    return C.word_hashes(data, starts, ends, fold=_LOWER), first


def _windows(words: list[int], free: list[bool], size: int):
    """(start, Karp-Rabin hash) of each run of `size` unmarked words."""
    top = pow(RADIX, size - 1, PRIME)
    rolled, held = 0, 0
    for end, word in enumerate(words):
        if not free[end]:
            rolled, held = 0, 0
            continue
        if held == size:
            rolled = (rolled - words[end - size] * top) % PRIME
            held -= 1
        rolled = (rolled * RADIX + word) % PRIME
        held += 1
        if held == size:
            yield end - size + 1, rolled


def tiles(document: list[int], item: list[int], least: int = SEED) -> list[tuple[int, int, int]]:
    """(place in document, place in item, length) of the tiles, longest first; -1 in a document matches nothing."""
    free_d, free_i = [w >= 0 for w in document], [True] * len(item)
    out = []
    size = max(least, min(len(item), len(document)))
    while True:
        while True:  # all matches of at least `size` words
            at: dict[int, list[int]] = {}
            for place, key in _windows(item, free_i, size):
                at.setdefault(key, []).append(place)
            found, reach = [], {}
            for place, key in _windows(document, free_d, size):
                for other in at.get(key, ()):
                    if reach.get(place - other, -1) >= place + size:
                        continue  # within a match already found on this diagonal
                    n = 0
                    while place + n < len(document) and other + n < len(item) and free_d[place + n] and free_i[other + n] and document[place + n] == item[other + n]:
                        n += 1
                    if n >= size:
                        found.append((-n, other, place))
                        reach[place - other] = place + n
            marked = False
            for n, other, place in sorted(found):
                n = -n
                if all(free_d[place : place + n]) and all(free_i[other : other + n]):
                    free_d[place : place + n] = [False] * n
                    free_i[other : other + n] = [False] * n
                    out.append((place, other, n))
                    marked = True
            if not marked or not any(free_i):
                break
        if size == least or not any(free_i):
            return out
        size = max(least, size // 2)


class Block:
    """Some benchmark items and the seeds that point at them."""

    def __init__(self, rows: list[tuple]):
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
        self.ids = [C.NO_ID if r[0] is None else r[0] for r in rows]
        words, first = word_ids(pa.array([r[1] or "" for r in rows], pa.string()))
        words &= np.uint64((1 << 60) - 1)
        self.items = [words[a:b].tolist() for a, b in zip(first, first[1:])]
        owner = C.owners(first)
        keys = C.window_hashes(words, SEED)
        at = np.flatnonzero(owner[: len(keys)] == owner[SEED - 1 :]) if len(keys) else np.zeros(0, np.int64)
        order = np.argsort(keys[at], kind="stable")
        self.keys, where = np.unique(keys[at][order], return_index=True)
        self.owner = owner[at][order]
        self.bounds = np.append(where, len(at))
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def matches(self, text: pa.Array) -> list[list[tuple[float, int]]]:
        """Per row (share covered, item number) of the items that its tiles cover far enough."""
        out: list[list[tuple[float, int]]] = [[] for _ in range(len(text))]
        words, first = word_ids(text)
        words &= np.uint64((1 << 60) - 1)
        keys = C.window_hashes(words, SEED)
        at = np.flatnonzero(self.filter[(keys >> np.uint64(44)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return out
        place = np.searchsorted(self.keys, keys[at])
        ok = self.keys[np.minimum(place, len(self.keys) - 1)] == keys[at]
        at, place = at[ok], place[ok]
        row = np.searchsorted(first, at, side="right") - 1
        ok = at + SEED <= first[row + 1]
        at, place, row = at[ok], place[ok], row[ok]
        for r in np.unique(row):
            mine = row == r
            seeds: dict[int, list[int]] = {}
            for a, p in zip(at[mine].tolist(), place[mine].tolist()):
                for item in set(self.owner[self.bounds[p] : self.bounds[p + 1]].tolist()):
                    seeds.setdefault(item, []).append(a)
            for item, found in sorted(seeds.items()):
                covered = sum(n for _, _, n in tiles(_runs(words, found), self.items[item]))
                share = covered / len(self.items[item])
                if share >= THRESHOLD:
                    out[r].append((share, item))
        return out


def _runs(words: np.ndarray, seeds: list[int]) -> list[int]:
    """The words under the seeds, in order; -1 parts runs. No tile reaches beyond them."""
    out: list[int] = []
    done = -1
    for a in seeds:
        if a > done and out:
            out.append(-1)
        out += words[max(a, done) : a + SEED].tolist()
        done = a + SEED
    return out


def blocks(benchmark: DataFrame) -> list[Block]:
    """The items in blocks of bounded size; a block is what a task, and the driver, holds."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    number = max(1, -(-size // (BLOCK_WORDS * 6)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for i in range(number):
        yield Block([tuple(r) for r in rows.where(part == i).collect()])


def not_searched(benchmark: DataFrame) -> DataFrame:
    """The items that no document can match, being shorter than a seed, with their number of words."""
    kinds = "item_id long, text string, n_words long"
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    counted = C.per_row(rows, ["item_id", "text"], lambda text: [np.diff(word_ids(text)[1])], kinds.split(", ")[-1], "text")
    return counted.where(F.col("n_words") < SEED)


def _named(text: str) -> list[Column]:
    """128 bits of the text; what tiles cover depends on nothing else."""
    return [F.xxhash64(F.lit(tag), F.coalesce(F.col(C.quoted(text)).cast("string"), F.lit(""))).alias(f"_text{tag}") for tag in (0, 1)]


def _found(docs: DataFrame, block: Block) -> DataFrame:
    """(_text0, _text1, items, best_item, coverage): the texts that cover an item of the block far enough, once each; a written table."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    names = ["_text0", "_text1", *[part.split()[0] for part in FIELDS.split(", ")]]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in C.slices(batches, "t"):
            rows = []
            for at, found in enumerate(own.matches(pc.fill_null(batch.column("t"), ""))):
                if found:
                    top = min(found, key=lambda x: (-x[0], own.ids[x[1]]))
                    rows.append((batch.column("_text0")[at].as_py(), batch.column("_text1")[at].as_py(), [own.ids[i] for _, i in found], own.ids[top[1]], top[0]))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    texts = docs.select(F.col("text").cast("string").alias("t"), *_named("text"))
    hits = C.map_arrow(texts, step, f"_text0 long, _text1 long, {FIELDS}")
    once = hits.groupBy("_text0", "_text1").agg(*[F.first(c).alias(c) for c in names[2:]])  # copies are alike
    out = stored(once)
    shared.destroy()
    return out


def tiled(docs: DataFrame, benchmark: DataFrame, carry: list[str]) -> DataFrame:
    """`carry` and a struct `leak`: items covered far enough, the best of them, its covered share."""
    plain = [f"d{i}" for i in range(len(carry))]
    hits = reduce(DataFrame.unionByName, [_found(docs, block) for block in blocks(benchmark)])
    items = F.array_sort(F.flatten(F.collect_list("items"))).alias("items")
    best = F.min(F.struct((-F.col("coverage")).alias("c"), F.col("best_item").alias("i"))).alias("best")
    leaks = stored(hits.groupBy("_text0", "_text1").agg(items, best))
    rows = docs.select(*[F.col(C.quoted(c)).alias(p) for c, p in zip(carry, plain)], *_named("text"))
    joined = rows.join(leaks, ["_text0", "_text1"], "left")
    none = F.array().cast("array<long>")
    leak = F.struct(F.coalesce("items", none).alias("items"), F.nullif(F.col("best.i"), F.lit(C.NO_ID)).alias("best_item"), F.coalesce(-F.col("best.c"), F.lit(0.0)).alias("coverage"))
    return joined.select(*plain, leak.alias("leak")).toDF(*carry, "leak")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items, best_item and coverage, one row per input row."""
    rows = tiled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, ["doc_id"])
    return rows.select("doc_id", (F.size("leak.items") > 0).alias("contaminated"), F.size("leak.items").cast("long").alias("n_items"), "leak.items", "leak.best_item", "leak.coverage")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    plain = docs.toDF(*[c if c == "text" else f"p{i}" for i, c in enumerate(docs.columns)])
    rows = tiled(plain, benchmark, plain.columns)
    return rows.where(F.size("leak.items") == 0).drop("leak").toDF(*docs.columns)
