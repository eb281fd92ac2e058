"""SimHash near-duplicates by segment popcounts.

A fingerprint's 64 bits are cut into segments, each replaced by its count of ones. A bit that differs
moves one count by one, so the Manhattan distance of two count vectors never exceeds the Hamming distance
of the fingerprints. With at most d differing bits, one of the `BLOCKS` halves of the vector is within
d // BLOCKS of the other's; two vectors within r of each other share a grid cell that is within
ceil(r / 2) of the one and floor(r / 2) of the other. So each distinct fingerprint is put in the cells
around it, once per half, and fingerprints that meet in a cell are verified on all their bits. Equal
fingerprints are one class before anything is joined.

Within a cell, links are reduced to a spanning forest as they are verified, so a cell of n near copies
gives fewer than n links, and no pair list grows with the square of a group. Cells are compared in
blocks of an array whose rows Spark has shuffled and sorted by cell; a cell is never collected as a list of
rows. A cell of more than `CELL_ROWS` is handed on by its task as it streams by, numbered, and every pair of its blocks becomes a
group that Spark places by itself. Components are found by joins (hooking and pointer jumping) over written tables.

Edge cases: null text is empty; a text without words has fingerprint zero and links like any other;
fewer words than a shingle give one shingle of all words; repeated rows get a row each; null ids are
members of their component but name it only if it has no other id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm import common as C
from folioflow.llm.components import components
from folioflow.session import stored

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SEGMENT_BITS = 2
BLOCKS = 2
# Fingerprints of a cell compared with those after them at a time.
BLOCK_ROWS = 2048
# Members of a cell that one group compares; a larger cell is compared by pairs of blocks of so many.
CELL_ROWS = 8192
NAMES = ["a", "b", "block"]


def text_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each shingle of `size` words of the lower-cased text."""
    words = text.lower().split()  # ASCII blanks and ASCII letters only, as bytes
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())]


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text the bits that more than half of its hashes set; zero for a text without hashes."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first[full], axis=0, dtype=np.int64)
        set_bits = 2 * ones > np.diff(first)[full, None]
        out[full] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, carry: list[str], shingle: int = SHINGLE) -> DataFrame:
    """`carry` and the fingerprint as a signed long."""

    def compute(text: pa.Array) -> list:
        out = []
        hashes: list[int] = []
        first = [0]
        for one in text.cast(pa.binary()).to_pylist():
            hashes += text_hashes(one, shingle)
            first.append(len(hashes))
            if len(hashes) > 100_000:
                out.append(majority(np.array(hashes, np.uint64), np.array(first)))
                hashes, first = [], [0]
        out.append(majority(np.array(hashes, np.uint64), np.array(first)))
        return [np.concatenate(out).view(np.int64)]

    return C.per_row(docs, carry, compute, "fp long")


def segment_counts(prints: np.ndarray) -> np.ndarray:
    """(n, 64 / SEGMENT_BITS) counts of ones."""
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(prints), 64 // SEGMENT_BITS, SEGMENT_BITS).sum(2, dtype=np.int8)


def _cells_at(counts: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, cell) of all grid points within `radius` of each row of counts; a cell is hashed."""
    width = counts.shape[1]
    values = C.mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    own = (counts.astype(np.uint64) * values).sum(1, dtype=np.uint64)
    out = [(np.arange(len(counts)), own)]
    level = [(np.arange(len(counts)), counts, own, -1)]
    for _ in range(radius):
        further = []
        for rows, at, cell, last in level:
            # Moves go from segment to segment in one order, so that no point is made twice.
            for s in range(max(last, 0), width):
                for step in (-1, 1):
                    ok = (at[:, s] + step >= 0) & (at[:, s] + step <= SEGMENT_BITS)
                    if s == last:  # never back again
                        ok &= np.sign(at[:, s] - counts[rows, s]) == step
                    if ok.any():
                        moved = at[ok].copy()
                        moved[:, s] += step
                        further.append((rows[ok], moved, cell[ok] + values[s] if step > 0 else cell[ok] - values[s], s))
        out += [(rows, cell) for rows, _, cell, _ in further]
        level = further
    return out


def _cells(max_bits: int, blocks: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy().view(np.uint64)
            for part in range(0, len(prints), 4096):
                some = prints[part : part + 4096]
                counts = segment_counts(some)
                width = counts.shape[1] // blocks
                radius = -(-(max_bits // blocks) // 2)
                for b in range(blocks):
                    stop = counts.shape[1] if b == blocks - 1 else (b + 1) * width
                    found = _cells_at(counts[:, b * width : stop], radius)
                    rows = np.concatenate([r for r, _ in found])
                    cell = C.mix(np.concatenate([c for _, c in found]) ^ C.mix(np.full(1, b + 1, np.uint64)))
                    yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(some[rows].view(np.int64))], ["cell", "fp"])

    return step


def _forest(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints, found block by block."""
    order = np.argsort(np.bitwise_count(prints), kind="stable")
    prints = prints[order]
    ones = np.bitwise_count(prints).astype(np.int64)
    tree = np.arange(len(prints))  # each row's tree, by its least row
    left, right = [], []
    for start in range(0, len(prints), BLOCK_ROWS):
        stop = min(start + BLOCK_ROWS, len(prints))
        # Totals of ones bound the distance too: only rows within max_bits of the block's are compared.
        far = int(np.searchsorted(ones, ones[stop - 1] + max_bits, side="right"))
        for other in range(start, far, BLOCK_ROWS):
            end = min(other + BLOCK_ROWS, far)
            near = np.bitwise_count(prints[start:stop, None] ^ prints[None, other:end]) <= max_bits
            for i in range(stop - start):
                at = np.flatnonzero(near[i]) + other
                # One link for each tree met; a row is looked at once per block, however many are near it.
                trees, which = np.unique(tree[at], return_index=True)
                for found, first in zip(trees.tolist(), at[which].tolist()):
                    own = int(tree[start + i])
                    if found != own and tree[first] != own:
                        left.append(start + i)
                        right.append(first)
                        tree[tree == max(own, found)] = min(own, found)
    return prints[left], prints[right]


def _links(max_bits: int, most: int | None):
    """Links within cells, which come sorted. Members of a cell with more than `most` are handed on instead, numbered in blocks of so
    many as they stream by: a task holds `most` of a cell at most."""

    def emit(cells: np.ndarray, prints: np.ndarray):
        """Links within the cells of arrays sorted by cell."""
        edge = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]]))
        sizes = np.diff(edge)
        left, right = [], []
        small = sizes <= 8
        at = np.repeat(np.where(small, sizes, 0), sizes)
        rank = np.arange(len(cells)) - np.repeat(edge[:-1], sizes)
        for k in range(1, 8):  # each with the k-th after it, all small cells at once
            i = np.flatnonzero(at - rank > k)
            i = i[np.bitwise_count(prints[i] ^ prints[i + k]) <= max_bits]
            left.append(prints[i])
            right.append(prints[i + k])
        for g in np.flatnonzero(~small):
            a, b = _forest(prints[edge[g] : edge[g + 1]], max_bits)
            left.append(a)
            right.append(b)
        if left:
            a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(pairs.shape[1], pa.int64())], NAMES)

    def later(cells: np.ndarray, prints: np.ndarray, at: int) -> pa.RecordBatch:
        block = (at + np.arange(len(cells))) // most
        return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(prints.view(np.int64)), pa.array(block)], NAMES)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        large, told = None, 0  # the cell that is handed on, and how many of its members were
        for batch in chain(batches, [None]):
            if batch is not None:
                cells = np.concatenate([cells, batch.column("cell").to_numpy()])
                prints = np.concatenate([prints, batch.column("fp").to_numpy().view(np.uint64)])
            more = int(np.searchsorted(cells, large, side="right")) if large is not None else 0
            if more:
                yield later(cells[:more], prints[:more], told)
                cells, prints, told = cells[more:], prints[more:], told + more
            if not len(cells):
                continue
            edge = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]]))
            sizes = np.diff(edge)
            over = sizes > (len(cells) if most is None else most)
            for g in np.flatnonzero(over):
                yield later(cells[edge[g] : edge[g + 1]], prints[edge[g] : edge[g + 1]], 0)
            if over[-1]:
                large, told = int(cells[-1]), int(sizes[-1])
            # The last cell may go on.
            whole = len(cells) - (0 if batch is None or over[-1] else int(sizes[-1]))
            small = ~np.repeat(over, sizes)[:whole]
            if small.any():
                yield from emit(cells[:whole][small], prints[:whole][small])
            cells, prints = cells[whole:], prints[whole:]

    return step


def links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, most: int = CELL_ROWS) -> DataFrame:
    """(a, b): links among distinct fingerprints `fp` that keep every component connected.

    A cell of more than `most` fingerprints is cut into blocks of so many, and each pair of its blocks is a group of its own, so
    that Spark spreads one cell over many tasks.
    """
    cells = C.map_arrow(prints.select("fp"), _cells(max_bits, blocks), "cell long, fp long")
    schema = "a long, b long, block long"
    met = cells.repartition("cell").sortWithinPartitions("cell")
    found = stored(C.map_arrow(met, _links(max_bits, most), schema))
    late = found.where("block is not null").select(F.col("a").alias("cell"), F.col("b").alias("fp"), "block")
    number = late.groupBy("cell").agg(F.max("block").alias("last"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("other")
    paired = late.join(number, "cell").select("cell", "fp", "block", other)
    key = F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("cell")
    together = paired.select(key, "fp").repartition("cell").sortWithinPartitions("cell")
    more = C.map_arrow(together, _links(max_bits, None), schema)
    return found.where("block is null").unionByName(more).select("a", "b").distinct()


def _components(rows: DataFrame, max_bits: int, least) -> tuple[DataFrame, DataFrame]:
    """(fp, component) of the distinct fingerprints, and (component, best): the least of `least` over its rows.

    The second is a written table, so a join with it is of plain shuffles, which Spark splits where a
    component is large.
    """
    prints = stored(rows.groupBy("fp").agg(F.min(least).alias("best")))
    label = components(links(prints, max_bits), "a", "b")
    named = prints.join(label, prints.fp == label.node, "left").select("fp", "best", F.coalesce("component", "fp").alias("component"))
    named = stored(named)
    return named.drop("best"), stored(named.groupBy("component").agg(F.min("best").alias("best")))


def classes(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per input row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(fingerprints(docs, ["doc_id"], shingle))
    named, best = _components(rows, max_bits, F.col("doc_id"))
    named = named.join(best, "component").select("fp", F.col("best").alias("component_id"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(named, "fp").select("doc_id", hexed, "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Of each component the one row with the smallest id, null last. All columns stay.

    Rows that are alike in every column are told apart by a number given as they are written.
    """
    plain = docs.toDF(*[c if c in ("doc_id", "text") else f"p{i}" for i, c in enumerate(docs.columns)])
    rows = fingerprints(plain, plain.columns, shingle)
    rows = stored(rows.withColumn("seq", F.monotonically_increasing_id()))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), F.col("seq"))
    best = _components(rows, max_bits, order)[1].select(F.col("best.seq").alias("seq"))
    return rows.join(best, "seq", "left_semi").select(*plain.columns).toDF(*docs.columns)
