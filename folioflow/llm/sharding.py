"""Sharding by minimax contiguous partition, in column expressions only.

Documents with equal texts are one atomic group. Groups stand in the order of their text's MD5 and are
cut into contiguous shards so that the largest shard is as small as that order allows: a binary search
over the capacity, each capacity checked by filling shards greedily.

The search needs group sizes only where a cut may fall. So sizes are summed per MD5 prefix first, and
a prefix is opened into longer ones only while a cut of some capacity still in question may lie
within it: every round collects at most a few thousand sums, however many groups there are. A group larger
than an even share (there are fewer than shards) gets a shard of its own first.

Slots number a shard's rows from 0 without gaps: rows are counted per shard and chunk, and numbered within
the chunk, so neither a shard nor a large group meets in one task.

Edge cases: null text counts as an empty one, of size 1; repeated rows get slots of their own; null ids
are kept; an empty table gives an empty table; with fewer groups than shards some shards stay empty;
other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import stored

SHARDS = 8
DIGITS = 32  # of an MD5
STEP = 3  # digits by which a prefix is opened
CHUNK_ROWS = 100_000


class Node:
    """All groups below a prefix: their size, the largest of them, whether there is but one."""

    __slots__ = ("prefix", "size", "largest", "single")

    def __init__(self, prefix: str, size: int, largest: int, groups: int):
        self.prefix, self.size, self.largest, self.single = prefix, size, largest, groups == 1


def fill(sizes: list[int], capacity: int) -> list[int] | None:
    """First item of each shard when shards are filled in order; None if an item is too large."""
    cuts, held = [0], 0
    for i, size in enumerate(sizes):
        if size > capacity:
            return None
        if held + size > capacity:
            cuts.append(i)
            held = 0
        held += size
    return cuts


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity at which filling needs no more than `shards`."""
    low, high = max([-(-sum(sizes) // shards), *sizes, 0]), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        cuts = fill(sizes, middle)
        if cuts is not None and len(cuts) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def _open(groups: DataFrame, nodes: list[Node], which: set[int]) -> list[Node]:
    """Nodes with those in `which` replaced by the prefixes `STEP` digits longer."""
    by_length: dict[int, list[str]] = {}
    for i in which:
        by_length.setdefault(len(nodes[i].prefix), []).append(nodes[i].prefix)
    parts: dict[str, list[Node]] = {}
    for length, prefixes in by_length.items():
        rows = groups.where(F.left("text_md5", F.lit(length)).isin(prefixes)) if length else groups
        longer = F.left("text_md5", F.lit(min(length + STEP, DIGITS)))
        for r in rows.groupBy(longer.alias("p")).agg(F.sum("size").alias("s"), F.max("size").alias("m"), F.count("*").alias("n")).collect():
            parts.setdefault(r.p[:length], []).append(Node(r.p, r.s, r.m, r.n))
    out: list[Node] = []
    for i, node in enumerate(nodes):
        out += sorted(parts[node.prefix], key=lambda n: n.prefix) if i in which else [node]
    return out


def _uncertain(nodes: list[Node], shards: int) -> set[int]:
    """Nodes of several groups in which a cut may lie at some capacity that may yet be the smallest."""
    ends = list(accumulate(n.size for n in nodes))
    low = max(-(-ends[-1] // shards), *[n.largest for n in nodes])
    # Taking nodes as atoms can only need more room.
    high = max(low, smallest_capacity([n.size for n in nodes], shards))
    out = set()
    first = last = 0
    for _ in range(1, shards):
        # A cut is where the group begins that no longer fits; it moves on with the cut before it.
        reach = min(first + low, ends[-1])
        at = min(bisect_left(ends, reach), len(nodes) - 1)
        first = max(first, reach - nodes[at].largest)
        last = min(last + high, ends[-1])
        begin, end = bisect_left(ends, first), min(bisect_left(ends, last), len(nodes) - 1)
        out |= {i for i in range(begin, end + 1) if not nodes[i].single}
    return out


def boundaries(groups: DataFrame, shards: int) -> list[str]:
    """First MD5 (or a prefix before it) of the shards after the first, for groups (text_md5, size)."""
    first = groups.agg(F.sum("size"), F.count("*"), F.max("size")).first()
    if not first[0]:
        return []
    nodes = [Node("", first[0], first[2], first[1])]
    while not all(n.single for n in nodes):
        which = _uncertain(nodes, shards)
        if not which:
            break
        nodes = _open(groups, nodes, which)
    sizes = [n.size for n in nodes]
    cuts = fill(sizes, smallest_capacity(sizes, shards))
    return [nodes[i].prefix for i in cuts[1:]]


def _own_shards(groups: DataFrame, shards: int) -> list[str]:
    """Groups larger than an even share of what is left, largest first; fewer than `shards`."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    alone = []
    for r in groups.orderBy(F.desc("size"), "text_md5").limit(shards - 1).collect():
        if r["size"] * (shards - len(alone)) <= total:
            break
        alone.append(r.text_md5)
        total -= r["size"]
    return alone


def law_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per input row, sizes near equal."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("text_md5"),
    )
    rows = stored(rows.withColumn("seq", F.monotonically_increasing_id()))
    groups = stored(rows.groupBy("text_md5").agg(F.sum("size").alias("size")))
    alone = _own_shards(groups, shards)
    light = groups.where(~F.col("text_md5").isin(alone)) if alone else groups
    cuts = boundaries(light, shards - len(alone))
    rows = rows.withColumn("shard", _shard(F.col("text_md5"), alone, cuts))
    number = rows.count()
    chunk = F.pmod(F.xxhash64("seq"), F.lit(max(1, -(-number // CHUNK_ROWS)))).alias("chunk")
    return _slots(rows.select("*", chunk)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _shard(md5: Column, alone: list[str], cuts: list[str]) -> Column:
    out = F.lit(len(alone))
    for i, cut in enumerate(cuts):
        out = F.when(md5 >= cut, len(alone) + i + 1).otherwise(out)
    for i, own in enumerate(alone):
        out = F.when(md5 == own, i).otherwise(out)
    return out.cast("int")


def _slots(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy("shard", "chunk").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "chunk", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("seq"))
    numbered = rows.withColumn("place", place)
    return numbered.join(offsets, ["shard", "chunk"]).withColumn("slot", F.col("offset") + F.col("place") - 1)
