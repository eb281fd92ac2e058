"""Prefix trie of conversations, from vertical bitmaps.

A turn is known by 128 bits of its role and text; text never moves. Turns are placed in their conversation by a
distributed sort, rebuilt, and cut into segments of `SEGMENT` turns, so that no conversation is one row. What precedes a
segment is known by the exclusive or of its turns' hashes, each mixed with its place: the key of a node.

Segments of one number are sorted by conversation and dealt into shards of at most `SHARD` segments and `SHARD_TURNS`
turns, wherever a task meets them. A shard indexes (position, turn) to a bitset of its segments. From each node that it
continues, depth first, the bitset is intersected with the posting of a member's next turn, until no member is left: each
intersection is a child, its population count the members, and the members that go no further its end list. Nodes of the
shards meet by key, after partial aggregation, so a prefix that a third of all conversations share has one entry a shard.

What a node needs from below adds up over its members, once it is known from which depth on a conversation is the
smallest of its node (it owns it, and all that follow): children and leaves are counted by their owners, and what a
conversation saves under a node are the bytes between it and the first turn it owns. So a second pass over the shards,
through shared nodes alone, gives subtree sums without walking the tree upwards.

End lists of a node follow each other in shard order, ascending; they are packed, and their decimal digest is taken in a
stream, list by list, since SHA-256 runs over its input in order.

Edge cases: rows without conv_id belong to no conversation; a null turn comes first; turns of one number stand in the
order of their hashes; repeated rows are turns of their own; null role or text is empty; a conversation may be rebuilt to no turns
and ends at the root; an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import map_arrow
from folioflow.llm.ordering import numbered
from folioflow.session import stored

HEADS, GROUP = 9, 5  # of rebuilding: turns taken over are fewer than HEADS, conversations in a group
SEGMENT = 512
SHARD, SHARD_TURNS = 2048, 1 << 16

TURN = "struct<place:int,lo:long,hi:long,bytes:long>"
NODES = "depth long, lo long, hi long, parent_lo long, parent_hi long, conv_id long, n_convs long, before long, longer boolean, n_ends long, first_end long, ends binary"
SUMS = "depth long, lo long, hi long, n_children long, n_leaves long, saved_tokens long"
KEY = ["depth", "lo", "hi"]


# -- turns of conversations ---------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (0 up), lo, hi, bytes of each turn, in order of `turn`."""
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    read = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text)
    names = [F.xxhash64(F.lit(tag), "role", "text").alias(name) for tag, name in enumerate(("lo", "hi"))]
    hashed = read.where("conv_id is not null").select("conv_id", "turn", *names, F.octet_length("text").cast("long").alias("bytes"))
    return numbered(hashed, "conv_id", ["turn", "lo", "hi"]).drop("turn")


def rebuilt(placed: DataFrame) -> DataFrame:
    """conv_id, pos, lo, hi, bytes of rebuilt conversations, and a row with null pos for each; lo and hi name the turn at its place.

    A conversation c gets the first h turns of c - c % GROUP, h being CRC-32 of its decimal id modulo HEADS, before its own
    from the h-th on. At most HEADS - 1 turns of a conversation are handed to at most GROUP of them.
    """
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    turn = F.struct(F.col("pos").cast("int").alias("place"), "lo", "hi", "bytes")
    lead = placed.where((F.col("pos") < HEADS - 1) & (F.col("conv_id") % GROUP == 0))
    leads = lead.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(turn)).alias("lead"))
    every = placed.select("conv_id").distinct().select("conv_id", base.alias("base"), taken.alias("h"))
    given = F.slice(F.coalesce("lead", F.array().cast(f"array<{TURN}>")), F.lit(1), F.col("h"))
    heads = stored(every.join(leads, "base", "left").select("conv_id", "h", given.alias("given"), F.size(given).alias("n")))

    first = heads.select("conv_id", F.explode_outer("given").alias("t")).select("conv_id", F.col("t.place").cast("long").alias("pos"), "t.lo", "t.hi", "t.bytes")
    shifted = placed.join(heads.select("conv_id", "h", "n"), "conv_id").where(F.col("pos") >= F.col("h"))
    own = shifted.select("conv_id", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "lo", "hi", "bytes")
    at_place = {name: F.xxhash64(F.lit(tag), "pos", "lo", "hi") for tag, name in enumerate(("lo", "hi"))}
    return first.unionByName(own).withColumns(at_place)


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """conv_id, segment, turns (array by place), last (whether the conversation ends here), start_lo, start_hi, before (key and
    bytes of what precedes it), total (bytes of the conversation); a written table."""
    place = F.col("pos")
    turn = F.struct((place % size).cast("int").alias("place"), "lo", "hi", "bytes")
    there = lambda c: F.when(place.isNotNull(), c)
    # The row without a turn only stands for its conversation.
    listed = rows.groupBy("conv_id", F.floor(F.coalesce(place, F.lit(0)) / size).cast("long").alias("segment")).agg(
        F.array_sort(F.collect_list(there(turn))).alias("turns"),
        *[F.coalesce(F.bit_xor(there(F.col(c))), F.lit(0)).cast("long").alias(f"_{c}") for c in ("lo", "hi")],
        F.coalesce(F.sum(there(F.col("bytes"))), F.lit(0)).cast("long").alias("_bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy("segment")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(c.over(earlier), F.lit(0).cast("long"))
    return stored(
        listed.select(
            "conv_id",
            "segment",
            "turns",
            F.lead("segment").over(order).isNull().alias("last"),
            before(F.bit_xor("_lo")).alias("start_lo"),
            before(F.bit_xor("_hi")).alias("start_hi"),
            before(F.sum("_bytes")).alias("before"),
            F.sum("_bytes").over(Window.partitionBy("conv_id")).alias("total"),
        )
    )


# -- shards -------------------------------------------------------------------


def bitset(mask: np.ndarray) -> int:
    return int.from_bytes(np.packbits(mask, bitorder="little").tobytes(), "little")


def members(bits: int, n: int) -> np.ndarray:
    """The places of the ones, in order."""
    raw = np.frombuffer(bits.to_bytes((n + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little", count=n))


def lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def cut_shards(batches: Iterator[pa.RecordBatch], most: int, most_turns: int) -> Iterator[pa.Table]:
    """Rows in a row of one segment number, at most so many and so many turns, or a single row."""
    held: list[pa.RecordBatch] = []
    rows, size, segment = 0, 0, None
    for batch in batches:
        start = 0
        numbers = batch.column("segment").to_pylist()
        for i, (number, n) in enumerate(zip(numbers, pc.list_value_length(batch.column("turns")).to_pylist())):
            if rows and (number != segment or rows >= most or size + n > most_turns):
                held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, rows, size, start = [], 0, 0, i
            rows, size, segment = rows + 1, size + n, number
        held.append(batch.slice(start))
    if rows:
        yield pa.Table.from_batches(held)


class Shard:
    """Segments of one number with their vertical index: (position, turn) to the bitset of segments that have it."""

    def __init__(self, table: pa.Table, size: int) -> None:
        column = lambda name: table.column(name).combine_chunks()
        number = lambda name: column(name).to_numpy(zero_copy_only=False)
        self.n = table.num_rows
        self.conv, self.last = number("conv_id"), number("last").astype(bool)
        self.depth = int(table.column("segment")[0].as_py()) * size  # of the nodes that the shard continues
        listed = column("turns")
        flat = listed.flatten()
        self.sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
        self.offsets = np.append(0, np.cumsum(self.sizes))
        lo, hi, width = [flat.field(name).to_numpy(zero_copy_only=False) for name in ("lo", "hi", "bytes")]
        self.owner = np.repeat(np.arange(self.n), self.sizes)
        self.start = number("start_lo"), number("start_hi")
        self.key = self._prefix(np.bitwise_xor.accumulate(lo) if len(lo) else lo, self.start[0], np.bitwise_xor), self._prefix(np.bitwise_xor.accumulate(hi) if len(hi) else hi, self.start[1], np.bitwise_xor)
        # Bytes before each turn.
        self.before = self._prefix(np.cumsum(width), -number("before"), np.subtract) - width
        self._index(lo, hi)
        self._longer: dict[tuple[int, bool], int] = {}

    def _prefix(self, running: np.ndarray, start: np.ndarray, less) -> np.ndarray:
        """Running figures of each segment, from those over all."""
        begun = np.append(0, running)[self.offsets[:-1]]
        return less(less(running, begun[self.owner]), start[self.owner])

    def _index(self, lo: np.ndarray, hi: np.ndarray) -> None:
        order = np.lexsort((hi, lo))
        new = np.ones(len(order), bool)
        new[1:] = (lo[order][1:] != lo[order][:-1]) | (hi[order][1:] != hi[order][:-1])
        heads = np.append(np.flatnonzero(new), len(order))
        self.turn = np.empty(len(order), np.int64)
        self.turn[order] = np.cumsum(new) - 1
        # A turn that one segment has needs no posting.
        self.posting: dict[int, int] = {}
        for turn in np.flatnonzero(np.diff(heads) > 1).tolist():
            mask = np.zeros(self.n, bool)
            mask[self.owner[order[heads[turn] : heads[turn + 1]]]] = True
            self.posting[turn] = bitset(mask)

    def longer(self, place: int, beyond: bool = False) -> int:
        """Segments with a turn at `place`; beyond: also those whose conversation goes on in the next segment."""
        if (place, beyond) not in self._longer:
            mask = self.sizes > place
            self._longer[place, beyond] = bitset(mask | ((self.sizes == place) & ~self.last) if beyond else mask)
        return self._longer[place, beyond]

    def walk(self, deep: np.ndarray | None = None) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Nodes below those that the shard continues, depth first: (bitset, turn) of nodes with several members, and
        (segment, place) of single members, whose node is followed by all their further ones.

        deep: the depth to which each segment is followed, if not to its end.
        """
        several, single = [], []
        groups: dict[tuple[int, int], list[int]] = {}
        for i, key in enumerate(zip(self.start[0].tolist(), self.start[1].tolist())):
            groups.setdefault(key, []).append(i)
        stack = []
        for own in groups.values():
            mask = np.zeros(self.n, bool)
            mask[own] = True
            stack.append((bitset(mask), 0))
        while stack:
            bits, place = stack.pop()
            rest = bits & self.longer(place)
            while rest:
                first = lowest(rest)
                at = int(self.offsets[first]) + place
                child = rest & self.posting.get(int(self.turn[at]), 1 << first)
                rest ^= child
                if deep is not None and deep[first] < self.depth + place + 1:
                    continue
                if child.bit_count() == 1:
                    single.append((first, place))
                else:
                    several.append((child, at))
                    stack.append((child, place + 1))
        return several, single

    def chains(self, single: list[tuple[int, int]], deep: np.ndarray | None = None) -> np.ndarray:
        """The turns of single members from the given place to their end, or to a depth."""
        if not single:
            return np.zeros(0, np.int64)
        own, place = np.array(single, np.int64).T
        begin, end = self.offsets[own] + place, self.offsets[own + 1]
        if deep is not None:
            end = np.minimum(end, self.offsets[own] + np.maximum(deep[own] - self.depth, 0))
        sizes = np.maximum(end - begin, 0)
        return np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))

    def places(self, at: np.ndarray) -> np.ndarray:
        """Depth of the nodes that turns lead to."""
        return self.depth + at - self.offsets[self.owner[at]] + 1


def _packed(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    parts = [p.split() for p in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k], from_pandas=False) for c, (_, k) in zip(columns, parts)], [n for n, _ in parts])


def _nodes(size: int, most: int, most_turns: int):
    """Nodes of each shard: members, whether any goes on, and the list of those that end there."""

    def rows(shard: Shard) -> Iterator[pa.RecordBatch]:
        several, single = shard.walk()
        if shard.depth == 0:
            ends = shard.conv[(shard.sizes == 0) & shard.last]
            first = int(ends[0]) if len(ends) else None
            yield _packed(NODES, [[v] for v in (0, 0, 0, None, None, int(shard.conv[0]), shard.n, 0, bool(len(ends) < shard.n), len(ends), first, ends.tobytes() if len(ends) else None)])
        chain = shard.chains(single)
        at = np.concatenate([np.array([a for _, a in several], np.int64), chain])
        if not len(at):
            return
        own = shard.owner[at]
        place = at - shard.offsets[own]
        begin = place == 0
        parent = [np.where(begin, start[own], key[np.maximum(at - 1, 0)]) for start, key in zip(shard.start, shard.key)]
        final = (place + 1 == shard.sizes[own]) & shard.last[own]
        number, longer, n_ends, firsts, lists = [], [], [], [], []
        for bits, a in several:
            ending = bits & ~shard.longer(int(a - shard.offsets[shard.owner[a]]) + 1, True)
            count = ending.bit_count()
            ends = shard.conv[members(ending, shard.n)] if count else None
            number.append(bits.bit_count())
            longer.append(count < number[-1])
            n_ends.append(count)
            firsts.append(int(ends[0]) if count else None)
            lists.append(ends.tobytes() if count else None)
        alone, conv = final[len(several) :], shard.conv[own[len(several) :]]
        number += [1] * len(chain)
        longer += (~alone).tolist()
        n_ends += alone.astype(int).tolist()
        firsts += [c if e else None for c, e in zip(conv.tolist(), alone.tolist())]
        lists += [c.tobytes() if e else None for c, e in zip(conv, alone.tolist())]
        columns = [shard.places(at), shard.key[0][at], shard.key[1][at], *parent, shard.conv[own], number, shard.before[at], longer, n_ends, firsts, lists]
        yield _packed(NODES, columns)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in cut_shards(batches, most, most_turns):
            yield from rows(Shard(table, size))

    return step


def _sums(size: int, most: int, most_turns: int):
    """Children, leaves and savings that the members in a shard give to each node that several conversations share."""

    def rows(shard: Shard, table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = lambda name: table.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        owns, saved, deep, leaf = column("owns"), column("saved"), column("deep"), column("leaf").astype(np.int64)
        several, single = shard.walk(deep)
        if shard.depth == 0:
            child = (owns <= 1) & (shard.sizes > 0)
            yield _packed(SUMS, [[v] for v in (0, 0, 0, int(child.sum()), int(leaf.sum()), int(saved[owns > 0].sum()))])
        out = []
        for bits, at in several:
            depth, before = int(shard.places(np.array([at]))[0]), int(shard.before[at])
            all_ = members(bits, shard.n)
            goes_on = members(bits & shard.longer(depth - shard.depth, True), shard.n)
            others = all_[owns[all_] > depth]
            total = int(saved[others].sum()) - len(others) * before
            out.append((depth, shard.key[0][at], shard.key[1][at], int((owns[goes_on] <= depth + 1).sum()), int(leaf[all_].sum()), total))
        if out:
            yield _packed(SUMS, [list(c) for c in zip(*out)])
        at = shard.chains(single, deep)
        if len(at):
            own, depth = shard.owner[at], shard.places(at)
            final = (depth - shard.depth == shard.sizes[own]) & shard.last[own]
            gain = np.where(owns[own] > depth, saved[own] - shard.before[at], 0)
            yield _packed(SUMS, [depth, shard.key[0][at], shard.key[1][at], ((owns[own] <= depth + 1) & ~final).astype(np.int64), leaf[own], gain])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in cut_shards(batches, most, most_turns):
            yield from rows(Shard(table, size), table)

    return step


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's end lists, which come one after the other."""
    node, state = None, None

    def out(done):
        names = [*KEY, "digest"]
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names)

    for batch in batches:
        done = []
        for *key, ends in zip(*[batch.column(c).to_pylist() for c in [*KEY, "ends"]]):
            text = ",".join(map(str, np.frombuffer(ends, np.int64).tolist())).encode()
            if key == node:
                state.update(b",")
            else:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(text)
        yield out(done)
    if node:
        yield out([(*node, state.hexdigest())])


def _in_order(units: DataFrame) -> DataFrame:
    return units.repartitionByRange("segment", "conv_id").sortWithinPartitions("segment", "conv_id")


def prefix_trie(conversations: DataFrame, size: int = SEGMENT, most: int = SHARD, most_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    size: turns of a segment; most, most_turns: segments and turns of a shard.
    """
    units = segments(rebuilt(turns(conversations)), size)
    local = stored(map_arrow(_in_order(units.drop("total")), _nodes(size, most, most_turns), NODES))
    nodes = stored(
        local.groupBy(*KEY).agg(
            *[F.min(c).alias(c) for c in ("conv_id", "parent_lo", "parent_hi", "before", "first_end")],
            *[F.sum(c).alias(c) for c in ("n_convs", "n_ends")],
            F.max("longer").alias("longer"),
        )
    )
    shared = F.col("n_convs") > 1

    # From which depth on each conversation owns its nodes, and how far down they are shared.
    entry = F.min_by(F.struct("parent_lo", "parent_hi", "before"), "depth")
    owners = stored(
        nodes.groupBy("conv_id")
        .agg(F.min("depth").alias("owns"), entry.alias("entry"), F.max(F.when(shared, F.col("depth"))).alias("shared"), F.max(~F.col("longer")).alias("leaf"))
        .select("conv_id", "owns", "entry.*", "shared", "leaf")
    )
    never = F.lit((1 << 62)).cast("long")
    known = units.join(owners.drop("parent_lo", "parent_hi").withColumnRenamed("before", "saved"), "conv_id", "left").withColumns(
        {
            "deep": F.greatest(F.coalesce("owns", never) - 1, F.coalesce("shared", F.lit(-1))),
            "owns": F.coalesce("owns", never),
            "saved": F.coalesce("saved", "total"),
            "leaf": F.coalesce("leaf", F.lit(False)),
        }
    )
    # A segment matters if its first node is shared, and at the root always.
    near = known.where((F.col("segment") == 0) & (F.col("deep") >= 0) | (F.col("deep") > F.col("segment") * size)).drop("total", "shared")
    added = map_arrow(_in_order(near), _sums(size, most, most_turns), SUMS)
    sums = added.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])

    # The parent of a node is its owner's as well, but for the first that it owns.
    above = nodes.where(shared).select((F.col("depth") + 1).alias("depth"), F.col("lo").alias("parent_lo"), F.col("hi").alias("parent_hi"), F.col("conv_id").alias("parent"))
    entries = owners.select("conv_id", F.col("owns").alias("depth"), "parent_lo", "parent_hi")
    parents = entries.join(above, ["depth", "parent_lo", "parent_hi"]).select("conv_id", "depth", "parent")

    lists = local.where("n_ends > 0").select(*KEY, "first_end", "ends").join(nodes.where("n_ends > 1").select(*KEY), KEY, "left_semi")
    ordered = lists.repartition(*KEY).sortWithinPartitions(*KEY, "first_end").drop("first_end")
    digests = map_arrow(ordered, _digests, "depth long, lo long, hi long, digest string")

    joined = nodes.join(sums, KEY, "left").join(digests, KEY, "left").join(parents, ["conv_id", "depth"], "left")
    one = F.sha2(F.coalesce(F.col("first_end").cast("string"), F.lit("")), 256)
    return joined.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(shared, F.col("n_children")).otherwise(F.col("longer").cast("long")).alias("n_children"),
        F.when(shared, F.col("n_leaves")).otherwise(F.lit(1).cast("long")).alias("n_leaves"),
        F.when(shared, F.col("saved_tokens")).otherwise(F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("digest", one).alias("ends_sha256"),
    )
