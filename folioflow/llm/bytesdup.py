"""Suffix-array deduplication of byte strings.

A byte goes if a string of `MATCH` bytes around it also starts anywhere else. Every such string is claimed by
the least-hashed of its `ANCHOR`-byte pieces, wherever it occurs; so two equal strings are claimed by equal
pieces, and only documents that hold an anchor of some other place are looked at further.

The bytes that an anchor's strings span (at most `2 * MATCH - ANCHOR`) go to the shard of the anchor. Each
shard has a suffix array, made by Larsson-Sadakane refinement, and Kasai's common prefixes of neighbours
tell which of its strings are equal. An anchor fills as many shards as it has `SPLIT_ROWS` rows; those
hand on their distinct strings as sorted keys, cut by binary search into ranges, and a range's
pieces are merged by looking each up among all by binary search. Equal spans of one slice travel once, equal spans of
a shard are sorted once, and of equal texts one travels, as a partner of others: its own bytes and its copies' all go.

Edge cases: null text has no bytes; a text shorter than a match keeps all; repeated rows are documents of
their own, so each repeats the other; null ids are kept; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm import common as C
from folioflow.llm.shared import KEYS_HELD, PACKED, PARTS, bucket_count, collected, found_keys, pack_slices, parts
from folioflow.llm.suffixes import repeats
from folioflow.session import ship_package, stored

MATCH = 200
ANCHOR = 50
SPLIT_ROWS = 4096
# Text of a shard, and of an anchor's span at most: the number of shards follows the number of anchors found.
SHARD_BYTES, SPAN_BYTES = 1 << 20, 2 * MATCH - ANCHOR

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
SPANS = "bucket int, part int, text binary, sizes binary, docs binary, places binary, split binary"
SHARD = PARTS + ", range int, lo binary, hi binary, who binary, place binary"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` values in a row, from block-wise running minima."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    padded = padded.reshape(blocks, width)
    upto = np.minimum.accumulate(padded, axis=1).ravel()
    onward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[: n - width + 1], upto[width - 1 : n])


def claims(data: np.ndarray, offsets: np.ndarray):
    """(first, last, row, key) of the runs of match starts that one anchor claims, in text order."""
    none = np.zeros(0, np.int64)
    if len(data) < MATCH:
        return none, none, none, np.zeros(0, np.uint64)
    at = np.arange(len(data) - ANCHOR + 1)
    keys = C.range_hash(C._base(3)[0][data], at, at + ANCHOR, 3)
    bits = np.uint64(max(1, len(data).bit_length()))
    marked = (keys >> bits << bits) | at.astype(np.uint64)
    anchor = (sliding_least(marked, MATCH - ANCHOR + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), size)[: len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + MATCH <= offsets[1:][row])
    if not len(starts):
        return none, none, none, np.zeros(0, np.uint64)
    anchor, row = anchor[starts], row[starts]
    head = np.ones(len(starts), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(head)
    end = np.append(begin[1:], len(starts)) - 1
    # Least hashes crowd at the low end; mixed once more they spread evenly over buckets.
    return starts[begin], starts[end], row[begin], C.mix(keys[anchor[begin]])


def _pack_anchors(buckets: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in C.slices(batches):
            data, offsets = C.text_bytes(pc.fill_null(batch.column("text"), ""))
            _, _, row, keys = claims(data, offsets)
            yield keys, row, C.row_keys(batch.column("row_key"))

    return lambda batches: pack_slices(found(batches), buckets, KEYS_HELD, within=True)


def _copied(batch: pa.RecordBatch, text: pa.Array) -> np.ndarray:
    """Rows whose text other rows have too, if it is long enough to be a match."""
    long = pc.greater_equal(pc.binary_length(text), MATCH)
    return pc.and_(pc.is_valid(batch.column("first_key")), long).to_numpy(zero_copy_only=False)


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.arange(total) + np.repeat(starts - ends + sizes, sizes)]


def _spans(batch: pa.RecordBatch):
    """The claimed runs of a slice whose anchor is shared: (data, first, size, row, key, parts)."""
    data, offsets = C.text_bytes(pc.fill_null(batch.column("text"), ""))
    first, last, row, keys = claims(data, offsets)
    listed = batch.column("anchors")
    flat = listed.flatten()
    owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(listed).to_numpy())
    known = flat.field("key").to_numpy().view(np.uint64)
    parts = flat.field("parts").to_numpy()
    name = C.mix(known ^ C.mix(owner.astype(np.uint64) + np.uint64(1)))
    by = np.argsort(name)
    mine = C.mix(keys ^ C.mix(row.astype(np.uint64) + np.uint64(1)))
    place = np.minimum(np.searchsorted(name[by], mine), max(len(name) - 1, 0))
    ok = name[by][place] == mine if len(name) else np.zeros(len(mine), bool)
    number = parts[by][place[ok]] if len(name) else np.zeros(0, np.int32)
    return data, offsets, first[ok], (last - first)[ok] + MATCH, row[ok], keys[ok], number


def _pack_spans(buckets: int):
    names = [p.split()[0] for p in SPANS.split(", ")]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in C.slices(batches):
            # Of copies one goes on, as a partner of others: what becomes of itself is known.
            copied = _copied(whole, pc.fill_null(whole.column("text"), ""))
            lead = (C.row_keys(whole.column("first_key")) == C.row_keys(whole.column("row_key"))).all(axis=1)
            batch = whole.filter(pa.array(~copied | lead))
            if not batch.num_rows:
                continue
            copied = copied[~copied | lead]
            data, offsets, first, size, row, keys, parts = _spans(batch)
            if not len(first):
                continue
            docs = C.row_keys(batch.column("row_key"))
            # Equal spans: all their strings repeat; one copy travels, for the sake of others.
            values = [C.range_hash(C._base(seed)[0][data], first, first + size, seed) for seed in (4, 5)]
            by = np.lexsort((values[1], values[0]))
            new = np.ones(len(by), bool)
            new[1:] = (values[0][by][1:] != values[0][by][:-1]) | (values[1][by][1:] != values[1][by][:-1])
            heads = np.flatnonzero(new)
            times = np.diff(np.append(heads, len(by)))
            several = np.zeros(len(by), bool)
            several[by] = np.repeat(times > 1, times)
            place = first - offsets[row]
            partner = copied[row]
            rows = []
            t = np.flatnonzero(several & ~partner)
            if len(t):
                rows.append((-1 - int(docs[row[t[0]], 0]) % buckets, 0, b"", size[t].astype(np.int32).tobytes(), docs[row[t]].tobytes(), place[t].astype(np.int32).tobytes(), b""))
            sent = np.sort(by[heads])
            bucket = ((keys[sent] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            part = (docs[row[sent], 0].astype(np.uint64) >> np.uint64(7)).astype(np.int64) % np.maximum(parts[sent], 1)
            order = np.lexsort((part, bucket))
            sent, bucket, part = sent[order], bucket[order], part[order]
            cut = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])))
            for a, b in zip(cut, np.append(cut[1:], len(sent))):
                own = sent[a:b]
                whose = np.where(several[own] | partner[own], -1, place[own]).astype(np.int32)
                rows.append(
                    (int(bucket[a]), int(part[a]), gather(data, first[own], size[own]).tobytes(), size[own].astype(np.int32).tobytes(), docs[row[own]].tobytes(), whose.tobytes(), (parts[own] > 1).tobytes())
                )
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    return step


def _equal_spans(text: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, times): the first of the spans that equal each span, and how many there are."""
    hashes = [C.range_hash(C._base(seed)[0][text], begin, begin + sizes, seed) for seed in (4, 5)]
    by = np.lexsort((hashes[1], hashes[0]))
    new = np.ones(len(by), bool)
    new[1:] = (hashes[0][by][1:] != hashes[0][by][:-1]) | (hashes[1][by][1:] != hashes[1][by][:-1])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(by)))
    first, count = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
    first[by] = np.repeat(np.minimum.reduceat(by, heads), times)
    count[by] = np.repeat(times, times)
    return first, count


def _shard(ranges: int):
    """Strings of one shard that repeat in it, as runs of starts; keys of those that other shards may hold.

    Of equal spans one is sorted, for the sake of others: all strings of each of them repeat.
    """

    def solve(table: pa.Table) -> pa.Table:
        column = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        sizes, docs, places = column("sizes", np.int32).astype(np.int64), column("docs", np.int64).reshape(-1, 2), column("places", np.int32)
        if table.column("bucket")[0].as_py() < 0:
            return _answer(docs, places, places + sizes - MATCH + 1, [], ranges)
        text, split = column("text", np.uint8), column("split", bool)
        first, times = _equal_spans(text, np.cumsum(sizes) - sizes, sizes)
        told = np.flatnonzero((times > 1) & (places >= 0))
        whole = docs[told], places[told].astype(np.int64), places[told] + sizes[told] - MATCH + 1

        one = np.flatnonzero(first == np.arange(len(first)))
        text = gather(text, (np.cumsum(sizes) - sizes)[one], sizes[one])
        # An answer is owed to those that are told nothing yet.
        sizes, docs, split, places = sizes[one], docs[one], split[one], np.where(times[one] > 1, -1, places[one])
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(text))
        order, same = repeats(text, left, MATCH)
        repeated = np.zeros(len(text), bool)
        repeated[order[same]] = True
        repeated[order[:-1][same[1:]]] = True
        owner = np.repeat(np.arange(len(sizes)), sizes)
        begin = ends - sizes
        starts = left >= MATCH
        mine = np.flatnonzero(repeated & starts & (places[owner] >= 0))
        head = np.ones(len(mine), bool)
        head[1:] = (mine[1:] != mine[:-1] + 1) | (owner[mine][1:] != owner[mine][:-1])
        a = mine[head]
        b = mine[np.append(np.flatnonzero(head)[1:], len(mine)) - 1] if len(mine) else a
        o = owner[a]
        # One of each class of equal strings; classes follow each other in the suffix array.
        rest = order[split[owner[order]] & starts[order] & ~same]
        hashes = [C.range_hash(C._base(seed)[0][text], rest, rest + MATCH, seed) for seed in (6, 7)]
        by = np.lexsort((hashes[1], hashes[0]))
        rest, lo, hi = rest[by], hashes[0][by], hashes[1][by]
        open_ = ~repeated[rest] & (places[owner[rest]] >= 0)  # known repeats need no answer
        whose = np.where(open_[:, None], docs[owner[rest]], 0)
        place = np.where(open_, places[owner[rest]] + rest - begin[owner[rest]], -1).astype(np.int32)
        bounds = (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64) if len(rest) else np.zeros(0, np.uint64)
        cuts = [0, *np.searchsorted(lo, bounds).tolist(), len(lo)]
        keys = [(i, lo[x:y].tobytes(), hi[x:y].tobytes(), whose[x:y].tobytes(), place[x:y].tobytes()) for i, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        found = docs[o], places[o] + a - begin[o], places[o] + b - begin[o] + 1
        return _answer(*[np.concatenate(c) for c in zip(whole, found)], keys, ranges)

    return solve


def _answer(docs: np.ndarray, begins: np.ndarray, ends: np.ndarray, keys: list[tuple], slots: int) -> pa.Table:
    """Runs of match starts as `parts`, then one row per range of keys."""
    runs = parts(docs, begins.astype(np.int32), ends.astype(np.int32), slots)
    n, m = runs.num_rows, len(keys)
    out = {name: pa.concat_arrays([runs.column(name).combine_chunks(), pa.nulls(m, runs.column(name).type)]) for name in runs.column_names}
    for i, (name, kind) in enumerate((("range", pa.int32()), ("lo", pa.binary()), ("hi", pa.binary()), ("who", pa.binary()), ("place", pa.binary()))):
        out[name] = pa.array([*[None] * n, *[k[i] for k in keys]], kind)
    return pa.table(out)


def shared_strings(lists: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Of sorted lists of keys (lo, hi, ...): which strings, of all one after the other, another list holds too.

    A list holds a key once. Keys become one number each, by the places of their halves; each is looked up in the sorted
    numbers of all lists by binary search.
    """
    lo, hi = [np.concatenate([piece[i] for piece in lists]) for i in (0, 1)]
    low, high = np.unique(lo), np.unique(hi)
    keys = np.searchsorted(low, lo) * len(high) + np.searchsorted(high, hi)
    merged = np.sort(keys)
    return np.searchsorted(merged, keys, side="right") - np.searchsorted(merged, keys, side="left") > 1


def _merge(table: pa.Table, slots: int) -> pa.Table:
    """Of the sorted key lists of a range: the strings that another list holds too."""
    kinds = (np.uint64, np.uint64, np.int64, np.int32)
    columns = [table.column(c).to_pylist() for c in ("lo", "hi", "who", "place")]
    lists = [tuple(np.frombuffer(raw, kind) for raw, kind in zip(row, kinds)) for row in zip(*columns)]
    who, place = [np.concatenate([piece[i] for piece in lists]) for i in (2, 3)]
    who = who.reshape(-1, 2)
    found = np.flatnonzero(shared_strings(lists) & (place >= 0))
    return parts(who[found], place[found], place[found] + 1, slots)


def _remove(with_text: bool):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split()[0] for p in RESULT.split(", ")]
        for batch in C.slices(batches):
            out = []
            text = pc.fill_null(batch.column("text"), "")
            copied = _copied(batch, text)
            runs = zip(batch.column("begins").to_pylist(), batch.column("ends").to_pylist())
            for raw, copy, (begins, ends) in zip(text.cast(pa.binary()).to_pylist(), copied, runs):
                kept, spans = raw, 0
                if copy:
                    kept, spans = b"", 1
                elif begins:
                    mark = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(mark, np.array(begins, np.int64), 1)
                    np.subtract.at(mark, np.array(ends, np.int64) + MATCH - 1, 1)
                    gone = np.cumsum(mark[:-1]) > 0
                    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return step


def _shared_anchors(docs: DataFrame, buckets: int) -> tuple[DataFrame, int]:
    """(row_key, anchors): the shared anchors of each row, each with the number of shards it is dealt to; and their number."""
    found = stored(found_keys(C.map_arrow(docs, _pack_anchors(buckets), PACKED), buckets).select("row_key", F.explode(F.array_distinct("keys")).alias("key")))
    parts = F.ceil(F.count("*") / SPLIT_ROWS).cast("int").alias("parts")
    split = stored(found.groupBy("key").agg(parts).where("parts > 1"))
    listed = found.join(split, "key", "left").select("row_key", F.struct("key", F.coalesce("parts", F.lit(1)).alias("parts")).alias("a"))
    return stored(listed.groupBy("row_key").agg(F.collect_list("a").alias("anchors"))), found.count()


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (bytes) if asked for, one row per input row."""
    docs = C.keyed(docs)
    ship_package(docs.sparkSession)
    copies = stored(C.copies(docs).drop("first_id"))
    anchors, number = _shared_anchors(docs, bucket_count(docs))
    near = docs.join(anchors, "row_key").join(copies, "row_key", "left")
    shards = max(8, -(-number * SPAN_BYTES // SHARD_BYTES))
    spans = C.map_arrow(near, _pack_spans(shards), SPANS)
    solved = stored(spans.groupBy("bucket", "part").applyInArrow(_shard(shards), SHARD))
    ranges = solved.where("range is not null").groupBy("range")
    merged = ranges.applyInArrow(lambda table: _merge(table, shards), PARTS)
    runs = solved.where("range is null").select(*merged.columns).unionByName(merged)
    runs = stored(collected(runs, "int", ("begins", "ends")))
    rows = docs.join(runs, "row_key", "left").join(copies, "row_key", "left")
    return C.map_arrow(rows, _remove(with_text), RESULT)
