"""Keys that several documents hold, found by one shuffle of packed key lists.

The slices of a task are gathered up to `KEYS_HELD` keys; a gathering gives its distinct 64-bit keys sorted, cut by binary search
at the bounds of `buckets` equal ranges, one packed row per range. Within a gathering a key that several rows hold is sent
once, and those rows are answered on the spot; so the entries of a key that a third of all documents
hold number at most one per gathering. The rows of a range meet in one task and are merged by sorting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm import common as C
from folioflow.session import ship_package

PACKED = "bucket int, lo binary, hi binary, who binary, docs binary, ids binary"
PARTS = "slot int, docs binary, a binary, b binary"
# Text behind one bucket: the number of buckets follows the measured size of the corpus.
BUCKET_BYTES = 16 << 20
# Keys that a task gathers before it packs them, and answers that one packed row holds at most.
KEYS_HELD = 1 << 20
TOLD_EACH = 1 << 16
MANY = np.uint32(0xFFFFFFFF)


def bucket_count(docs: DataFrame, bytes_each: int = BUCKET_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(8, -(-size // bytes_each))


def _pack(sorted_keys: np.ndarray) -> bytes:
    """Differences, byte planes together: the leading planes are nearly empty and compress well."""
    steps = np.diff(sorted_keys, prepend=np.uint64(0))
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8")[:, 0], dtype=np.uint64)


def _rows(bucket: int, lo, hi, who, docs, ids) -> tuple:
    """One packed row: who numbers the documents that occur in it."""
    known = who != MANY
    used, at = np.unique(who[known], return_inverse=True)
    own = np.full(len(who), MANY, np.uint32)
    own[known] = at
    wide = np.uint16 if len(used) < 0xFFFF else np.uint32
    own = np.where(own == MANY, np.iinfo(wide).max, own).astype(wide)
    return bucket, _pack(lo), b"" if hi is None else hi.tobytes(), own.tobytes(), docs[used].tobytes(), b"" if ids is None else ids[used].tobytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in PACKED.split(", ")]
    kinds = [pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)


def pack_slices(slices: Iterator[tuple], buckets: int, limit: int, within: bool = False) -> Iterator[pa.RecordBatch]:
    """Packed rows of the slices (lo, who, docs[, hi, ids]) of a task, gathered up to `limit` keys; `who` counts the rows of its slice."""
    held, keys, rows = [], 0, 0
    for lo, who, docs, *more in slices:
        held.append((lo, (who + rows).astype(np.uint32), docs, *more))
        keys, rows = keys + len(lo), rows + len(docs)
        if keys >= limit:
            yield from pack_slice(*[np.concatenate(c) for c in zip(*held)], buckets=buckets, within=within)
            held, keys, rows = [], 0, 0
    if held:
        yield from pack_slice(*[np.concatenate(c) for c in zip(*held)], buckets=buckets, within=within)


def pack_slice(lo, who, docs, hi=None, ids=None, *, buckets: int, within: bool = False) -> Iterator[pa.RecordBatch]:
    """Packed rows of the keys gathered.

    lo, hi: keys, of 64 and if need be 32 more bits; who: the row of each key; docs, ids: row keys (two numbers) and document ids by row. Without ids a
    key is found in every row that shares it; with ids in every row whose id is not the key's least.
    within: a key that comes twice in one row is shared too.
    """
    if not len(lo):
        return
    order = np.lexsort((who, lo) if hi is None else (who, ids[who], hi, lo))
    lo, who = lo[order], who[order]
    hi = None if hi is None else hi[order]
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] != lo[:-1]
    if hi is not None:
        new[1:] |= hi[1:] != hi[:-1]
    times = np.diff(np.append(np.flatnonzero(new), len(lo)))
    once = new.copy()
    once[1:] |= who[1:] != who[:-1]  # each key once per row
    lo, who, new = lo[once], who[once], new[once]
    hi = None if hi is None else hi[once]
    group = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    if ids is None:
        shared = (times if within else np.diff(np.append(heads, len(lo))))[group] > 1
        keep = new
        sent = np.where(shared, MANY, who)[keep]
    else:
        least = ids[who[heads]][group]
        shared = ids[who] > least
        keep = ~shared
        sent = who[keep]
    rows = []
    answered = np.flatnonzero(shared)
    for start in range(0, len(answered), TOLD_EACH):
        told = answered[start : start + TOLD_EACH]
        spread = -1 - (int(docs[who[told[0]], 0]) + start // TOLD_EACH) % buckets
        rows.append(_rows(spread, lo[told], None, who[told], docs, None))
    lo, hi = lo[keep], None if hi is None else hi[keep]
    bounds = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)
    cuts = [0, *np.searchsorted(lo, bounds).tolist(), len(lo)]
    for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            rows.append(_rows(bucket, lo[a:b], None if hi is None else hi[a:b], sent[a:b], docs, ids))
    yield _batch(rows)


def _merge(table: pa.Table, slots: int) -> pa.Table:
    """The entries of a bucket that other documents share, as `parts`."""
    lo, hi, who, ids, part = [], [], [], [], []
    for i, (_, l, h, w, d, n) in enumerate(zip(*[c.to_pylist() for c in table.columns])):
        keys = _unpack(l)
        wide = np.uint16 if len(w) == 2 * len(keys) else np.uint32
        at = np.frombuffer(w, wide)
        many = at == np.iinfo(wide).max
        docs = np.frombuffer(d, np.int64).reshape(-1, 2)
        lo.append(keys)
        who.append((np.append(docs, [[0, 0]], axis=0)[np.where(many, len(docs), at)], many))
        part.append(np.full(len(keys), i, np.int32))
        if h:
            hi.append(np.frombuffer(h, np.uint32))
            ids.append(np.frombuffer(n, np.int64)[at])
    keys = np.concatenate(lo)
    docs = np.concatenate([d for d, _ in who])
    many = np.concatenate([m for _, m in who])
    if table.column("bucket")[0].as_py() < 0:
        found = np.ones(len(keys), bool)
    else:
        high = np.concatenate(hi) if hi else None
        order = np.argsort(keys, kind="stable") if high is None else np.lexsort((high, keys))
        keys, docs, many = keys[order], docs[order], many[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        if high is not None:
            high = high[order]
            new[1:] |= high[1:] != high[:-1]
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        if high is None:
            found = (np.diff(np.append(heads, len(keys)))[group] > 1) & ~many
        else:
            own = np.concatenate(ids)[order]
            found = own > np.minimum.reduceat(own, heads)[group]
    return parts(docs[found], keys[found], None, slots)


def parts(docs: np.ndarray, a: np.ndarray, b: np.ndarray | None, slots: int) -> pa.Table:
    """Values with the row they belong to, packed by slot of the row key: a row per slot, not per document."""
    slot = (C.mix(docs[:, 0].astype(np.uint64)) % np.uint64(slots)).astype(np.int64)
    by = np.argsort(slot, kind="stable")
    slot, docs, a = slot[by], docs[by], a[by]
    cut = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(slot))
    pieces = lambda x: pa.array([b"" if x is None else x[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary())
    return pa.table({"slot": pa.array(slot[cut], pa.int32()), "docs": pieces(docs.astype(np.int64)), "a": pieces(a), "b": pieces(None if b is None else b[by])})


def collected(packed: DataFrame, kind: str, names: tuple[str, ...]) -> DataFrame:
    """One row per document row: row_key and an array for each of `names`, from `parts` rows."""
    ship_package(packed.sparkSession)
    number = {"long": np.int64, "int": np.int32}[kind]

    def lists(table: pa.Table) -> pa.Table:
        docs = np.frombuffer(b"".join(table.column("docs").to_pylist()), np.int64).reshape(-1, 2)
        by = np.lexsort((docs[:, 1], docs[:, 0]))
        docs = docs[by]
        heads = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]).any(axis=1))) if len(docs) else np.zeros(0, np.int64)
        bounds = pa.array(np.append(heads, len(docs)), pa.int32())
        out = {"row_key": pa.StructArray.from_arrays([pa.array(docs[heads, i]) for i in (0, 1)], ["a", "b"])}
        for name, column in zip(names, ("a", "b")):
            values = np.frombuffer(b"".join(table.column(column).to_pylist()), number)[by]
            out[name] = pa.ListArray.from_arrays(bounds, pa.array(values))
        return pa.table(out)

    schema = ", ".join(["row_key struct<a: long, b: long>", *[f"{name} array<{kind}>" for name in names]])
    return packed.groupBy("slot").applyInArrow(lists, schema)


def found_keys(packed: DataFrame, buckets: int) -> DataFrame:
    """(row_key, keys): per document row the keys found, from `pack_slice` rows."""
    ship_package(packed.sparkSession)

    def merge(table: pa.Table) -> pa.Table:
        return _merge(table, buckets)

    return collected(packed.groupBy("bucket").applyInArrow(merge, PARTS), "long", ("keys",))
