"""Substring deduplication by difference-cover anchors.

A match is `WINDOW` words. Anchors are hashes of `ANCHOR` words that start at the cover positions, those
whose number modulo `PERIOD` is in `COVER`. Every difference modulo the period is one of two cover numbers,
so two equal windows, wherever they start, hold an equal anchor at the same place: that finds every match from
three sevenths of the positions. A window around an anchor that another document shares is then
extended to its full length by a 96-bit hash of all its words, and the windows' documents are compared:
a window is removed where a document with a smaller id has it.

Anchors and windows are matched by `shared.found_keys`, whose shuffles are packed and whose hot keys are
merged before they travel. A text that a smaller id has in whole needs no windows: all of it goes.

Edge cases: null text has no words; a text shorter than a window keeps all words; rows with equal ids
never remove each other's words, nor do rows without id, whose ids count as larger than all others;
repeated rows get a row each; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from folioflow.llm import common as C
from folioflow.llm.shared import KEYS_HELD, PACKED, bucket_count, found_keys, pack_slices
from folioflow.session import stored

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
SLICE_BYTES = 1 << 20

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def cover_positions(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, row) of each anchor start: cover positions with room for an anchor, in rows with room for a window."""
    sizes = np.diff(first)
    row = C.owners(first)
    place = np.arange(first[-1]) - first[row]
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    at = np.flatnonzero(cover[place % PERIOD] & (place + ANCHOR <= sizes[row]) & (sizes[row] >= WINDOW))
    return at, row[at]


def _anchors(words: np.ndarray, first: np.ndarray):
    at, row = cover_positions(first)
    return at, row, C.window_hashes(words, ANCHOR)[at] if len(at) else np.zeros(0, np.uint64)


def _pack_anchors(buckets: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in C.slices(batches, limit=SLICE_BYTES):
            data, offsets = C.text_bytes(pc.fill_null(batch.column("text"), ""))
            starts, ends, first = C.word_bounds(data, offsets)
            _, row, keys = _anchors(C.word_hashes(data, starts, ends), first)
            yield keys, row, C.row_keys(batch.column("row_key"))

    return lambda batches: pack_slices(found(batches), buckets, KEYS_HELD)


def _window_starts(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Per row the places of windows around shared anchors."""
    data, offsets = C.text_bytes(pc.fill_null(batch.column("text"), ""))
    starts, ends, first = C.word_bounds(data, offsets)
    at, row, keys = _anchors(C.word_hashes(data, starts, ends), first)
    shared = pa_lists(batch.column("keys"))
    edges = np.searchsorted(row, np.arange(len(first)))
    out = []
    for i in range(batch.num_rows):
        own = slice(edges[i], edges[i + 1])
        hit = at[own][np.isin(keys[own], shared[i])] - first[i]
        last = first[i + 1] - first[i] - WINDOW
        around = np.unique((hit[:, None] - np.arange(PERIOD)).ravel())
        out.append(around[(around >= 0) & (around <= last)].astype(np.int32))
    return out


def pa_lists(column: pa.Array) -> list[np.ndarray]:
    return [np.array([] if x is None else x, np.int64).view(np.uint64) for x in column.to_pylist()]


def _keys(data, starts, ends, at) -> tuple[np.ndarray, np.ndarray]:
    """64 bits and 32 more of the windows that start at the given words."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    lo, hi = [C.window_hashes(C.word_hashes(data, starts, ends, seed), WINDOW, seed)[at] for seed in (1, 2)]
    return lo, (hi >> np.uint64(32)).astype(np.uint32)


def _copy(batch: pa.RecordBatch) -> pa.Array:
    """Rows whose whole text a smaller id has."""
    own = pc.fill_null(batch.column("doc_id"), C.NO_ID)
    return pc.fill_null(pc.less(batch.column("first_id"), own), False)


def _pack_windows(buckets: int):
    """Windows around shared anchors, of rows that are no copies."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for whole in C.slices(batches, limit=SLICE_BYTES):
            batch = whole.filter(pc.and_(pc.is_valid(whole.column("keys")), pc.invert(_copy(whole))))
            if not batch.num_rows:
                continue
            found = _window_starts(batch)
            data, offsets = C.text_bytes(batch.column("text"))
            starts, ends, first = C.word_bounds(data, offsets)
            row = np.repeat(np.arange(batch.num_rows), [len(f) for f in found])
            lo, hi = _keys(data, starts, ends, np.concatenate(found).astype(np.int64) + first[row])
            yield lo, row, C.row_keys(batch.column("row_key")), hi, C.ids(batch.column("doc_id"))

    return lambda batches: pack_slices(keys(batches), buckets, KEYS_HELD)


def _remove(with_text: bool):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=SLICE_BYTES):
            text = pc.fill_null(batch.column("text"), "")
            data, offsets = C.text_bytes(text)
            starts, ends, first = C.word_bounds(data, offsets)
            gone = pa_lists(batch.column("keys"))
            mark = np.zeros(len(starts) + 1, np.int64)
            if any(len(g) for g in gone):
                windows = C.window_hashes(C.word_hashes(data, starts, ends, 1), WINDOW, 1)
                for i, keys in enumerate(gone):
                    if len(keys):
                        hit = np.flatnonzero(np.isin(windows[first[i] : first[i + 1] - WINDOW + 1], keys)) + first[i]
                        mark[hit] += 1
                        mark[hit + WINDOW] -= 1
            kept = np.cumsum(mark[:-1]) == 0
            sizes = np.diff(first)
            for i in np.flatnonzero(_copy(batch).to_numpy(zero_copy_only=False) & (sizes >= WINDOW)):
                kept[first[i] : first[i + 1]] = False
            left = np.add.reduceat(np.append(kept, False), first[:-1]) * (sizes > 0) if len(starts) else sizes
            raw = data.tobytes()
            digests, texts = [], []
            for i in range(batch.num_rows):
                if left[i] == sizes[i]:
                    rest = b" ".join(raw[offsets[i] : offsets[i + 1]].split())
                else:
                    own = np.flatnonzero(kept[first[i] : first[i + 1]]) + first[i]
                    rest = b" ".join([raw[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist())])
                digests.append(hashlib.sha256(rest).hexdigest())
                texts.append(rest.decode() if with_text else None)
            columns = [batch.column("doc_id"), pa.array(sizes), pa.array(sizes - left), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return step


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and kept_text if asked for, one row per input row.

    Each step is a written table of narrow rows; the texts are read for every step and shuffled twice, to meet
    the anchors and to meet the windows.
    """
    docs = C.keyed(docs)
    buckets = bucket_count(docs)
    copies = stored(C.copies(docs).drop("first_key"))
    anchors = stored(found_keys(C.map_arrow(docs, _pack_anchors(buckets), PACKED), buckets))
    near = docs.join(anchors, "row_key").join(copies, "row_key", "left")
    windows = stored(found_keys(C.map_arrow(near, _pack_windows(buckets), PACKED), buckets))
    rows = docs.join(windows, "row_key", "left").join(copies, "row_key", "left")
    return C.map_arrow(rows, _remove(with_text), RESULT)
