"""Shared helpers: document keys, Arrow slices, numpy word and window hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from folioflow.session import ship_package, stored

# Blank bytes of the word pattern [^\x20\x09-\x0D]+.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
# What one step of a task holds at a time, in bytes of text; a longer document is a step of its own.
SLICE_BYTES = 1 << 20
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """128 bits of id and text: equal rows share a key, and so their result."""
    return F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "doc_id", "text").alias("b")).alias("row_key")


def row_keys(column: pa.Array) -> np.ndarray:
    """Row keys as rows of two numbers; zeros where there is none."""
    return np.column_stack([pc.fill_null(half, 0).to_numpy(zero_copy_only=False) for half in column.flatten()])


def keyed(docs: DataFrame) -> DataFrame:
    """row_key, doc_id (long, may be null), text; other columns are left behind."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.select(row_key(), "doc_id", "text")


def map_arrow(df: DataFrame, step, schema: str | T.StructType) -> DataFrame:
    """`mapInArrow` with this package's code at hand on every worker."""
    ship_package(df.sparkSession)
    return df.mapInArrow(step, schema)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def per_row(docs: DataFrame, carry: list[str], compute, fields: str, text: str = "text") -> DataFrame:
    """The columns `carry` of docs and those that `compute` makes of the text, row for row.

    compute: string array without nulls -> arrays, in the order of `fields`. Columns are told apart by
    place inside, so a column of docs may have any name; one that clashes with `fields` keeps its values
    under `docs`' name only if it is in `carry`, and the caller picks by position.
    """
    names = [f"c{i}" for i in range(len(carry))]
    at = names[carry.index(text)] if text in carry else "t"
    chosen = [F.col(quoted(c)).alias(n) for c, n in zip(carry, names)]
    inner = docs.select(*chosen, *([] if at != "t" else [F.col(text).cast("string").alias("t")]))
    made = T.StructType.fromDDL(fields)
    schema = T.StructType([inner.schema[n] for n in names] + made.fields)
    arrow = to_arrow_schema(made).types

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            arrays = compute(pc.fill_null(batch.column(at), ""))
            arrays = [a if isinstance(a, pa.Array) else pa.array(a, t) for a, t in zip(arrays, arrow)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *arrays], schema.names)

    out = map_arrow(inner, step, schema)
    return out.toDF(*carry, *made.names)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds at most `limit` bytes of the column, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_offsets(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def text_offsets(array: pa.Array) -> np.ndarray:
    """Byte offsets of a string column's rows in its data; null rows are empty."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    raw = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    return raw[array.offset : array.offset + len(array) + 1].astype(np.int64)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows in a run, offsets of the rows from 0)."""
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = text_offsets(array)
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK):
    """(starts, ends, first): byte bounds of the words, and each row's first word; words never cross rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~blank[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (public domain constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _base(seed: int) -> tuple[np.ndarray, int, int]:
    """A random value per byte, an odd multiplier and its inverse modulo 2^64."""
    values = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % (1 << 64)))
    multiplier = int(values[7]) | 5
    return values, multiplier, pow(multiplier, -1, 1 << 64)


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept up to the usual slice."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        out = np.full(max(n, min(SLICE_BYTES, 2 * n)), base, np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if len(out) > 2 * SLICE_BYTES:
            return out[:n]
        if len(_powers) > 12:
            _powers.clear()
        _powers[base] = held = out
    return held[:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of values[start:end] for every pair: a polynomial from running sums, finalised."""
    _, base, inverse = _base(seed)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values)), out=total[1:])
    poly = (total[ends] - total[starts]) * _power(inverse, len(values) + 1)[starts]
    return mix(poly + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash per word. fold: byte to byte, as for lower case."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = _base(seed)[0]
    return range_hash((values if fold is None else values[fold])[data], starts, ends, seed)


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every `size` words in a row; the caller drops those that cross rows."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return range_hash(words, at, at + size, seed + 100)


def owners(first: np.ndarray) -> np.ndarray:
    """The row of each word, from each row's first word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ids(array: pa.Array) -> np.ndarray:
    """Document ids; null sorts last."""
    return array.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def copies(docs: DataFrame) -> DataFrame:
    """(row_key, first_id, first_key): rows whose whole text others have too, with the least id and key among them.

    docs: `keyed` rows. Narrow columns only; both sides of the join are plain shuffles, which Spark splits
    where thousands of rows share a text. A null id counts as larger than all others.
    """
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5")
    rows = docs.select("row_key", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), text)
    least = [F.min("doc_id").alias("first_id"), F.min("row_key").alias("first_key")]
    groups = stored(rows.groupBy("text_md5").agg(F.count("*").alias("n"), *least).where("n > 1").drop("n"))
    return rows.join(groups, "text_md5").select("row_key", "first_id", "first_key").distinct()
