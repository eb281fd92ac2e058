"""Positions of rows within their groups, without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import map_arrow
from folioflow.session import small_table, stored


def run_lengths(column: pa.Array, last, count: int) -> np.ndarray:
    """How many equal values in a row precede each one; `count` values equal to `last` came before the first."""
    n = len(column)
    head = np.ones(n, bool)
    if n > 1:
        head[1:] = pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    head[0] = not count or column[0].as_py() != last
    at = np.arange(n)
    begin = np.maximum.accumulate(np.where(head, at, -1))
    return np.where(begin < 0, at + count, at - begin)


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "pos") -> DataFrame:
    """The rows with their place in their group, from 0 and without gaps, nulls first; a written table.

    `group` is a column without nulls. The rows are sorted in ranges of (group, order), so a group of any size
    spreads over as many ranges as it fills. Only the first group of a range can have begun before it: one row per
    range, as many as there are partitions, says how many of its rows came before, and is broadcast.
    """
    keys = [group, *[c for c in order if c != group]]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("_local", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(group)
            local = run_lengths(column, last, held)
            last, held = column[-1].as_py(), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], schema.names)

    local = stored(map_arrow(ranged, count, schema))
    ends = local.groupBy("_range").agg(F.min(group).alias("first"), F.max(group).alias("last"), F.max_by("_local", F.struct(group, "_local")).alias("n"))
    begun, open_group, held = [], None, 0
    for piece in sorted(ends.collect(), key=lambda r: r["_range"]):
        before = held if piece.first == open_group else 0
        if before:
            begun.append((piece["_range"], piece.first, before))
        held = piece.n + 1 + (before if piece.last == piece.first else 0)
        open_group = piece.last
    kinds = T.StructType([T.StructField("_range", T.IntegerType()), T.StructField(group, rows.schema[group].dataType), T.StructField("_before", T.LongType())])
    offsets = small_table(rows.sparkSession, begun, kinds)
    placed = local.join(F.broadcast(offsets), ["_range", group], "left")
    return placed.select(*rows.columns, (F.col("_local") + F.coalesce("_before", F.lit(0))).alias(name))
