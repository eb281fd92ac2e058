"""Newest values by key, in sorted runs that are looked up through the ranges of keys in their files.

Each batch adds a run: its keys in order, cut into ranges of `RANGE_ROWS`, a file each. Runs have levels: where a
level would hold `DELTAS` of them, they and those of the levels below become one run of the next. So a row is written once
per level, runs are few (a logarithm of the batches), and a merge has as many tasks as it has ranges.

What is known of a run is one entry per range: run, number of the range, level, least and greatest key, rows. The owner of
the runs keeps the entries, with whatever else it publishes. A lookup finds the ranges its keys fall into from the entries
alone and opens no other file: few, where the keys of a batch lie close together, as those of a body and month do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import schemas as S
from folioflow.session import ship_package, small_table

# Runs of a level before they are merged, and rows of a range.
DELTAS, RANGE_ROWS = 8, 250_000

ENTRY = S.KEY_RANGES


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at a path, empty before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return small_table(spark, [], schema)


def ranges_hit(keys: DataFrame, key: str, ranges: list[Row]) -> DataFrame:
    """`folder, bucket` of the ranges that a key falls into, once per task that finds them.

    Ranges of a run do not overlap, so a key has one place among their least keys. `ranges` has one row per file of the
    runs: rows held / RANGE_ROWS, and a few for each run.
    """
    ship_package(keys.sparkSession)
    runs: dict[int, list[tuple]] = {}
    for r in sorted(ranges, key=lambda r: (r.folder, r.low)):
        runs.setdefault(r.folder, []).append((r.low, r.high, r.bucket))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_runs = {folder: [np.array(c, object) for c in zip(*run)] for folder, run in runs.items()}
        told = set()
        for batch in batches:
            asked = batch.column(0).drop_null().unique().to_numpy(zero_copy_only=False)
            found = set()
            for folder, (low, high, bucket) in sorted_runs.items():
                at = np.searchsorted(low, asked, side="right") - 1
                inside = (at >= 0) & (asked <= high[np.maximum(at, 0)])
                found |= {(folder, b) for b in bucket[np.unique(at[inside])].tolist()}
            new = sorted(found - told)
            told |= found
            yield pa.RecordBatch.from_arrays([pa.array([n[i] for n in new], k) for i, k in enumerate((pa.int64(), pa.int32()))], ["folder", "bucket"])

    return keys.select(F.col(key).cast("string").alias(key)).mapInArrow(step, "folder bigint, bucket int")


class KeyRuns:
    """The runs below a folder, by a key column, with the values `schema` has beside it."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType) -> None:
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema
        self._held = S.extended(schema, "written bigint")

    def _open(self, ranges: list[Row]) -> DataFrame:
        """Newest values of the keys in some ranges; no other file is opened."""
        if not ranges:
            return small_table(self.spark, [], self._held)
        folders = [f"{self.path}/v={r.folder}/bucket={r.bucket}" for r in ranges]
        schema = S.extended(self._held, "v bigint, bucket int")
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders)
        rows = rows.where(F.col("bucket").isin(sorted({r.bucket for r in ranges})))
        others = [c for c in self._held.names if c != self.key]
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*others), "written").alias("s"))
        return newest.select(self.key, "s.*").select(*self._held.names)

    def ranges(self, keys: DataFrame, entries: DataFrame) -> list[Row]:
        """The ranges that the keys fall into: what a lookup of them opens."""
        known = entries.where("rows > 0").select("folder", "bucket", "low", "high").collect()
        return ranges_hit(keys, self.key, known).distinct().collect() if known else []

    def lookup(self, keys: DataFrame, entries: DataFrame) -> DataFrame:
        """The values of the given keys that are held."""
        asked = keys.select(self.key)
        return self._open(self.ranges(asked, entries)).join(asked, self.key, "left_semi").select(*self.schema.names)

    def add(self, batch: int, fresh: DataFrame, entries: DataFrame, deltas: int = DELTAS, number: int | None = None) -> DataFrame:
        """Write the values of a batch, unique by key, and return the entries that are in force from now on.

        number: how many they are at most, where that is known.
        """
        levels = {r.level: r for r in entries.groupBy("level").agg(F.count_distinct("folder").alias("n"), F.sum("rows").alias("rows")).collect()}
        level = 0
        while level in levels and levels[level].n + 1 >= deltas:
            level += 1
        rows = fresh.select(*self.schema.names).withColumn("written", F.lit(batch).cast("long"))
        total = (fresh.count() if number is None else number) + sum(levels[lower].rows for lower in levels if lower < level)
        merged = entries.where(F.col("level") < level)
        if level:
            old = self._open(merged.where("rows > 0").select("folder", "bucket").collect())
            rows = rows.unionByName(old.join(fresh.select(self.key), self.key, "left_anti"))
        ranged = rows.repartitionByRange(max(1, -(-total // RANGE_ROWS)), self.key).withColumn("bucket", F.spark_partition_id())
        target = f"{self.path}/v={batch}"
        ranged.sortWithinPartitions("bucket", self.key).write.mode("overwrite").partitionBy("bucket").parquet(target)
        return entries.where(F.col("level") >= level).unionByName(self._described(batch, level))

    def _described(self, batch: int, level: int) -> DataFrame:
        """The entries of a run, from its keys; a run without rows has one as well."""
        schema = T.StructType([self.schema[self.key], T.StructField("bucket", T.IntegerType())])
        held = self.spark.read.schema(schema).parquet(f"{self.path}/v={batch}")
        ranges = held.groupBy("bucket").agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count("*").alias("rows"))
        # As many as the run has files.
        found = [(batch, r.bucket, level, r.low, r.high, r["rows"]) for r in ranges.collect()]
        return small_table(self.spark, found or [(batch, None, level, None, None, 0)], ENTRY)


class KeyTable:
    """Key runs with a list of their own, published batch by batch in one of two slots."""

    _LIST = S.extended(S.KEY_RANGES, "upto bigint, slot int")

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.runs = KeyRuns(spark, f"{self.path}/keys", key, schema)

    def _published(self) -> tuple[int, int, DataFrame]:
        lists = read_or_empty(self.spark, f"{self.path}/index", self._LIST)
        newest = lists.agg(F.max(F.struct("upto", "slot")).alias("n")).select("n.*").first()
        upto, slot = (-1, 1) if newest.upto is None else newest
        return upto, slot, lists.where(F.col("slot") == slot).select(*ENTRY.names)

    def upto(self) -> int:
        """The last batch that was added."""
        return self._published()[0]

    def add(self, batch: int, fresh: DataFrame, deltas: int = DELTAS) -> None:
        """Add the values of a batch, unique by key. A batch added before does nothing."""
        upto, slot, entries = self._published()
        if batch <= upto:
            return
        listed = self.runs.add(batch, fresh, entries, deltas).withColumn("upto", F.lit(batch).cast("long"))
        # The list in force stays untouched until the new one is complete.
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/index/slot={1 - slot}")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The newest values of the given keys that are held."""
        return self.runs.lookup(keys, self._published()[2])
