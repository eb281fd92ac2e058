"""Streaming change detection with state per identifier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from folioflow.operators.cases import ROWS_PER_GROUP, detect_changes
from folioflow.operators.upsert import latest
from folioflow.schemas import STORED, UNCHANGED
from folioflow.session import stored
from folioflow.sources.runs import KeyTable

STATE = T.StructType(
    [T.StructField("file_hash", T.StringType()), T.StructField("path_to_file", T.StringType())]
)
CHANGES = T.StructType(
    [
        T.StructField("identifier", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("scrape_status", T.StringType()),
        T.StructField("path_to_file", T.StringType()),
    ]
)
COLUMNS = ["identifier", "seq", "file_hash", "object_key"]
IDENTIFIER = T.StructType([T.StructField("identifier", T.StringType())])
# Buckets of identifiers that share a call; part of the state's keys, so fixed for the life of a checkpoint.
BUCKETS = 4096


def change_detector() -> StatefulProcessor:
    """Keeps hash and path of the last row of each identifier, in a map for each bucket of identifiers.

    A bucket's rows are judged together, as columns; per identifier there is one look into the map at most
    and, where something changed, one entry written. So the cost of a call is paid per bucket.

    The class is local, so it travels by value: the process that prepares the state runs without
    the files shipped to the workers.
    """

    def _plain(value):
        return None if pd.isna(value) else value

    class ChangeDetector(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._last = handle.getMapState("last", IDENTIFIER, STATE)
            self._given = (None, {})

        def handleInitialState(self, key, initialState, timerValues) -> None:
            given = self._given[1] if self._given[0] == key else {}
            for row in initialState.drop_duplicates("identifier").itertuples(index=False):
                given[_plain(row.identifier)] = value = (_plain(row.file_hash), _plain(row.path_to_file))
                self._last.updateValue((_plain(row.identifier),), value)
            self._given = (key, given)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows), ignore_index=True)
            codes, names = pd.factorize(batch["identifier"], use_na_sentinel=False)
            order = np.lexsort((batch["seq"], codes))
            batch, codes = batch.iloc[order], codes[order]
            # Codes run from 0 without gaps, so they number the identifiers' first rows.
            first = np.flatnonzero(np.diff(codes, prepend=-1))
            last = np.append(first[1:], len(codes)) - 1
            names = [_plain(name) for name in names]
            # Right after a bucket's initial state, that is all its map holds.
            given = self._given[1] if self._given[0] == key else None
            known = [self._last.getValue((name,)) if given is None else given.get(name) for name in names]
            self._given = (None, {})
            old_paths = np.array([k[1] if k else None for k in known], object)

            # A value no hash can have stands for a missing one, so that two of them are equal.
            hashes = batch["file_hash"].astype(object).where(batch["file_hash"].notna(), "").to_numpy()
            before = np.append([""], hashes[:-1])
            before[first] = [k and k[0] or "" for k in known]
            changed = hashes != before
            changed[first] |= [not path for path in old_paths]
            # The last row up to each one that was stored with a key, if its identifier has one.
            keys = batch["object_key"].to_numpy(object)
            at = np.maximum.accumulate(np.where(changed & batch["object_key"].notna().to_numpy(), np.arange(len(codes)), -1))
            path = np.where(at >= first[codes], keys[at], old_paths[codes])

            for name, old, new in zip(names, known, zip(batch["file_hash"].iloc[last], path[last])):
                new = (_plain(new[0]), new[1])
                if old is None or tuple(old) != new:
                    self._last.updateValue((name,), new)
            yield pd.DataFrame(
                {
                    "identifier": batch["identifier"],
                    "seq": batch["seq"],
                    "file_hash": batch["file_hash"],
                    "scrape_status": np.where(changed, STORED, UNCHANGED),
                    "path_to_file": path,
                }
            )

        def close(self) -> None:
            pass

    return ChangeDetector()


def stream_changes(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Status and path of each row of a stream of `identifier, seq, file_hash, object_key`.

    Late rows are compared with the state they find, without a bound on lateness, so no
    watermark is set and state is kept. A task holds a bucket's rows of a micro-batch: bound the micro-batch at the source
    (files per trigger); where one identifier may fill it beyond a task's memory, use `land_changes`, which holds no identifier's rows together.
    """
    bucket = F.pmod(F.xxhash64("identifier"), F.lit(BUCKETS)).cast("int").alias("bucket")
    initial = None
    if existing is not None:
        initial = existing.select(bucket, "identifier", "file_hash", "path_to_file").groupBy("bucket")
    return (
        rows.select(bucket, *COLUMNS)
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=change_detector(),
            outputStructType=CHANGES,
            outputMode="append",
            timeMode="none",
            initialState=initial,
        )
    )


def land_changes(
    rows: DataFrame, folder: str, checkpoint: str, existing: DataFrame | None = None, rows_per_group: int = ROWS_PER_GROUP
) -> StreamingQuery:
    """Status and path of each row of a stream, written below `folder`; `read_changes` reads them.

    A micro-batch is cut into ranges of its identifiers' `seq`; each is reduced to one transition (first hash, last
    hash, last stored key), the transitions of an identifier are composed with its state in order, and the rows of a range are settled by what
    comes in. A task holds a range, about `rows_per_group` rows of an identifier, and spills beyond its memory; what is
    held per identifier and range is one row. State is kept in runs by identifier, of which a micro-batch
    opens the ranges of its own. A micro-batch that is replayed is written again, or left alone if its state was published.
    """
    spark = rows.sparkSession
    state = KeyTable(spark, f"{folder}/state", "identifier", T.StructType([CHANGES["identifier"], *STATE.fields]))
    if existing is not None:
        state.add(0, stored(existing.select("identifier", "file_hash", "path_to_file")))

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id + 1 <= state.upto():
            return
        own = stored(batch.select(*COLUMNS))
        changes = detect_changes(own, state.lookup(own.select("identifier").distinct()), rows_per_group)
        out = f"{folder}/changes/batch={batch_id}"
        changes.select(*CHANGES.names).write.mode("overwrite").parquet(out)
        last = latest(spark.read.schema(CHANGES).parquet(out), "identifier", "seq")
        state.add(batch_id + 1, stored(last.select("identifier", "file_hash", "path_to_file")))

    query = rows.select(*COLUMNS).writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What `land_changes` wrote, by micro-batch."""
    schema = T.StructType([*CHANGES.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).parquet(f"{folder}/changes")
