"""Streaming landing: each micro-batch of captured cases is landed as one batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from folioflow.plans.land import land
from folioflow.sources.zones import Zone


def stream_landing(
    cases: DataFrame,
    zone: Zone,
    checkpoint: str,
    run_ts: Callable[[], datetime],
    first_batch: int = 0,
) -> StreamingQuery:
    """Land all available cases, micro-batch by micro-batch.

    A micro-batch that is replayed after a failure lands once. One writer numbers the batches of a
    zone: a new checkpoint over a zone with data must start above its last batch.
    """

    def land_batch(rows: DataFrame, batch_id: int) -> None:
        land(rows, zone, first_batch + batch_id, run_ts())

    return (
        cases.writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
