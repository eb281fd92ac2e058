"""Landing: change detection, content of stored rows, metadata of all rows, counters."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.functions import payload, text
from folioflow.operators import cases
from folioflow.operators.upsert import latest
from folioflow.sources.zones import Zone


class Captured(NamedTuple):
    """Incoming cases without their payloads, and the payloads by `payload_id`.

    `cases` has a `file_hash` and a `payload_id`; `payloads` has `payload_id, content_bytes,
    content_html, link_to_doc, content_type`.
    """

    cases: DataFrame
    payloads: DataFrame


def stored_content(
    incoming: DataFrame, decisions: DataFrame, by: str = "seq"
) -> DataFrame:
    """Payloads of stored rows; where rows share a path the last one counts.

    One join sees payloads. Its other side holds the stored rows only and is narrow, from a written
    table, so the planner broadcasts it while it is small, and otherwise filters the payloads by it
    before it shuffles what is left.
    """
    winners = (
        decisions.where(F.col("scrape_status") == S.STORED)
        .groupBy("path_to_file")
        .agg(F.max_by(F.struct(by, "file_hash"), "seq").alias("w"))
        .select("path_to_file", f"w.{by}", "w.file_hash")
    )
    blobs = incoming.select(
        by,
        payload.build_payload("content_bytes", "content_html", "link_to_doc").alias("content"),
        text.or_default("content_type", S.FALLBACK_TYPE).alias("content_type"),
    )
    return blobs.join(winners, by).select(*S.CONTENT.names)


def batch_outcomes(zone: Zone, batch: int) -> DataFrame:
    """The outcome of each row of a landed batch, from its staged steps."""
    columns = ["seq", "identifier", "body", "partition_date", "outcome", "reason"]
    decisions = zone.staged("decisions", batch).withColumns(
        {"outcome": F.col("scrape_status"), "reason": F.lit(None).cast("string")}
    )
    rejects = cases.rejected(zone.staged("prepared", batch))
    return decisions.select(*columns).unionByName(rejects.select(*columns))


def land(
    incoming: DataFrame | Captured, zone: Zone, batch: int, run_ts: datetime
) -> DataFrame:
    """Land a batch of cases and return the outcome of each row.

    `incoming` has the columns of INCOMING_CASES with a unique `seq`, and may have an `error`.
    Content is written before metadata. A batch number landed before is not landed again.
    """
    payloads, by = incoming, "seq"
    if isinstance(incoming, Captured):
        incoming, payloads, by = incoming.cases, incoming.payloads, "payload_id"
    if batch <= zone.cases.last_batch():
        return batch_outcomes(zone, batch)

    prepared = zone.stage("prepared", batch, cases.prepare_cases(incoming))
    rows = cases.valid(prepared)
    changes = cases.detect_changes(rows, zone.cases.state(rows))
    decisions = zone.stage("decisions", batch, changes.drop("object_key"))

    zone.content.write(batch, stored_content(payloads, decisions, by))

    rows = latest(decisions, "identifier", "seq").withColumn(
        "scraped_at", F.lit(run_ts).cast("timestamp")
    )
    final = zone.stage("latest", batch, rows.select(*S.LANDING_CASES.names))
    zone.cases.publish(batch, final, S.LANDING_SUPPLIED)
    return batch_outcomes(zone, batch)
