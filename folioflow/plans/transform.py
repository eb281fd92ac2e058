"""Transform: landing rows of a month range into the processed zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.functions import naming, payload, text
from folioflow.operators.pages import extract_pages
from folioflow.sources.zones import Zone, folder_name

KEPT = ["identifier", "path_to_file", "body", "partition_date", "content_type"]


def process_rows(located: DataFrame) -> DataFrame:
    """Process landing rows that have their `content` attached.

    HTML is cleaned, anything else passes through and never meets Python. The outcome is ok, skipped
    (no path) or failed (no content, or a page that cannot be read).
    """
    is_html = F.coalesce(F.col("content_type") == "text/html", F.lit(False))
    skipped = text.filled("path_to_file").isNull()
    outcome = F.when(skipped, "skipped").when(F.col("content").isNull(), "failed")
    rows = located.select(*KEPT, "content", outcome.alias("outcome"))
    markup = rows.where(is_html).select(
        *KEPT, "outcome", text.decode_bytes("content").alias("page_html")
    )
    others = rows.where(~is_html).select(
        *KEPT,
        "outcome",
        F.col("content").alias("raw"),
        F.lit(None).cast("string").alias("cleaned_html"),
        F.lit(None).cast("string").alias("error"),
    )
    read = extract_pages(markup, "page_html", ["cleaned_html"], [*KEPT, "outcome"])
    read = read.withColumn("raw", F.lit(None).cast("binary")).unionByName(others)
    content = F.coalesce(F.col("raw"), F.col("cleaned_html").cast("binary"))
    outcome = F.when(F.col("error").isNotNull(), "failed").otherwise(
        F.coalesce("outcome", F.lit("ok"))
    )
    key = naming.processed_key(
        "body", "partition_date", "identifier", naming.processed_extension("content_type")
    )
    done = read.select(
        "identifier",
        "body",
        "partition_date",
        outcome.alias("outcome"),
        F.when(outcome == "failed", F.coalesce("error", F.lit("no content"))).alias("reason"),
        key.alias("path_to_file"),
        text.or_default("content_type", S.FALLBACK_TYPE).alias("content_type"),
        content.alias("content"),
    )
    ok = F.col("outcome") == "ok"
    return done.withColumns(
        {
            "path_to_file": F.when(ok, F.col("path_to_file")),
            "content": F.when(ok, F.col("content")),
            "file_hash": F.when(ok, payload.content_hash("content")),
        }
    )


def transform(
    landing: Zone,
    processed: Zone,
    batch: int,
    start_month: str,
    end_month: str,
    run_ts: datetime,
    body: str | None = None,
) -> DataFrame:
    """Process every landing row of the range, changed or not; return the outcome of each row.

    Pages are parsed once: the processed payloads are written first, and metadata and counters
    are read back from their narrow columns.
    """
    done = ["identifier", "body", "partition_date", "outcome", "reason"]
    path = f"{processed.path}/processing/v={batch}"
    if batch <= processed.cases.last_batch():
        return processed.spark.read.parquet(path).select(*done)

    metadata = landing.cases.scan_months(start_month, end_month, body)
    rows = process_rows(landing.content.attach(metadata.select(*KEPT)))
    month = folder_name("partition_date")
    rows.withColumn("month", month).write.mode("overwrite").option(
        "maxRecordsPerFile", landing.content.ROWS_PER_FILE
    ).partitionBy("month").parquet(path)

    schema = S.extended(rows.schema, "month string")
    written = processed.spark.read.schema(schema).parquet(path)
    ok = written.where("outcome = 'ok'").select("identifier", "path_to_file", "file_hash")
    extended = (
        metadata.drop("path_to_file", "file_hash")
        .join(ok, "identifier")
        .withColumn("processed_at", F.lit(run_ts).cast("timestamp"))
    )
    processed.cases.publish(
        batch, extended.select(*S.PROCESSED_CASES.names), S.PROCESSED_SUPPLIED
    )
    return written.select(*done)


def processed_content(processed: Zone) -> DataFrame:
    """The processed payload in force at each path: that of the newest batch."""
    schema = S.extended(S.CONTENT, "outcome string, identifier string, v bigint")
    every = processed.spark.read.schema(schema).parquet(f"{processed.path}/processing")
    ok = every.where("outcome = 'ok'")
    newest = ok.groupBy("path_to_file").agg(
        F.max(F.struct("v", "identifier")).alias("n")
    ).select("path_to_file", "n.v", "n.identifier")
    return ok.join(newest, ["path_to_file", "v", "identifier"], "left_semi").select(
        *S.CONTENT.names
    )
