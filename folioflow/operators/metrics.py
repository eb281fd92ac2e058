"""Counters and summaries, always derived from rows: a retried task never counts twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.functions import text


def _count(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def _landing_aggregates(status: Column) -> list[Column]:
    return [
        _count(status == S.STORED, "stored"),
        _count(status == S.UNCHANGED, "unchanged"),
        _count(status == "failed", "failed"),
        # Failures are dropped rows as well.
        _count(status.isin("dropped", "failed"), "dropped"),
    ]


def _transform_aggregates(done: Column, failed: str) -> list[Column]:
    return [_count(done.isin("ok", "skipped"), "processed"), _count(done == "failed", failed)]


def landing_counters(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows stored, unchanged, failed and dropped, from the `outcome` of each row."""
    grouped = outcomes.groupBy(*(by or []))
    counted = grouped.agg(*_landing_aggregates(F.col("outcome")))
    return counted.withColumn("success", F.col("failed") == 0)


def transform_counters(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows processed (skipped ones included) and failed, from the `outcome` of each row."""
    counted = outcomes.groupBy(*(by or [])).agg(*_transform_aggregates(F.col("outcome"), "failed"))
    return counted.withColumn("success", F.col("failed") == 0)


def transform_result(outcomes: DataFrame, start_month: str, end_month: str) -> DataFrame:
    """One row: the range and its counters."""
    return transform_counters(outcomes).select(
        F.lit(start_month).alias("start_month"),
        F.lit(end_month).alias("end_month"),
        "processed",
        "failed",
    )


def partition_summary(
    landed: DataFrame,
    processed: DataFrame | None = None,
    pages: DataFrame | None = None,
    elapsed_seconds: float = 0.0,
) -> DataFrame:
    """Run metrics per body and month, with the first and last day of the month.

    Absent figures are 0. The inputs go into one aggregation as tagged rows, so that rows without
    body or month make one partition, like any other.
    """
    keys = ["body", "partition_date"]
    none = F.lit(None).cast("string")
    rows = landed.select(*keys, F.col("outcome").alias("landed"), none.alias("done"), none.alias("page"))
    if processed is not None:
        done = processed.select(*keys, none.alias("landed"), F.col("outcome").alias("done"), none.alias("page"))
        rows = rows.unionByName(done)
    if pages is not None:
        rows = rows.unionByName(
            pages.select(*keys, none.alias("landed"), none.alias("done"), F.lit("page").alias("page"))
        )
    done = F.col("done")
    first = F.try_to_date(F.concat(F.col("partition_date"), F.lit("-01")), "yyyy-MM-dd")
    counted = rows.groupBy(*keys).agg(
        *_landing_aggregates(F.col("landed")),
        F.count("page").alias("pages_scraped"),
        *_transform_aggregates(done, "transform_failed"),
    )
    numbers = [
        "stored", "unchanged", "failed", "dropped", "pages_scraped", "processed",
        "transform_failed",
    ]
    return counted.select(
        *keys,
        first.alias("start_date"),
        F.last_day(first).alias("end_date"),
        *numbers,
        F.lit(float(elapsed_seconds)).alias("elapsed_seconds"),
    )


def merged_summaries(parts: DataFrame) -> DataFrame:
    """One row per body and month from the summaries of many batches: counters add up, a partition without rows in a batch adds nothing.

    A summary is a partial aggregate with its batch as identity: a batch that is run again replaces its own part, so
    nothing counts twice, and rows are not read again.
    """
    keys = ["body", "partition_date", "start_date", "end_date"]
    numbers = [c for c in S.RUN_METRICS.names if c not in keys]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers], F.count_distinct("v").alias("runs"))


# Fixed names of the exported run statistics and the metric each one feeds.
STATISTICS = {
    "landing_pipeline/stored": "stored",
    "landing_pipeline/unchanged": "unchanged",
    "landing_pipeline/failed": "failed",
    "item_dropped_count": "dropped",
    "downloader/response_count": "pages_scraped",
    "elapsed_time_seconds": "elapsed_seconds",
}


def read_statistics(exports: DataFrame, json: str, return_code: str) -> DataFrame:
    """Typed metrics from exported JSON statistics, and all of them as they came in `raw_stats`.

    A missing figure is 0.
    """
    values = F.from_json(F.col(json), "map<string,string>")
    parsed = exports.withColumn("_values", values)
    metrics = [
        F.coalesce(
            F.col("_values")[key].try_cast("double" if name == "elapsed_seconds" else "long"),
            F.lit(0),
        ).alias(name)
        for key, name in STATISTICS.items()
    ]
    others = [c for c in exports.columns if c != json]
    return parsed.select(
        *others,
        *metrics,
        (F.col(return_code) == 0).alias("success"),
        F.col("_values").alias("raw_stats"),
    )


def export_statistics(metrics: DataFrame) -> DataFrame:
    """One JSON object per row, under the fixed names; values that are not numbers go as text."""
    named = {name: key for key, name in STATISTICS.items()}
    fields = []
    for field in metrics.schema.fields:
        value = F.col(field.name)
        if field.dataType.typeName() not in ("long", "integer", "double", "boolean", "string"):
            value = value.cast("string")
        fields.append(value.alias(named.get(field.name, field.name)))
    return metrics.select(F.to_json(F.struct(*fields)).alias("statistics"))


def key_collisions(landing: DataFrame) -> DataFrame:
    """Landing keys that more than one identifier uses: the later payload replaced the earlier."""
    pairs = landing.where(text.filled("path_to_file").isNotNull()).select(
        "path_to_file", "identifier"
    )
    counted = pairs.distinct().groupBy("path_to_file").agg(
        F.count("*").alias("identifiers"), F.min("identifier").alias("first_identifier")
    )
    return counted.where("identifiers > 1")
