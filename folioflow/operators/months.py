"""Calendar months, the body x month grid and partition readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.functions import dates, text
from folioflow.session import small_table


def month_partitions(ranges: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """One row per month of each range, from the 1st; the last month ends with the range.

    A range whose months run backwards has no rows.
    """
    end = text.as_column(end)
    months = ranges.withColumn("_end", end).withColumn(
        "start_date", F.explode(dates.months_between_days(start, end))
    )
    return months.withColumns(
        {
            "end_date": F.least(F.last_day("start_date"), F.col("_end").cast("date")),
            "partition_date": dates.month_label("start_date"),
        }
    ).drop("_end")


def body_dimension(spark: SparkSession, bodies: dict[str, str] | None = None) -> DataFrame:
    return small_table(spark, list((bodies or S.BODIES).items()), S.BODY_CODES)


def select_bodies(dimension: DataFrame, names: str | None) -> DataFrame:
    """Bodies named in a comma list; unknown names are ignored, no list means all."""
    if not names:
        return dimension
    return dimension.where(F.col("body").isin([n.strip() for n in names.split(",")]))


def partition_grid(bodies: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """Every body with every month. Each body row explodes into its months, so nothing joins."""
    return month_partitions(bodies, start, end)


def crawl_manifest(grid: DataFrame, search_url: str) -> DataFrame:
    """The search URL of each partition."""
    url = F.format_string(
        search_url.replace("%", "%%") + S.SEARCH_QUERY,
        dates.day_first("start_date"),
        dates.day_first("end_date"),
        F.col("code"),
    )
    return grid.withColumn("url", url)


def run_requests(bodies: DataFrame, day: Column | str) -> DataFrame:
    """One request per body for the month before `day`."""
    month = dates.previous_month_key(day)
    return bodies.select(
        "body",
        month.alias("month_key"),
        F.concat(month, F.lit("|"), F.col("body")).alias("run_key"),
    )


_PARTITION = ["body", "partition_date"]


def _partitions(rows: DataFrame) -> DataFrame:
    return rows.select(*_PARTITION).distinct()


def ready_partitions(grid: DataFrame, landing: DataFrame) -> DataFrame:
    """Grid cells that have landed."""
    return grid.join(_partitions(landing), _PARTITION, "left_semi")


def pending_partitions(landing: DataFrame, processed: DataFrame) -> DataFrame:
    """Landed partitions that have not been processed."""
    return _partitions(landing).join(_partitions(processed), _PARTITION, "left_anti")


def month_range(
    rows: DataFrame, start_month: str, end_month: str, body: str | None = None
) -> DataFrame:
    """Rows of an inclusive month range, compared as text, and optionally of one body."""
    picked = rows.where(F.col("partition_date").between(start_month, end_month))
    return picked.where(F.col("body") == body) if body else picked


def month_range_on_time(rows: DataFrame, time: str, start_month: str, end_month: str) -> DataFrame:
    """The same range on a raw date or time column, in a form that parquet can skip by."""
    first = F.to_date(F.lit(start_month + "-01"))
    after = F.add_months(F.to_date(F.lit(end_month + "-01")), 1)
    kind = rows.schema[time].dataType
    return rows.where((F.col(time) >= first.cast(kind)) & (F.col(time) < after.cast(kind)))


def range_counts(rows: DataFrame, start_month: str, end_month: str) -> DataFrame:
    """Rows per body in a month range."""
    return month_range(rows, start_month, end_month).groupBy("body").agg(F.count("*").alias("n"))
