"""Captured pages as tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas as S


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured responses: `url, content_type, body`."""
    return spark.read.schema(S.CAPTURED_PAGES).parquet(path)


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files on disk as captured pages; the MIME type follows from the file name."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    by_ending = F.lit("")
    for mime, ending in S.CONTENT_TYPE_EXTENSIONS.items():
        by_ending = F.when(F.lower("path").endswith("." + ending), F.lit(mime)).otherwise(by_ending)
    return reader.load(path).select(
        F.col("path").alias("url"), by_ending.alias("content_type"), F.col("content").alias("body")
    )


def stream_files(
    spark: SparkSession, path: str, schema, files_per_batch: int, glob: str | None = None
) -> DataFrame:
    """A folder of parquet files as a stream; the file count bounds each micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
