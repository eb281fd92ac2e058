"""Keyed upsert: insert, or overwrite only the supplied columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Last row per key; aggregated before the shuffle, so a hot key is no burden."""
    others = [c for c in rows.columns if c != key]
    last = F.max_by(F.struct(*others), F.col(order)).alias("_row")
    return rows.groupBy(key).agg(last).select(key, *[f"_row.{c}" for c in others]).select(
        *rows.columns
    )


def upsert(
    existing: DataFrame, incoming: DataFrame, key: str, supplied: Iterable[str]
) -> DataFrame:
    """Existing rows overwritten by incoming ones, both unique on `key`.

    Supplied columns overwrite even with NULL; all others keep the old value, NULL for a new key.
    The result has the columns of `existing`.
    """
    supplied = set(supplied) - {key}
    new = incoming.select(
        key,
        F.struct(*[F.col(c) for c in existing.columns if c in supplied]).alias("_new"),
        F.lit(True).alias("_is_new"),
    )
    joined = existing.alias("old").join(new, key, "full_outer")
    columns = [
        F.when(F.col("_is_new"), F.col(f"_new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
        if c in supplied
        else F.col(c)
        for c in existing.columns
    ]
    return joined.select(*columns)


def upsert_latest(
    existing: DataFrame, incoming: DataFrame, key: str, order: str, supplied: Iterable[str]
) -> DataFrame:
    """Upsert of a batch that may repeat keys: the last write wins."""
    return upsert(existing, latest(incoming, key, order), key, supplied)


def fold_fields(
    existing: DataFrame, incoming: DataFrame, key: str, order: str, supplied: str
) -> DataFrame:
    """The rows of the incoming keys, each field with its last supplied value in `order`, or else the existing one.

    Every incoming row names the fields it supplies in its array column `supplied`; a supplied NULL is a
    value, names that are no fields are ignored, and a NULL list supplies none. Rows of a key may repeat; `order` tells them apart.
    A field that was never supplied is NULL in a new row. `existing` is unique on `key`; the result has its columns.

    One aggregation before the shuffle keeps a value per field and key, so a hot key is no burden.
    """
    fields = [c for c in existing.columns if c != key]

    def last(field: str) -> Column:
        # Wrapped, so that a supplied NULL is told from no value.
        given = F.when(F.array_contains(supplied, field), F.col(order))
        return F.max_by(F.struct(F.col(field).alias("value")), given).alias(f"_{field}")

    folded = incoming.groupBy(key).agg(*[last(c) for c in fields if c in incoming.columns])
    joined = folded.join(existing, key, "left")
    columns = [
        F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.value")).otherwise(F.col(c)).alias(c)
        if f"_{c}" in folded.columns
        else F.col(c)
        for c in fields
    ]
    return joined.select(key, *columns).select(*existing.columns)
