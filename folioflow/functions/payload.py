"""Payload choice and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import as_column


def build_payload(
    content_bytes: Column | str, content_html: Column | str, link: Column | str
) -> Column:
    """The bytes, else the HTML, else the link itself, as bytes."""
    raw, html = as_column(content_bytes), as_column(content_html)
    link = F.coalesce(as_column(link), F.lit(""))
    return (
        F.when(F.length(raw) > 0, raw)
        .when(html != "", html.cast("binary"))
        .otherwise(link.cast("binary"))
    )


def content_hash(payload: Column | str) -> Column:
    """SHA-256 as 64 hex digits."""
    return F.sha2(as_column(payload).cast("binary"), 256)
