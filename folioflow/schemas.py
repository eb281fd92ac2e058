"""Fixed values and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values. Results depend on these exact names, codes, patterns, formats.
# --------------------------------------------------------------------------

BODIES = {
    "Employment Appeals Tribunal": "2",
    "Equality Tribunal": "1",
    "Labour Court": "3",
    "Workplace Relations Commission": "15376",
}
FIRST_MONTH = "2012-01-01"

CONTENT_TYPE_EXTENSIONS = {
    "application/msword": "doc",
    "application/pdf": "pdf",
    "application/vnd.ms-word.document.macroenabled.12": "docm",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "text/html": "html",
}
BINARY_TYPES = [t for t in CONTENT_TYPE_EXTENSIONS if t != "text/html"]
BINARY_PATH_PATTERN = r"\.(pdf|doc|docx)\z"
FALLBACK_EXTENSION = "bin"
FALLBACK_TYPE = "application/octet-stream"
UNKNOWN = "unknown"

CHROME_TAGS = ["nav", "header", "footer", "script", "style", "noscript"]
# (tag, class, id) of the main content node, best first.
CONTENT_NODES = [
    ("article", "case-detail", None),
    ("div", "case-content", None),
    ("div", None, "main-content"),
    ("div", "content", None),
    ("main", None, None),
]
PAGE_OPEN = '<!DOCTYPE html><html><head><meta charset="utf-8"></head><body>'
PAGE_CLOSE = "</body></html>"
MIN_TEXT_LENGTH = 100
ATTACHMENT_PHRASE = "full case report"

SEARCH_QUERY = "?decisions=1&from=%s&to=%s&legislationsub=&body=%s"

STORED = "stored"
UNCHANGED = "unchanged"

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------


_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema of flat columns; needs no running session, so tasks can import this module."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def extended(schema: T.StructType, columns: str) -> T.StructType:
    return T.StructType([*schema.fields, *_struct(columns).fields])


BODY_CODES = _struct("body string, code string")

CAPTURED_PAGES = _struct("url string, content_type string, body binary")

LISTING = _struct(
    "position int, identifier string, title string, description string, "
    "case_number string, record_date string, href string"
)

# A link of a document page: which of the marked places it is in, and what it looks like.
ANCHOR = _struct(
    "href string, content boolean, related boolean, item boolean, loose boolean, "
    "download boolean, says boolean"
)

CASE_COLUMNS = (
    "source string, body string, identifier string, title string, description string, "
    "case_number string, record_date string, partition_date string, source_page_url string, "
    "link_to_doc string, file_name string, content_type string"
)

INCOMING_CASES = _struct(
    CASE_COLUMNS + ", content_bytes binary, content_html string, seq bigint"
)

LANDING_CASES = _struct(
    CASE_COLUMNS + ", path_to_file string, file_hash string, scrape_status string, "
    "scraped_at timestamp"
)

PROCESSED_CASES = _struct(
    CASE_COLUMNS + ", path_to_file string, file_hash string, scrape_status string, "
    "scraped_at timestamp, processed_at timestamp"
)

CONTENT = _struct(
    "path_to_file string, content binary, content_type string, file_hash string"
)

# The batch that wrote a path last.
CONTENT_VERSIONS = _struct("path_to_file string, file_hash string, version bigint")

# A range of keys in a file of a run: `folder` is the batch that wrote it.
KEY_RANGES = _struct("folder bigint, bucket int, level int, low string, high string, rows bigint")

# A file of rows in force, with its partition and the range of its identifiers.
ROW_FILES = _struct("zone_body string, zone_month string, path string, folder bigint, low string, high string, rows bigint")

# Landing supplies every column but the file name; processing supplies them all.
LANDING_SUPPLIED = [c for c in LANDING_CASES.names if c != "file_name"]
PROCESSED_SUPPLIED = list(PROCESSED_CASES.names)

RUN_METRICS = _struct(
    "body string, partition_date string, start_date date, end_date date, stored bigint, "
    "unchanged bigint, failed bigint, dropped bigint, pages_scraped bigint, processed bigint, "
    "transform_failed bigint, elapsed_seconds double"
)
