"""Whitespace and text columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace. The regex engine's own \s covers ASCII only.
SPACE_CLASS = r"[\s\x1c-\x1f\x85\p{Z}]"
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


# Names of the Western charset, which browsers read as windows-1252 throughout, and the
# characters of its bytes 80 to 9F; 81, 8D, 8F, 90 and 9D stay control characters.
WESTERN = ["windows-1252", "cp1252", "x-cp1252", "iso-8859-1", "iso8859-1", "iso_8859-1", "latin1", "latin-1", "l1", "us-ascii", "ascii"]
WINDOWS_1252 = (
    "".join(chr(c) for c in range(0x80, 0xA0)),
    "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ",
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def collapse(value: Column | str) -> Column:
    """One blank per whitespace run, none at the ends; keeps ''."""
    return F.trim(F.regexp_replace(as_column(value), SPACE_CLASS + "+", " "))


def clean_text(value: Column | str) -> Column:
    """`collapse`, with blank text as NULL."""
    return F.nullif(collapse(value), F.lit(""))


def strip(value: Column | str) -> Column:
    """Drop whitespace at both ends only."""
    return F.btrim(as_column(value), F.lit(SPACES))


def filled(value: Column | str) -> Column:
    """NULL for '' as well: both count as missing."""
    return F.nullif(as_column(value), F.lit(""))


def or_default(value: Column | str, default: str) -> Column:
    return F.coalesce(filled(value), F.lit(default))


def decode_bytes(value: Column | str, charset: Column | None = None) -> Column:
    """Bytes to text, by a charset of `WESTERN`, else as UTF-8; undecodable bytes become U+FFFD."""
    value = as_column(value)
    utf8 = F.make_valid_utf8(value.cast("string"))
    if charset is None:
        return utf8
    western = F.translate(F.decode(value, "ISO-8859-1"), *WINDOWS_1252)
    return F.when(F.lower(charset).isin(WESTERN), western).otherwise(utf8)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]
