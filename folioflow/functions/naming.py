"""Content types, file extensions, identifiers and object keys."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.functions import urls
from folioflow.functions.text import as_column, filled, once, or_default, strip


def content_type(raw: Column | str) -> Column:
    """Bare lower-case MIME type; '' when missing."""
    return F.lower(strip(F.split_part(F.coalesce(as_column(raw), F.lit("")), F.lit(";"), F.lit(1))))


def charset(raw: Column | str) -> Column:
    """The charset a content type declares, quoted or not; '' when missing."""
    return F.regexp_extract(F.coalesce(as_column(raw), F.lit("")), r"(?i);\s*charset\s*=\s*[\"']?([^\s;\"']+)", 1)


def _mapped(mime: Column) -> Column:
    pairs = chain.from_iterable(S.CONTENT_TYPE_EXTENSIONS.items())
    return F.create_map(*[F.lit(p) for p in pairs])[mime]


def landing_extension(raw_type: Column | str, file_name: Column | str, url: Column | str) -> Column:
    """From the MIME type, else the file name, else the URL."""
    mime = content_type(raw_type)
    return F.coalesce(
        _mapped(mime),
        urls.suffix(file_name),
        urls.suffix(urls.unquote(urls.path(url))),
        F.when(mime.contains("html"), F.lit("html")),
        F.lit(S.FALLBACK_EXTENSION),
    )


def processed_extension(mime: Column | str) -> Column:
    """From the exact stored MIME type only."""
    return F.coalesce(_mapped(as_column(mime)), F.lit(S.FALLBACK_EXTENSION))


def resolve_identifier(raw: Column | str, url: Column | str, title: Column | str) -> Column:
    """The case reference; an all-digit one yields to the URL slug; the title comes last."""
    raw, slug = filled(raw), urls.slug(url)
    digits_only = raw.rlike(r"\A\p{Nd}+\z") & slug.isNotNull()
    return F.when(digits_only, slug).otherwise(F.coalesce(raw, slug, filled(title)))


def landing_key(
    source: Column | str,
    body: Column | str,
    month: Column | str,
    identifier: Column | str,
    extension: Column,
) -> Column:
    """`source/body/month/identifier.ext`, body and identifier in lower case."""
    source = or_default(source, S.UNKNOWN)
    body = F.replace(F.lower(or_default(body, S.UNKNOWN)), F.lit(" "), F.lit("_"))
    month = or_default(month, S.UNKNOWN)
    name = F.replace(F.lower(as_column(identifier)), F.lit("/"), F.lit("_"))
    parts = [source, body, month, F.concat(name, F.lit("."), extension)]
    # A part that starts with a slash makes the key absolute and hides what precedes it.
    key = (
        F.when(month.startswith("/"), F.concat_ws("/", *parts[2:]))
        .when(body.startswith("/"), F.concat_ws("/", *parts[1:]))
        .otherwise(F.concat_ws("/", *parts))
    )

    def tidy(k: Column) -> Column:
        without_dots = F.regexp_replace(k, r"(?<=\A|/)\.(?:/+|\z)", "")
        untidy = k.contains("./") | k.contains("//")
        return F.when(untidy, F.regexp_replace(without_dots, "/{2,}", "/")).otherwise(k)

    return once(key, tidy)


def processed_key(
    body: Column | str, month: Column | str, identifier: Column | str, extension: Column
) -> Column:
    """`body/month/identifier.ext` as is; only blanks in the body change."""
    body = F.replace(or_default(body, S.UNKNOWN), F.lit(" "), F.lit("_"))
    month = F.coalesce(as_column(month), F.lit(S.UNKNOWN))
    name = F.coalesce(as_column(identifier), F.lit(""))
    return F.concat(body, F.lit("/"), month, F.lit("/"), name, F.lit("."), extension)


def is_binary_document(raw_type: Column | str, url: Column | str) -> Column:
    """A file to keep as it is, by MIME type or by the URL path."""
    by_type = content_type(raw_type).isin(S.BINARY_TYPES)
    by_path = F.lower(urls.path(url)).rlike(S.BINARY_PATH_PATTERN)
    return F.coalesce(by_type, F.lit(False)) | F.coalesce(by_path, F.lit(False))
