"""The page pass: each page is parsed once, and every page job selects from the result.

`mapInArrow` keeps the Python work to one plan node. A struct-valued UDF would be evaluated
again below a filter on one of its fields.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from folioflow import schemas as S
from folioflow.functions import naming, page_tree, payload, text, urls
from folioflow.session import ship_package

_TEXT = T.StringType()
FACTS = {
    "cleaned_html": _TEXT,
    "cleaned_text": _TEXT,
    # The same without the wrapper, whatever `wrap` says.
    "bare_html": _TEXT,
    "bare_text": _TEXT,
    "content_html": _TEXT,
    "content_text": _TEXT,
    "anchors": T.ArrayType(S.ANCHOR),
    "listings": T.ArrayType(S.LISTING),
    "next_href": _TEXT,
    "base_href": _TEXT,
}
_READERS = [name for name in FACTS if not name.startswith(("cleaned_", "bare_"))]
ROWS_PER_SLICE = 64


def _read_page(html: str, facts: list[str], wrap: bool) -> dict:
    page = page_tree.Page(html)
    out = {}
    if "cleaned_html" in facts or "cleaned_text" in facts:
        out["cleaned_html"], out["cleaned_text"] = page_tree.cleaned(page, wrap)
    if "bare_html" in facts or "bare_text" in facts:
        out["bare_html"], out["bare_text"] = page_tree.cleaned(page, False)
    for name in _READERS:
        if name in facts:
            out[name] = getattr(page_tree, name)(page)
    return out


def extract_pages(
    pages: DataFrame, html: str, facts: Iterable[str], keep: Iterable[str], wrap: bool = True
) -> DataFrame:
    """`keep` columns plus the named facts of each page and an `error` column.

    A page that cannot be read gets NULL facts and its error; the other rows go on. A NULL page
    has NULL facts and no error.
    """
    facts, keep = list(facts), list(keep)
    by_name = pages.schema
    fields = [by_name[name] for name in keep]
    fields += [T.StructField(name, FACTS[name]) for name in facts]
    fields.append(T.StructField("error", _TEXT))
    arrow_types = {name: to_arrow_type(FACTS[name]) for name in facts}

    def assembled(part: pa.RecordBatch, rows: list[dict], errors: list) -> Iterator[pa.RecordBatch]:
        try:
            found = [pa.array([r.get(f) for r in rows], arrow_types[f]) for f in facts]
            columns = [part.column(name) for name in keep]
            columns += [*found, pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *facts, "error"])
        except Exception as exc:  # the facts of some page cannot be held: narrow it down
            if len(rows) > 1:
                half = len(rows) // 2
                yield from assembled(part.slice(0, half), rows[:half], errors[:half])
                yield from assembled(part.slice(half), rows[half:], errors[half:])
            elif rows[0]:
                yield from assembled(part, [{}], [f"{type(exc).__name__}: {exc}"])
            else:
                raise

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(start, ROWS_PER_SLICE)
                rows, errors = [], []
                for page in part.column(html).cast(pa.binary()).to_pylist():
                    row, error = {}, None
                    if page is not None:
                        try:
                            # Text may hold bytes that are none; only this page fails of them.
                            row = _read_page(page.decode("utf-8"), facts, wrap)
                        except Exception as exc:  # one bad page must not end the job
                            error = f"{type(exc).__name__}: {exc}"
                    rows.append(row)
                    errors.append(error)
                yield from assembled(part, rows, errors)

    ship_package(pages.sparkSession)
    source = pages.select(*dict.fromkeys([*keep, html]))
    return source.mapInArrow(run, T.StructType(fields))


def clean_pages(
    pages: DataFrame, html: str, keep: Iterable[str], wrap: bool = True
) -> DataFrame:
    """Pages without chrome, their text and the hash of the result."""
    facts = ["cleaned_html", "cleaned_text"]
    done = extract_pages(pages, html, facts, keep, wrap)
    return done.withColumn("file_hash", payload.content_hash("cleaned_html"))


def attachment(anchors: Column | str) -> Column:
    """The attachment of a document page: the first link of the first rule that has one with a target."""

    def ends(ending: str):
        return lambda a: a["content"] & a["href"].endswith(ending)

    rules = [
        *(ends(ending) for ending in (".pdf", ".doc", ".docx")),
        lambda a: a["related"] & a["download"],
        lambda a: a["item"] & a["download"],
        lambda a: a["loose"] & a["says"],
        lambda a: a["loose"] & (a["href"].contains(".pdf") | a["href"].contains(".doc")),
    ]
    first = F.array(*[F.get(F.filter(anchors, rule), F.lit(0))["href"] for rule in rules])
    return F.get(F.filter(first, lambda href: href != ""), F.lit(0))


def has_meaningful_content(content_html: Column | str, content_text: Column | str) -> Column:
    node, words = text.as_column(content_html), text.as_column(content_text)
    return F.coalesce((node != "") & (F.length(words) >= S.MIN_TEXT_LENGTH), F.lit(False))


def route(
    content_type: Column | str,
    url: Column | str,
    content_html: Column | str,
    content_text: Column | str,
    attachment_href: Column | str,
) -> Column:
    """What becomes of a document page: file, html, follow or html_fallback."""
    return (
        F.when(naming.is_binary_document(content_type, url), F.lit("file"))
        .when(has_meaningful_content(content_html, content_text), F.lit("html"))
        .when(text.as_column(attachment_href).isNotNull(), F.lit("follow"))
        .otherwise(F.lit("html_fallback"))
    )


def link_target(url: Column | str, base_href: Column | str, href: Column | str) -> Column:
    """Absolute URL of a link; a page may set another base than its own URL."""
    other = text.as_column(base_href)
    base = F.when(other.isNull(), text.as_column(url)).otherwise(urls.resolve(url, other))
    return text.once(base, lambda b: urls.resolve(b, href))


def document_pages(pages: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Route each captured page and build the columns of its case item.

    In: `url, content_type, body binary`. Markup is decoded by its declared charset, Western ones or
    UTF-8. Files keep their bytes and never meet Python.
    """
    binary = naming.is_binary_document("content_type", "url")
    facts = ["content_html", "content_text", "anchors", "base_href"]
    kept = ["url", "content_type", *extra]
    markup = pages.where(~binary).select(*kept, text.decode_bytes("body", naming.charset("content_type")).alias("page_html"))
    read = extract_pages(markup, "page_html", facts, kept)
    read = read.withColumn("body", F.lit(None).cast("binary"))
    none = F.lit(None).cast("string")
    files = pages.where(binary).select(*kept, "body", none.alias("error"))
    both = read.unionByName(files, allowMissingColumns=True)
    routed = both.withColumn("attachment_href", attachment("anchors")).withColumn(
        "route", route("content_type", "url", "content_html", "content_text", "attachment_href")
    )
    is_file = F.col("route") == "file"
    mime = text.filled(naming.content_type("content_type"))
    return routed.select(
        *[c for c in kept if c != "content_type"],
        F.col("url").alias("link_to_doc"),
        F.coalesce(
            mime, F.when(is_file, F.lit(S.FALLBACK_TYPE)).otherwise(F.lit("text/html"))
        ).alias("content_type"),
        "route",
        F.when(
            F.col("route") == "follow", link_target("url", "base_href", "attachment_href")
        ).alias("follow_url"),
        F.when(is_file, F.col("body")).alias("content_bytes"),
        F.when(~is_file, F.col("content_html")).alias("content_html"),
        F.when(~is_file, F.length("content_text")).alias("text_length"),
        "error",
    )


RESULT_FACTS = ["listings", "next_href", "base_href"]


def listings(
    results: DataFrame, html: str, context: Iterable[str], source: str, url: str | None = None
) -> DataFrame:
    """Case listings of results pages, one row each; listings without a link drop out.

    `context` names the columns carried along (url, body, partition_date, page). With the `url`
    column of the results page the links are resolved to `document_url` as well.
    """
    context = list(context)
    kept = list(dict.fromkeys([*context, url])) if url else context
    read = extract_pages(results, html, ["listings", "base_href"], kept)
    return listing_rows(read, context, source, url)


def listing_rows(
    read: DataFrame, context: Iterable[str], source: str, url: str | None = None
) -> DataFrame:
    """`listings` of results pages that were parsed before."""
    context = list(context)
    kept = list(dict.fromkeys([*context, url])) if url else context
    rows = read.select(*kept, "base_href", F.explode("listings").alias("l"))
    target = [link_target(url, "base_href", "l.href").alias("document_url")] if url else []
    return rows.where(F.col("l.href") != "").select(
        *context,
        F.lit(source).alias("source"),
        "l.position",
        "l.identifier",
        "l.title",
        "l.description",
        "l.case_number",
        "l.record_date",
        F.col("l.href").alias("source_page_url"),
        *target,
    )


def next_pages(results: DataFrame, html: str, url: str) -> DataFrame:
    """The link from each results page to the next, as edges `src, dst`."""
    return next_edges(extract_pages(results, html, ["next_href", "base_href"], [url]), url)


def next_edges(read: DataFrame, url: str) -> DataFrame:
    """`next_pages` of results pages that were parsed before."""
    return read.where(F.col("next_href").isNotNull()).select(
        F.col(url).alias("src"), link_target(url, "base_href", "next_href").alias("dst")
    )


def listings_per_page(results: DataFrame, html: str, context: Iterable[str]) -> DataFrame:
    """Listing count of each results page, with or without links; NULL and the error of one that cannot be read."""
    context = list(context)
    read = extract_pages(results, html, ["listings"], context)
    count = F.when(F.col("error").isNull(), F.coalesce(F.size("listings"), F.lit(0)))
    return read.select(*context, count.alias("n_listings"), "error")
