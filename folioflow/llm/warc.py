"""WARC archives written and read by Spark's text source, and captures assembled from their records.

Writing. Each page becomes a request, a response and a metadata record, tied by `WARC-Concurrent-To`. Of pages
with equal payloads of `least` bytes or more, the one with the largest page_id is the response and the others are revisits
of it, without the payload. A record ends in two line breaks, which is what the text writer puts after each row; so the
archives go through Spark's own writer to any store, compressed, one file per task and `RECORDS_PER_FILE`.

Reading. The text source cuts files at `WARC/1.`, in a stream, whatever their size and bytes. Nearly every piece is a
record whose length is the declared one. A payload may hold those bytes as well; then a piece is too short, and the
pieces of its file, in order, are put together again by their declared lengths, in a stream too. Of a file that no
such piece is in, every piece is a record.

Assembly. Requests and metadata are joined to the response or revisit they are concurrent with, whichever of the two
names the other, and one nested row per capture comes out. The records joined are narrow: digest and size of a payload
are taken where it is read, and the payload itself moves only if the caller selects it.

Edge cases: a null html is an empty payload; a null url leaves out the target, blanks and line breaks in one are
percent-encoded; a null page_id is left out of the metadata and read back as null, and is the smallest; of repeated rows that are large
enough one is the response; an empty table gives archives without records; other columns are not read. A record
that does not end where it says is kept as `damaged`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import map_arrow
from folioflow.session import stored

LEAST = 1000
RECORDS_PER_FILE = 150_000
LINE, GAP, MARK = "\r\n", "\r\n\r\n", "WARC/1."
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit")


# -- writing ------------------------------------------------------------------


def record_id(kind: str, unique: Column) -> Column:
    """A name for a record, made from what is unique to its page."""
    digits = F.md5(F.concat(F.lit(f"{kind}:"), unique).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def record(kind: str, headers: dict[str, Column], block: Column, length: Column | None = None) -> Column:
    """A record up to its end; headers that are null are left out. length: bytes of the block, where they are known."""
    fields = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit("")) for name, value in headers.items()]
    length = (F.octet_length(block) if length is None else length).cast("string")
    return F.concat(F.lit(f"{MARK}1{LINE}WARC-Type: {kind}{LINE}"), *fields, F.lit("Content-Length: "), length, F.lit(GAP), block)


def plain_uri(url: Column) -> Column:
    for char in "\r\n\t ":
        url = F.replace(url, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return url


def write_archives(pages: DataFrame, path: str, least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archives of pages (page_id, url, html) below a folder.

    The pages are written once with a number each, so that repeated rows can be told apart. Which payloads recur comes from an
    aggregation of their digests; the one join that sees payloads is with the digests that do, a written table
    whose size the planner knows.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), plain_uri(F.col("url").cast("string")).alias("url"), html.alias("html"))
    numbered = read.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html"), "number": F.monotonically_increasing_id()})
    rows = stored(numbered)
    newest = F.max(F.struct("page_id", "number")).alias("newest")
    groups = rows.where(F.col("size") >= least).groupBy("digest").agg(F.count("*").alias("n"), newest)
    recurring = stored(groups.where("n > 1").select("digest", "newest"))

    unique = lambda number, page: F.concat_ws(":", number.cast("string"), page.cast("string"), F.col("digest"))
    own, first = unique(F.col("number"), F.col("page_id")), unique(F.col("newest.number"), F.col("newest.page_id"))
    response = record_id("response", own)
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    common = {"WARC-Date": F.lit(date), "WARC-Target-URI": F.col("url")}
    http = {"Content-Type": F.lit("application/http; msgtype=response")}
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), F.col("size").cast("string"), F.lit(GAP))

    full = record("response", {"WARC-Record-ID": response, **common, "WARC-Payload-Digest": digest, **http}, F.concat(answer, F.col("html")), F.octet_length(answer) + F.col("size"))
    again = {"WARC-Record-ID": response, **common, "WARC-Payload-Digest": digest, "WARC-Refers-To": record_id("response", first), "WARC-Profile": F.lit(REVISIT_PROFILE), **http}
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    asked = F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{LINE}Host: "), F.coalesce(host, F.lit("")), F.lit(GAP))
    request = record("request", {"WARC-Record-ID": record_id("request", own), **common, "WARC-Concurrent-To": response, "Content-Type": F.lit("application/http; msgtype=request")}, asked)
    facts = F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit(LINE)), F.lit(""))
    metadata = record("metadata", {"WARC-Record-ID": record_id("metadata", own), **common, "WARC-Concurrent-To": response, "Content-Type": F.lit("application/warc-fields")}, facts)

    decided = rows.join(recurring, "digest", "left")
    revisits = F.col("newest").isNotNull() & (F.col("newest.number") != F.col("number"))
    records = decided.select(F.explode(F.array(request, F.when(revisits, record("revisit", again, answer)).otherwise(full), metadata)).alias("value"))
    records.write.option("lineSep", GAP).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


# -- reading ------------------------------------------------------------------


def _head(value: str = "value") -> Column:
    return F.substring_index(F.col(value).cast("string"), GAP, 1)


def _header(name: str) -> Column:
    found = F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _measured(pieces: DataFrame) -> DataFrame:
    """Head, declared length of the block, and whether the piece ends where it should."""
    measured = pieces.withColumn("head", _head())
    measured = measured.withColumn("length", _header("content-length").try_cast("long"))
    ends = F.octet_length("head") + F.lit(2 * len(GAP)) + F.col("length")
    return measured.withColumn("damaged", ~F.coalesce(F.octet_length("value") == ends, F.lit(False)))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the pieces of files, in order: a piece belongs to the record before it until that is complete."""
    gap, mark = GAP.encode(), MARK.encode()
    file, held, size, due = None, [], 0, None

    def out(values):
        return pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])

    for batch in batches:
        done = []
        for name, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
            if name != file:
                if held:
                    done.append(mark.join(held))
                file, held, size, due = name, [], 0, None
            if not held and not value:  # before the first record of a file
                continue
            size += len(value) + (len(mark) if held else 0)
            held.append(value)
            if due is None and gap in (whole := mark.join(held)):
                held = [whole]
                due = _due(whole, gap)
            if due is not None and size >= due:
                done.append(mark.join(held))
                held, size, due = [], 0, None
        yield out(done)
    if held:
        yield out([mark.join(held)])


def _due(record: bytes, gap: bytes) -> int:
    """Bytes of a record, from its declared length; 0 if it declares none."""
    head = record[: record.index(gap)]
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return len(head) + 2 * len(gap) + int(value)
    return 0


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: kind, record_id, date, target_uri, concurrent_to (array), refers_to, payload_digest, content_type, length,
    damaged, payload_bytes and payload_sha1 of responses and revisits, and block (binary).

    payloads: whether responses and revisits have their block. Without, the files are read once and the rest is written
    as a narrow table; with, they are read when the rows are.
    """
    pieces = spark.read.option("lineSep", MARK).text(path)
    pieces = pieces.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    pieces = pieces.withColumn("place", F.monotonically_increasing_id())
    # What stands before the first mark of a file is empty and no record.
    filled = pieces.where(F.octet_length("value") > 0)
    parsed = _parsed(filled, payloads)
    if not payloads:
        parsed = stored(parsed.drop("start", "place"))
    marks = parsed if not payloads else _measured(filled)
    cut = stored(marks.where("damaged").select("file").distinct())
    if cut.head(1):
        again = pieces.join(cut, "file", "left_semi").select("file", "start", "place", "value").repartition("file")
        mended = map_arrow(again.sortWithinPartitions("file", "start", "place"), _joined, "value binary")
        parsed = parsed.join(cut, "file", "left_anti").select(*RECORD).unionByName(_parsed(mended, payloads).select(*RECORD))
    return parsed.select(*RECORD)


RECORD = ["kind", "record_id", "date", "target_uri", "concurrent_to", "refers_to", "payload_digest", "content_type", "length", "damaged", "payload_bytes", "payload_sha1", "block"]


def _parsed(pieces: DataFrame, payloads: bool) -> DataFrame:
    """The columns of records, beside those of the pieces other than their value."""
    kept = [c for c in pieces.columns if c != "value"]
    block = F.substring(F.col("value"), F.octet_length("head") + F.lit(len(GAP) + 1), F.col("length").cast("int"))
    headers = {"kind": "warc-type", "record_id": "warc-record-id", "date": "warc-date", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type"}
    concurrent = F.regexp_extract_all("head", F.lit(r"(?i)\r\nwarc-concurrent-to:[ \t]*([^\r\n]*)"), F.lit(1))
    read = _measured(pieces).select(*kept, *[_header(name).alias(c) for c, name in headers.items()], concurrent.alias("concurrent_to"), "length", block.alias("block"), "damaged")
    capture = F.coalesce(F.col("kind").isin(*CAPTURES), F.lit(False))
    body = payload(F.col("block"), F.col("content_type"))
    read = read.withColumns({"payload_bytes": F.when(capture, F.octet_length(body).cast("long")), "payload_sha1": F.when(capture, F.sha1(body))})
    return read if payloads else read.withColumn("block", F.when(~capture, F.col("block")))


def payload(block: Column, content_type: Column) -> Column:
    """The body of an HTTP message, or the whole block of another type."""
    head = F.octet_length(F.substring_index(block.cast("string"), GAP, 1))
    body = F.substring(block, head + F.lit(len(GAP) + 1), F.octet_length(block))
    return F.when(F.lower(content_type).startswith("application/http"), body).otherwise(block)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: record_id, kind, date, target_uri, refers_to, payload_digest, payload_bytes, payload_sha1, payload (null
    if the records were read without), requests and metadata (arrays of record_id, date, block)."""
    main = records.where(F.col("kind").isin(*CAPTURES)).withColumn("payload", payload(F.col("block"), F.col("content_type")))
    kept = ["record_id", "kind", "date", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload_sha1", "payload"]

    beside = records.where(F.col("kind").isin("request", "metadata"))
    part = F.struct("kind", "record_id", "date", F.col("block").cast("string").alias("block")).alias("part")
    named = beside.select(F.explode("concurrent_to").alias("capture"), part)
    names = main.select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("other"))
    naming = names.join(beside.select(F.col("record_id").alias("other"), part), "other").select("capture", "part")
    # Once for each pair, whichever record names the other; repeated records count once.
    parts = named.unionByName(naming).groupBy("capture").agg(F.array_sort(F.collect_set("part")).alias("parts"))

    def of(kind: str) -> Column:
        chosen = F.filter(F.coalesce("parts", F.array().cast(parts.schema["parts"].dataType)), lambda p: p["kind"] == kind)
        return F.transform(chosen, lambda p: F.struct(p["record_id"].alias("record_id"), p["date"].alias("date"), p["block"].alias("block")))

    joined = main.select(*kept).join(parts.withColumnRenamed("capture", "record_id"), "record_id", "left")
    return joined.select(*kept, of("request").alias("requests"), of("metadata").alias("metadata"))


def resolved(captured: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri of each capture; a revisit has the size of the response it refers to.

    Digest and size are those of the bytes read. A hot response is joined by plain shuffles, which Spark splits.
    """
    page = F.try_element_at("metadata", F.lit(1))["block"]
    page_id = F.regexp_extract(page, r"(?:^|\r\n)page_id:[ \t]*(-?[0-9]+)", 1).try_cast("long")
    digest = F.lower(F.substring_index("payload_digest", ":", -1))
    narrow = captured.select("record_id", "kind", page_id.alias("page_id"), "target_uri", "refers_to", digest.alias("declared"), "payload_bytes", "payload_sha1")
    narrow = stored(narrow)
    found = narrow.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first"), F.col("payload_bytes").alias("bytes"), F.col("payload_sha1").alias("sha1"))
    revisit = F.col("kind") == "revisit"
    joined = narrow.join(found, "refers_to", "left")
    return joined.select(
        "page_id",
        F.when(revisit, F.col("bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.coalesce("sha1", "declared")).otherwise(F.col("payload_sha1")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        "target_uri",
    )
