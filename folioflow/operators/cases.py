"""Case records: normalisation, rejection and change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.functions import dates, naming, payload, text
from folioflow.session import spread, stored

CLEANED = ("title", "description", "case_number", "record_date", "source", "body")
ROWS_PER_GROUP = 1_000_000
# Points of the sketch that a hot identifier is cut at.
QUANTILES = 4096


def normalize_cases(cases: DataFrame) -> DataFrame:
    """Collapse text, resolve the identifier from the cleaned title, normalise the date."""
    # The identifier is cleaned in the same step: within the choice below it would be cleaned for each of its uses.
    cleaned = cases.withColumns({c: text.clean_text(c) for c in (*CLEANED, "identifier")})
    return cleaned.withColumns(
        {
            "identifier": naming.resolve_identifier(
                F.col("identifier"),
                F.coalesce(F.col("source_page_url"), F.lit("")),
                F.col("title"),
            ),
            "record_date": dates.normalise_date("record_date"),
        }
    )


def prepare_cases(incoming: DataFrame) -> DataFrame:
    """Metadata of incoming cases with payload hash, landing key and reject reason.

    The payload itself stays behind, so that no later shuffle carries it. What is left is spread over all cores
    before it is normalised, as files of a batch may be few. An `error` column from
    the page pass marks rows that failed before; they and rows without an identifier get a
    `reason` and take no part in change detection.
    """
    failed = F.col("error") if "error" in incoming.columns else F.lit(None).cast("string")
    # Captured cases come with the hash of a payload that is kept elsewhere.
    hashed = incoming if "file_hash" in incoming.columns else incoming.withColumn(
        "file_hash", payload.content_hash(payload.build_payload("content_bytes", "content_html", "link_to_doc"))
    )
    narrow = spread(hashed.drop("content_bytes", "content_html"), "seq")
    named = normalize_cases(narrow).withColumn(
        "_extension", naming.landing_extension("content_type", "file_name", "link_to_doc")
    )
    cases = named.withColumns(
        {
            "object_key": naming.landing_key(
                "source", "body", "partition_date", "identifier", F.col("_extension")
            ),
            "outcome": F.when(failed.isNotNull(), "failed").when(
                F.col("identifier").isNull(), "dropped"
            ),
            "reason": F.coalesce(
                failed, F.when(F.col("identifier").isNull(), F.lit("no identifier"))
            ),
        }
    )
    return cases.drop("error", "_extension")


def valid(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("outcome").isNull()).drop("outcome", "reason")


def rejected(prepared: DataFrame) -> DataFrame:
    """Quarantine: dropped and failed rows with their reason."""
    return prepared.where(F.col("outcome").isNotNull())


def detect_changes(
    incoming: DataFrame, existing: DataFrame, rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """Add `scrape_status` and `path_to_file` to each incoming row.

    In `seq` order of its identifier, a row is unchanged if it has the hash of the row before it;
    the first row compares with the existing state, which must also have a path. NULL hashes are
    equal to each other. A stored row takes its own `object_key`, an unchanged row keeps the path in
    force.

    In: `identifier, seq, file_hash, object_key` and any other columns; `seq` is unique per
    identifier. `existing` holds one row per identifier: `identifier, file_hash, path_to_file`.

    An identifier with more than `rows_per_group` rows is cut at quantiles of its own `seq` into ranges of about as many,
    so that it fills many windows of even size. Within a range everything but its head row is settled; one row per range
    carries hash and path over to the next.
    """
    state = existing.select(
        "identifier",
        F.col("file_hash").alias("_old_hash"),
        F.col("path_to_file").alias("_old_path"),
    ).join(incoming.select("identifier"), "identifier", "left_semi")
    keys = ["identifier", "_range"]
    order = Window.partitionBy(*keys).orderBy("seq")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = (
        _seq_ranges(incoming, rows_per_group)
        .withColumn("_head", F.row_number().over(order) == 1)
        .withColumn("_changed", ~F.col("_head") & _differs(F.lag("file_hash").over(order)))
    )
    local = marked.withColumn(
        "_inner_path",
        F.last(F.when(F.col("_changed"), F.col("object_key")), ignorenulls=True).over(so_far),
    )

    summary = local.groupBy(*keys).agg(
        F.min_by("file_hash", "seq").alias("file_hash"),
        F.min_by("object_key", "seq").alias("_first_key"),
        F.max_by("file_hash", "seq").alias("_last_hash"),
        F.max_by("object_key", F.when(F.col("_changed"), F.col("seq"))).alias("_last_key"),
    )
    ranges = Window.partitionBy("identifier").orderBy("_range")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    known = ~_differs(F.col("_old_hash")) & F.coalesce(F.col("_old_path") != "", F.lit(False))
    head_stored = F.when(F.row_number().over(ranges) == 1, ~known).otherwise(
        _differs(F.lag("_last_hash").over(ranges))
    )
    heads = (
        summary.join(state, "identifier", "left")
        .withColumn("_head_stored", head_stored)
        .withColumn("_head_key", F.when(F.col("_head_stored"), F.col("_first_key")))
        .withColumn(
            "_entry_path",
            F.coalesce(
                F.col("_head_key"),
                F.last(F.coalesce("_last_key", "_head_key"), ignorenulls=True).over(before),
                F.col("_old_path"),
            ),
        )
        .select(*keys, "_head_stored", "_entry_path")
    )
    written = F.when(F.col("_head"), F.col("_head_stored")).otherwise(F.col("_changed"))
    return local.join(heads, keys).select(
        *incoming.columns,
        F.when(written, F.lit(S.STORED)).otherwise(F.lit(S.UNCHANGED)).alias("scrape_status"),
        F.coalesce("_inner_path", "_entry_path").alias("path_to_file"),
    )


def _differs(other: Column) -> Column:
    """Whether a row's hash is another than this one; two NULLs are the same."""
    return ~other.eqNullSafe(F.col("file_hash"))


def _seq_ranges(rows: DataFrame, rows_per_group: int) -> DataFrame:
    """Number the ranges of `seq` of each identifier, in order: one, but for hot identifiers.

    The cuts of a hot one are quantiles of its `seq`, from a sketch of fixed size that is merged map-side; so neither gaps nor
    outliers make a range much larger than `rows_per_group`, up to `QUANTILES` times that many rows. All cuts together are
    fewer than the rows divided by `rows_per_group`.
    """
    counted = rows.groupBy("identifier").agg(F.count("*").alias("_n"))
    hot = stored(counted.where(F.col("_n") > rows_per_group))
    if not hot.head(1):
        return rows.withColumn("_range", F.lit(0).cast("long"))
    fractions = [i / QUANTILES for i in range(1, QUANTILES)]
    sketch = F.percentile_approx("seq", fractions, 8 * QUANTILES).alias("_at")
    parts = F.least(F.ceil(F.col("_n") / rows_per_group), F.lit(QUANTILES)).cast("int")
    # The i-th of n cuts is the quantile nearest below i / n.
    chosen = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.col("_at")[F.floor(i * QUANTILES / parts).cast("int") - 1])
    sketched = rows.select("identifier", "seq").join(hot, "identifier").groupBy("identifier", "_n").agg(sketch)
    cuts = stored(sketched.select("identifier", chosen.alias("_cuts")))
    ranged = rows.join(cuts, "identifier", "left")
    return ranged.withColumn("_range", F.when(F.col("_cuts").isNotNull(), _place("_cuts", "seq")).otherwise(F.lit(0)).cast("long")).drop("_cuts")


def _place(cuts: str, value: str) -> Column:
    """How many of the sorted cuts are at most the value, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(QUANTILES.bit_length()))])

    def step(at: Column, width: Column) -> Column:
        reached = (at + width <= F.size(cuts)) & (F.try_element_at(F.col(cuts), at + width) <= F.col(value))
        return F.when(reached, at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)
