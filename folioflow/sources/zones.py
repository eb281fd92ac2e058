"""Zone tables on plain parquet.

Metadata tables are partitioned by body and month while their key is global, so an upsert may
move a row to another partition. Each batch rewrites only the partitions it touches, in a folder
of its own (`v=<batch>`), and publishes a list of the files in force, each with its partition and its range of
identifiers. The list is a table: scans and upserts filter and join it, and the driver sees the files they
open, not all. It alternates between two slots, so a reader opens two small files however many batches there were.
Readers see the last published list, so they never meet a half-written batch, and a batch that
failed is simply written again.

Beside the rows, the hash, path and partition of each identifier are kept in sorted runs (`sources.runs`), whose
ranges are in the same list: a batch adds its own and finds those of its identifiers in the ranges they fall into.

Content tables only grow: a batch adds the payloads it stores, and the newest published one of a path
counts. Which batch that is, is kept by path in runs as well, brought up to the published batches when it is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import schemas as S
from folioflow.functions import text
from folioflow.operators.months import month_range
from folioflow.operators.upsert import fold_fields, upsert
from folioflow.session import small_table, stored
from folioflow.sources.runs import ENTRY, KeyRuns, KeyTable, read_or_empty

KEY = "identifier"
PARTITION = ["zone_body", "zone_month"]
# Runs of a level before they are merged.
DELTAS = 8
# A folder of this form is named exactly as its month; any other is opened and filtered.
_MONTH = r"^[0-9]{4}-[0-9]{2}\z"


def folder_name(value: Column | str) -> Column:
    """A value as a safe folder name: what is plain in it, and a digest of the rest if there is one."""
    given = text.or_default(value, S.UNKNOWN)
    plain = F.regexp_replace(F.lower(given), r"[^a-z0-9-]+", "_")
    same = (plain == F.regexp_replace(F.lower(given), r"[ _]", "_")) & (F.length(plain) <= 64)
    short = F.concat(F.substring(plain, 1, 32), F.lit("-"), F.substring(F.md5(F.lower(given).cast("binary")), 1, 12))
    return F.when(same, plain).otherwise(short)


class MetadataTable:
    """One row per identifier, partitioned by body and month."""

    # One list for files of rows and for ranges of states; the latter have no partition.
    _INDEX = S.extended(S.ROW_FILES, "bucket int, level int, v bigint, slot int")

    # What is kept per identifier beside the rows.
    _STATE = T.StructType(
        [
            T.StructField(name, T.StringType())
            for name in (KEY, "file_hash", "path_to_file", "zone_body", "zone_month")
        ]
    )

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.runs = KeyRuns(spark, f"{self.path}/keys", KEY, self._STATE)

    # -- reading ----------------------------------------------------------

    def _published(self) -> tuple[int, int, DataFrame]:
        """Last published batch, the slot of its list, and the list."""
        lists = read_or_empty(self.spark, f"{self.path}/index", self._INDEX)
        newest = lists.agg(F.max(F.struct("v", "slot")).alias("n")).select("n.*").first()
        if newest.v is None:
            return -1, 1, small_table(self.spark, [], self._INDEX)
        return newest.v, newest.slot, lists.where(F.col("slot") == newest.slot)

    def _index(self) -> tuple[int, list[T.Row]]:
        """Last published batch and its whole list."""
        last, _, entries = self._published()
        return last, entries.collect()

    def last_batch(self) -> int:
        return self._published()[0]

    @staticmethod
    def _files(entries: DataFrame) -> DataFrame:
        """The files of rows, narrow, of a list."""
        return entries.where(F.col("zone_month").isNotNull()).select(*S.ROW_FILES.names)

    @staticmethod
    def _ranges(entries: DataFrame) -> DataFrame:
        """The ranges of states of a list."""
        return entries.where(F.col("zone_month").isNull()).select(*ENTRY.names)

    def _open(self, files: DataFrame) -> DataFrame:
        """The rows of some files."""
        paths = [f"{self.path}/{r.path}" for r in files.select("path").collect()]
        if not paths:
            return small_table(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._open(self._files(self._published()[2]))

    def keys(self, *columns: str) -> DataFrame:
        """Identifiers with a few columns: what change detection reads."""
        return self.read().select(KEY, *columns)

    def month_files(self, start_month: str, end_month: str, body: str | None = None) -> DataFrame:
        """The files that hold rows of an inclusive month range and body."""
        files = self._files(self._published()[2])
        if body:
            files = files.where(F.col("zone_body") == folder_name(F.lit(body)))
        month = F.col("zone_month")
        return files.where(month.between(start_month, end_month) | ~month.rlike(_MONTH))

    def scan_months(
        self, start_month: str, end_month: str, body: str | None = None
    ) -> DataFrame:
        """Rows of an inclusive month range and body; other files are not opened."""
        return month_range(self._open(self.month_files(start_month, end_month, body)), start_month, end_month, body)

    # -- by identifier ----------------------------------------------------

    def state(self, identifiers: DataFrame, entries: DataFrame | None = None) -> DataFrame:
        """`identifier, file_hash, path_to_file` and partition of the given identifiers that are held.

        Opens the ranges that these identifiers fall into only, so a small batch reads little of a large table.
        """
        entries = self._published()[2] if entries is None else entries
        return self.runs.lookup(identifiers, self._ranges(entries))

    def lookup(self, identifiers: DataFrame) -> DataFrame:
        """The rows of the given identifiers that are held. Of the partitions they are in, files whose range of identifiers
        holds none of them are not opened."""
        entries = self._published()[2]
        homes = stored(self.state(identifiers, entries).select(KEY, *PARTITION))
        files = self._files(entries)
        spans = homes.groupBy(*PARTITION).agg(F.min(KEY).alias("least"), F.max(KEY).alias("most"))
        near = files.join(spans, PARTITION).where("low <= most and high >= least")
        return self._open(near).join(homes.select(KEY), KEY, "left_semi")

    # -- writing ----------------------------------------------------------

    def publish(self, batch: int, incoming: DataFrame, supplied: Iterable[str]) -> None:
        """Upsert rows that are unique by identifier. A batch published before does nothing."""
        last, slot, entries = self._published()
        if batch <= last:
            return
        zone = {"zone_body": folder_name("body"), "zone_month": folder_name("partition_date")}
        homes = incoming.select(*[c.alias(n) for n, c in zone.items()])
        homes = homes.unionByName(self.state(incoming, entries).select(*PARTITION))
        touched = stored(homes.distinct())
        files = self._files(entries)

        rows = upsert(self._open(files.join(touched, PARTITION, "left_semi")), incoming, KEY, supplied)
        # Rebalancing gives even files per partition and splits a large partition.
        placed = rows.withColumns(zone).hint("rebalance", *PARTITION)
        target = f"{self.path}/data/v={batch}"
        placed.write.mode("overwrite").partitionBy(*PARTITION).parquet(target)

        written = read_or_empty(self.spark, target, S.extended(self.schema, "zone_body string, zone_month string"))
        fresh = written.select(*self._STATE.names).join(incoming.select(KEY), KEY, "left_semi")
        ranges = self.runs.add(batch, fresh, self._ranges(entries), DELTAS, incoming.count())

        named = F.regexp_extract(F.col("_metadata.file_path"), "^.*/(data/v=[0-9]+/.*)$", 1).alias("path")
        filled = written.groupBy(*PARTITION, named).agg(F.min(KEY).alias("low"), F.max(KEY).alias("high"), F.count("*").alias("rows"))
        filled = filled.withColumn("folder", F.lit(batch).cast("long"))
        kept = files.join(touched, PARTITION, "left_anti")
        listed = kept.unionByName(filled).unionByName(ranges, allowMissingColumns=True).withColumn("v", F.lit(batch).cast("long"))
        # The list in force stays untouched until the new one is complete.
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/index/slot={1 - slot}")

    def publish_fields(self, batch: int, incoming: DataFrame, order: str, supplied: str) -> None:
        """Upsert rows that each supply the fields named in their array column `supplied`, and may repeat an identifier.

        Of a field the last supplied value in `order` counts, NULL too; one that no row supplies keeps the stored value.
        """
        if batch <= self.last_batch():
            return
        held = self.lookup(incoming.select(KEY).distinct())
        folded = fold_fields(held, incoming, KEY, order, supplied)
        self.publish(batch, stored(folded), self.schema.names)


class ContentTable:
    """Payloads by path, partitioned by batch and the month in the path."""

    COLUMNS = S.CONTENT
    # Bounds a file of payloads, which are written by the tasks that hold them.
    ROWS_PER_FILE = 10_000

    def __init__(self, spark: SparkSession, path: str, published: Callable[[], int]) -> None:
        self.spark, self.path, self._published = spark, path.rstrip("/"), published
        # Kept per path: the batch that wrote it last, and the hash of what it wrote.
        self._kept = KeyTable(spark, f"{self.path}-versions", "path_to_file", S.CONTENT_VERSIONS)

    @staticmethod
    def month_of(path: Column | str) -> Column:
        """The month segment, last but one of a landing key. Both sides of a join derive it."""
        return folder_name(F.try_element_at(F.split(text.as_column(path), "/"), F.lit(-2)))

    def write(self, batch: int, payloads: DataFrame) -> None:
        """Add the payloads of a batch, unique by path, where they are. Writing it again replaces it."""
        placed = payloads.select(*S.CONTENT.names).withColumn(
            "month", self.month_of("path_to_file")
        )
        placed.write.mode("overwrite").option("maxRecordsPerFile", self.ROWS_PER_FILE).partitionBy(
            "month"
        ).parquet(f"{self.path}/v={batch}")

    def _all(self) -> DataFrame:
        """Payloads of published batches: one that failed before its metadata does not count."""
        every = read_or_empty(self.spark, self.path, S.extended(S.CONTENT, "v bigint, month string"))
        return every.where(F.col("v") <= self._published())

    # -- newest versions --------------------------------------------------

    def versions(self, paths: DataFrame) -> DataFrame:
        """`path_to_file, file_hash, version` of the paths that are held: the batch that wrote each last. Reads no payload, and
        of what is kept per path the ranges that these paths fall into.

        What is kept is first brought up to the published batches, reading paths of those since only.
        """
        last, upto = self._published(), self._kept.upto()
        if upto < last:
            since = self._all().where(F.col("v") > upto).select("path_to_file", "file_hash", "v")
            new = since.groupBy("path_to_file").agg(F.max_by(F.struct("file_hash", F.col("v").alias("version")), "v").alias("s"))
            self._kept.add(last, stored(new.select("path_to_file", "s.*")), DELTAS)
        return self._kept.lookup(paths)

    def read(self) -> DataFrame:
        every = self._all()
        newest = self.versions(every.select("path_to_file").distinct())
        keys = newest.select("path_to_file", F.col("version").alias("v"))
        return every.join(keys, ["path_to_file", "v"], "left_semi").select(*S.CONTENT.names)

    def attach(self, metadata: DataFrame, columns: Iterable[str] = ("content",)) -> DataFrame:
        """Metadata rows with the payload at their `path_to_file`, NULL where none exists.

        The newest batch of each path is looked up and written as a narrow table. The one
        join that sees payloads is with that table, whose size the planner knows: it broadcasts a
        small one, and for a large one prunes partitions and filters payloads before they are shuffled.
        """
        keys = ["month", "path_to_file"]
        located = metadata.withColumn("month", self.month_of("path_to_file"))
        newest = self.versions(metadata.where(F.col("path_to_file").isNotNull()).select("path_to_file").distinct())
        newest = newest.select("path_to_file", F.col("version").alias("v"))
        versions = stored(located.join(newest, "path_to_file", "left"))

        found = versions.where(F.col("v").isNotNull())
        missing = versions.where(F.col("v").isNull())
        for name in columns:
            missing = missing.withColumn(name, F.lit(None).cast(S.CONTENT[name].dataType))
        joined = self._all().select(*keys, "v", *columns).join(found, [*keys, "v"])
        return joined.unionByName(missing).select(*metadata.columns, *columns)

    def holds(self, candidates: DataFrame) -> DataFrame:
        """Rows of `path_to_file, file_hash` whose payload is here with that hash. Reads no payload."""
        last = self.versions(candidates.select("path_to_file").distinct())
        return candidates.join(last.select("path_to_file", "file_hash"), ["path_to_file", "file_hash"], "left_semi")

    def unreferenced(self, metadata: DataFrame) -> DataFrame:
        """`path_to_file, v, reason` of the payloads that no row of the metadata leads to: replaced by a later one, or at a path that
        no row has. Reads no payload."""
        every = self._all().select("path_to_file", "v")
        newest = every.groupBy("path_to_file").agg(F.max("v").alias("last"))
        used = metadata.where(F.col("path_to_file").isNotNull()).select("path_to_file").distinct().withColumn("used", F.lit(True))
        judged = every.join(newest, "path_to_file").join(used, "path_to_file", "left")
        reason = F.when(F.col("v") < F.col("last"), "replaced").when(F.col("used").isNull(), "no row")
        return judged.select("path_to_file", "v", reason.alias("reason")).where("reason is not null")


class Zone:
    """A landing or processed zone below one folder: metadata, content and logs of each batch."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.cases = MetadataTable(spark, f"{self.path}/cases", schema)
        self.content = ContentTable(spark, f"{self.path}/content", self.cases.last_batch)

    def stage(self, name: str, batch: int, rows: DataFrame) -> DataFrame:
        """Write a step of a batch and read it back: evaluated once, no lineage behind it."""
        path = f"{self.path}/{name}/v={batch}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def staged(self, name: str, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}/v={batch}")


def landing_zone(spark: SparkSession, path: str) -> Zone:
    return Zone(spark, path, S.LANDING_CASES)


def processed_zone(spark: SparkSession, path: str) -> Zone:
    return Zone(spark, path, S.PROCESSED_CASES)
