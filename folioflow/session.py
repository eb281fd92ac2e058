"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Tasks for each core where rows are spread: the last of them end at about the same time.
TASKS_PER_CORE = 3

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide projections generate long methods, which the JVM would interpret rather than compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Building wide columns is slow while every call records where it was made.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Pages are large: bound what one Arrow batch holds in a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    STATE_STORE: ROCKS_DB,
}


def local_session(cores: str = "8", shuffle_partitions: str = "8") -> SparkSession:
    """A session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("folioflow")
    builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without one gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="folioflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back.

    Computes the rows once, cuts their lineage, outlives lost executors, and gives the planner
    their real size. (A checkpoint would compute them twice.) What was shuffled for them is
    deleted as soon as they are written, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stored")
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def stored_count(df: DataFrame) -> tuple[DataFrame, int]:
    """`stored`, with the number of rows that were written."""
    seen = Observation()
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out, seen.get["n"]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a key, nearly unique, to a few tasks for each core: however few files or row groups they come from."""
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, key)


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few driver rows as a local relation: no Python task reads it, and joins with none fold away."""
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [() for _ in schema.names]
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package's code to the Python workers, once per application.

    The archive is served by the session, so executors that join later get it too. A package
    that came as an archive itself (`--py-files`) is there already.
    """
    context = spark.sparkContext
    package = Path(__file__).parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="folioflow-code-")) / "folioflow-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, Path(package.name) / source.relative_to(package))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
