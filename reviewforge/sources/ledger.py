"""Storage of the layers: landing files, the append-only ledger, watermarks,
and whole-table rebuilds of silver and gold.

Paths may be any Hadoop-compatible location shared by the cluster; all
reads and writes go through Spark (no driver-side file handling).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.utils import AnalysisException

from ..session import settings, shuffles_dropped

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("appid", T.StringType()),
        T.StructField("recommendationid", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("hash_payload", T.StringType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("appid", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("max_updated_at", T.TimestampNTZType()),
        T.StructField("recorded_at", T.TimestampNTZType()),
    ]
)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("parquet").load(path).limit(0).count()
        return True
    except AnalysisException:
        return False


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None) -> None:
    """Create an empty table with the fixed schema when none exists at ``path``."""
    if _exists(spark, path):
        return
    writer = spark.createDataFrame([], schema).write.mode("ignore")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def prepare_storage(spark: SparkSession, ledger_path: str, watermarks_path: str) -> None:
    ensure_table(spark, ledger_path, LEDGER_SCHEMA, "load_id")
    ensure_table(spark, watermarks_path, WATERMARK_SCHEMA, "load_id")


def _write_runs(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Write one run's folders, replacing only those folders.

    Dynamic partition overwrite: a run re-executed after a failure rewrites
    its own ``load_id`` partition instead of appending a second copy, and the
    other runs' folders are never touched; within a run, Spark's commit
    protocol keeps failed tasks' output out.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**(options or {}))
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path)
    )


# The ledger's codec, and its rows per file: a file of some hundred MB where payloads have a few hundred bytes.
LEDGER_OPTIONS = {"compression": "zstd", "maxRecordsPerFile": "4000000"}
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_PLANNED = "spark.sql.optimizer.plannedWrite.enabled"


def unsorted_writes(spark: SparkSession, open_files: int = 16):
    """Writes whose tasks keep the files of a few partition folders open at once, so that rows need no sort by folder.

    A task that meets more folders goes on with a sort, as without this."""
    return settings(spark, {_OPEN_FILES: str(open_files), _PLANNED: "false"})


def append_ledger(rows: DataFrame, path: str) -> None:
    """Add one run's rows, partitioned by ``load_id`` (one folder per run,
    so a run can be pruned or replayed as a unit, and re-running it is
    idempotent). Rows are neither shuffled nor sorted for the write: files
    follow the tasks that made the rows (AQE sizes those after a shuffle), and
    a number of rows ends a file, so none is a giant one."""
    cols = [f.name for f in LEDGER_SCHEMA.fields]
    with unsorted_writes(rows.sparkSession), shuffles_dropped(rows.sparkSession):
        _write_runs(rows.select(*cols), path, ["load_id"], options=LEDGER_OPTIONS)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    cols = [f.name for f in LEDGER_SCHEMA.fields]
    return spark.read.schema(LEDGER_SCHEMA).parquet(path).select(*cols)


def ledger_files(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's files themselves, for readers that address rows by file and row index."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def append_watermarks(watermarks: DataFrame, path: str) -> None:
    """One row per app and run, in the run's ``load_id`` folder."""
    _write_runs(watermarks.select(*[f.name for f in WATERMARK_SCHEMA.fields]).hint("rebalance"), path, ["load_id"])


def read_watermarks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WATERMARK_SCHEMA).parquet(path).select(*[f.name for f in WATERMARK_SCHEMA.fields])


def write_landing(reviews: DataFrame, path: str, load_id: str) -> None:
    """JSON lines ``{"app_id", "payload"}``, one review per line, one folder per run.

    Files follow the tasks that made the rows, as in the ledger: their number
    grows with the data, not with the apps, and a re-executed run replaces its
    folder whole."""
    landed = reviews.select(F.col("app_id").cast("string"), "payload", F.lit(load_id).alias("load_id"))
    with unsorted_writes(reviews.sparkSession):
        _write_runs(landed, path, ["load_id"], fmt="json")


def _folder_value(name: Column) -> Column:
    """A partition value from its folder's name as it stands in a file's address, so escaped twice."""
    plain = name
    for _ in range(2):
        plain = F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain)
    return F.when(plain != F.lit("__HIVE_DEFAULT_PARTITION__"), plain)


def landed_rows(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """``(payload, app_id, load_id)`` of landed lines, a table or a stream.

    Folders per app and run (``app_id=../load_id=..``), as landed before, hold
    bare payloads and are read too. Ids stay text (an app id such as ``007``
    is not a number)."""
    file = F.col("_metadata.file_path")
    lines = reader.schema("value string").option("recursiveFileLookup", "true").text(path).select(
        "value",
        F.regexp_extract(file, "/app_id=([^/]+)/load_id=[^/]+/[^/]+$", 1).alias("_app"),
        _folder_value(F.regexp_extract(file, "/load_id=([^/]+)/[^/]+$", 1)).alias("load_id"),
        F.from_json("value", "app_id string, payload string").alias("_line"),
    )
    per_app = F.col("_app") != F.lit("")
    return lines.select(
        F.when(per_app, F.col("value")).otherwise(F.col("_line.payload")).alias("payload"),
        F.when(per_app, _folder_value(F.col("_app"))).otherwise(F.col("_line.app_id")).alias("app_id"),
        "load_id",
    )


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Replay landed JSON lines: ``(payload, app_id, load_id)``."""
    return landed_rows(spark.read, path)


def append_new_columns(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; columns new in ``batch`` are added (NULL in older rows),
    columns missing from ``batch`` are NULL in its rows."""
    return existing.unionByName(batch, allowMissingColumns=True)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose files carry different column sets."""
    return spark.read.option("mergeSchema", "true").parquet(path)


# ---------------------------------------------------------------- rebuilds

_PUBLISHED = "_published"


def stage_version(df: DataFrame, base: str, version: str) -> DataFrame:
    """Write a full rebuild into its own version folder and read it back; no reader sees it yet."""
    target = f"{base.rstrip('/')}/v={version}"
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(target)
    return df.sparkSession.read.parquet(target)


def publish_version(spark: SparkSession, base: str, version: str) -> None:
    """Make a staged version the current one.

    Every publication adds one pointer file and removes none, so a writer lost
    at any point leaves the version published before it."""
    at = _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="microseconds")
    pointer = spark.createDataFrame([(at, version)], "at string, version string")
    pointer.coalesce(1).write.mode("append").json(f"{base.rstrip('/')}/{_PUBLISHED}")


def write_version(df: DataFrame, base: str, version: str) -> str:
    """Full rebuild into a fresh version folder, then publish it.

    Readers of the previous version are never overwritten under their feet,
    and a rebuild may read the table it replaces.
    """
    stage_version(df, base, version)
    publish_version(df.sparkSession, base, version)
    return f"{base.rstrip('/')}/v={version}"


def current_version(spark: SparkSession, base: str) -> str | None:
    """The version published last, or None."""
    try:
        pointers = spark.read.schema("at string, version string").json(f"{base.rstrip('/')}/{_PUBLISHED}")
        return pointers.agg(F.max_by("version", "at")).first()[0]
    except AnalysisException:
        return None


def read_current(spark: SparkSession, base: str) -> DataFrame:
    v = current_version(spark, base)
    if v is None:
        raise FileNotFoundError(f"no version written under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/v={v}")


# ------------------------------------------------------------ page envelopes

PAGES_SCHEMA = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


def write_page_envelopes(pages: DataFrame, path: str) -> None:
    """Land fetched pages as JSON lines (the envelope kept as text), one
    folder per app so a replay can prune by app."""
    (
        pages.select(*[f.name for f in PAGES_SCHEMA.fields])
        .hint("rebalance", "app_id")
        .write.mode("append")
        .partitionBy("app_id")
        .json(path)
    )


def read_page_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages with an explicit schema (no inference pass over the files)."""
    return spark.read.schema(PAGES_SCHEMA).json(path).select(*[f.name for f in PAGES_SCHEMA.fields])
