"""SparkSession construction and the few session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library assumes. Time zone is pinned because the
# day truncation of change times and the epoch conversions are defined in UTC.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


UTC_NAMES = {"UTC", "ETC/UTC", "Z", "GMT", "+00:00"}

# Partition sizing for large inputs, used only where the cluster configuration
# leaves them unset: AQE sizes shuffle partitions to ~256 MB after each stage
# (so the static ``spark.sql.shuffle.partitions`` only needs to be an upper
# bound, e.g. a few thousand at 100 TB), honours that size instead of
# maximizing task count, and splits skewed partitions above 1 GB.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(
    master: str | None = None,
    app_name: str = "reviewforge",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session configured for the library.

    On a cluster the master, memory and checkpoint directory come from the
    submit configuration; locally we fill in what is missing.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    from pyspark import SparkConf

    submitted = SparkConf()  # what spark-submit / the cluster defaults already set
    conf = {k: v for k, v in SCALE_DEFAULTS.items() if not submitted.contains(k)}
    conf.update(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Apply the runtime settings to a session created elsewhere (e.g. by a driver).

    A setting that the session refuses (static, locked by the deployment) is
    read back; the time zone must hold, since naive timestamps, the default
    as-of date and day truncation are defined in UTC.
    """
    for key, value in SESSION_DEFAULTS.items():
        if str(spark.conf.get(key, None)).lower() == value.lower():
            continue
        try:
            spark.conf.set(key, value)
        except AnalysisException:
            if key == "spark.sql.session.timeZone":
                raise
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone is {zone}; this library needs UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master
    (tests) may leave it unset and gets a private scratch folder; on a cluster
    a folder of one machine would be invisible to the others, so that raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="reviewforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside, and are as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def shuffles_dropped(spark: SparkSession):
    """A write inside drops its shuffle files when it ends: the table replaces them.

    Otherwise they stay on the executors' disks until the driver happens to collect its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage like a checkpoint, but keeps column pruning and pushdown."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
