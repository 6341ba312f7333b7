"""Running watermarks: the load watermarks as the state of a stream.

The tail's watermarks speak of one micro-batch. Here the last non-empty cursor
and the latest update time of each app are kept in the stream's state store
across micro-batches and restarts, so however the landing files are cut into
batches, the rows are those of the batch operator over all of them. The state
is one row per app, combined map-side before it is met: an app with a third of
all reviews adds one row per task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.casts import epoch_to_timestamp
from ..session import checkpoint_dir
from ..sources import ledger as store
from .tail import stream_load_id


def app_watermarks(landed: DataFrame) -> DataFrame:
    """(appid, cursor, max_updated_at) of landed reviews, a stream or a table.

    The last non-empty cursor is the one of the highest page of the latest run;
    run ids sort by time. A page has one request cursor, so its reviews need no
    order among them. A payload that is no JSON or has no page has no place in
    the order and no cursor counts from it. An app without cursors has null.
    """
    v = F.try_parse_json(F.col("payload"))
    rows = landed.select(
        F.col("app_id").alias("appid"),
        "load_id",
        F.try_variant_get(v, "$.page", "int").alias("page"),
        F.try_variant_get(v, "$.cursor", "string").alias("cursor"),
        epoch_to_timestamp(F.try_variant_get(v, "$.timestamp_updated", "bigint")).alias("updated_at"),
    ).filter(F.col("appid").isNotNull())
    counts = F.col("page").isNotNull() & (F.col("cursor") != F.lit(""))
    return rows.groupBy("appid").agg(
        F.max(F.when(counts, F.struct("load_id", "page", "cursor")))["cursor"].alias("cursor"),
        F.max("updated_at").alias("max_updated_at"),
    )


def stream_watermarks(
    spark: SparkSession,
    landing_path: str,
    watermarks_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream: each micro-batch writes the watermarks of the apps it
    touched, as they are over everything landed so far.

    A batch is one load (``stream-<batch id>``) in its own folder of the
    watermark table, so a replayed batch writes its folder again. The number of
    shuffle partitions at the first start is the state's for good.
    """
    checkpoint_location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/stream-watermarks"
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = store.landed_rows(reader, landing_path)

    def write_batch(changed: DataFrame, batch_id: int) -> None:
        recorded_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rows = changed.select(
            "*",
            F.lit(stream_load_id(batch_id)).alias("load_id"),
            F.lit(recorded_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("recorded_at"),
        )
        store.append_watermarks(rows, watermarks_path)

    writer = app_watermarks(landed).writeStream.outputMode("update").foreachBatch(write_batch)
    writer = writer.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def latest_watermarks(watermarks: DataFrame) -> DataFrame:
    """(appid, cursor, max_updated_at): each app's row of the last load that touched it."""
    newest = watermarks.groupBy("appid").agg(
        F.max_by(F.struct("cursor", "max_updated_at"), F.struct("recorded_at", "load_id")).alias("w")
    )
    return newest.select("appid", "w.*")
