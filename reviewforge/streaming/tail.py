"""Structured Streaming tail of the landing folder into the ledger.

Landed JSON lines are picked up as they appear; each micro-batch becomes
one load (``load_id = stream-<batch id>``, one ``ingested_at`` per batch),
written as its own ledger partition with dynamic partition overwrite, so a
replayed batch after a failure rewrites the same partition instead of
appending twice. The stream's progress lives in the checkpoint location
(under the cluster's shared checkpoint folder by default).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.casts import epoch_to_timestamp
from ..functions.payload import canonical_hash
from ..session import checkpoint_dir
from ..sources import ledger as store


def stream_load_id(batch_id: int) -> str:
    return f"stream-{batch_id:010d}"


def _ledger_from_landing(batch: DataFrame, load_id: str, ingested_at: _dt.datetime) -> DataFrame:
    v = F.try_parse_json(F.col("payload"))
    rows = batch.select(
        F.col("app_id").alias("appid"),
        F.try_variant_get(v, "$.recommendationid", "string").alias("recommendationid"),
        epoch_to_timestamp(F.try_variant_get(v, "$.timestamp_updated", "bigint")).alias("updated_at"),
        F.lit(ingested_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("ingested_at"),
        F.lit(load_id).alias("load_id"),
        canonical_hash(F.col("payload")).alias("hash_payload"),
        F.try_variant_get(v, "$.cursor", "string").alias("cursor"),
        F.col("payload"),
    )
    return rows.filter(F.col("appid").isNotNull() & F.col("recommendationid").isNotNull())


def _batch_watermarks(rows: DataFrame, load_id: str, recorded_at: _dt.datetime) -> DataFrame:
    """Per app in the batch: the last non-empty cursor by page, as in a run's
    watermarks, and the latest update time. A page has one request cursor, so
    its reviews need no order among them."""
    page = F.try_variant_get(F.try_parse_json(F.col("payload")), "$.page", "int")
    named = F.col("cursor").isNotNull() & (F.col("cursor") != F.lit(""))
    per_app = rows.withColumn("_page", page).groupBy("appid").agg(
        F.max(F.when(named, F.struct("_page", "cursor")))["cursor"].alias("cursor"),
        F.max("updated_at").alias("max_updated_at"),
    )
    return per_app.select(
        "appid",
        F.lit(load_id).alias("load_id"),
        "cursor",
        "max_updated_at",
        F.lit(recorded_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("recorded_at"),
    )


def tail_landing(
    spark: SparkSession,
    landing_path: str,
    ledger_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    watermarks_path: str | None = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    With ``watermarks_path`` each micro-batch also records one watermark row
    per app it touched (same load id, same replay-safe partition write)."""
    checkpoint_location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/tail-landing"
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = store.landed_rows(reader, landing_path).select("payload", "app_id")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = stream_load_id(batch_id)
        ingested_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        rows = _ledger_from_landing(batch, load_id, ingested_at)
        store.append_ledger(rows, ledger_path)
        if watermarks_path:
            written = store.read_ledger(spark, ledger_path).filter(F.col("load_id") == F.lit(load_id))
            store.append_watermarks(_batch_watermarks(written, load_id, ingested_at), watermarks_path)

    writer = landed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
