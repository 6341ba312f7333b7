"""Distinct counts over many loads from stored sketches, with an exact recount where a sketch is no longer exact.

Per load and hash bucket of the review id a table keeps the number of rows and two
theta sketches: of the review keys (app, id) and of the ids. Sketches merge, so no
question about several loads reads the loads again. A theta sketch counts
exactly until it has seen 2^lg_k different values; its estimate is at least
2^lg_k from there on, which is the bound that is checked. What a sketch can't tell
is counted from the ledger, whose folders are one per load, and only from
the loads concerned, so results are exact at every size (up to equal 63-bit
hashes of different values within one bucket).

``SketchSize`` bounds the table: a sketch has at most 8 * 2^lg_k bytes. With the
defaults, loads of up to some 250,000 different keys are never counted again.

Defined results: rows without a review id have a bucket of their own; a null app is
an app like any other; a load recorded again replaces its sketches; no
recorded load gives no row (``dup_rate``) or 0 failures (``repeated_ids``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import indicators
from .ledger import _write_runs

SCHEMA = "bucket int, rows bigint, keys binary, ids binary, load_id string"
_NO_ID = -1


@dataclass(frozen=True)
class SketchSize:
    """All loads of one table share it: sketches of other sizes or buckets don't merge."""

    buckets: int = 64
    lg_k: int = 12

    @property
    def exact_below(self) -> int:
        return 2**self.lg_k


def _bucket(size: SketchSize) -> Column:
    own = F.pmod(F.xxhash64("recommendationid"), F.lit(size.buckets)).cast("int")
    return F.when(F.col("recommendationid").isNull(), F.lit(_NO_ID)).otherwise(own)


def _key() -> Column:
    """The review key as text; the app's length before it keeps (1, 23) and (12, 3) apart, signs keep null and empty."""
    app = F.coalesce(F.concat(F.length("appid"), F.lit(":"), "appid"), F.lit("-"))
    return F.concat(app, F.lit("/"), F.coalesce(F.concat(F.lit("="), "recommendationid"), F.lit("-")))


def record_loads(rows: DataFrame, path: str, size: SketchSize = SketchSize()) -> None:
    """Store the sketches of the loads in ``rows`` (whole loads, ledger columns).

    One aggregation: each task sends a sketch per load and bucket, whatever its rows.
    """
    counted = (
        rows.select("load_id", _bucket(size).alias("bucket"), _key().alias("key"), F.concat(F.lit("="), "recommendationid").alias("id"))
        .groupBy("load_id", "bucket")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.theta_sketch_agg("key", size.lg_k).alias("keys"),
            F.theta_sketch_agg("id", size.lg_k).alias("ids"),
        )
    )
    _write_runs(counted.select("bucket", "rows", "keys", "ids", "load_id"), path, ["load_id"])


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def unsure_loads(sketches: DataFrame, size: SketchSize = SketchSize()) -> list[str]:
    """The loads with more keys in some bucket than a sketch counts exactly (the driver reads a name per load)."""
    over = sketches.where(F.theta_sketch_estimate("keys") >= size.exact_below)
    return sorted(r[0] for r in over.select("load_id").distinct().collect())


def dup_rate(sketches: DataFrame, ledger: DataFrame, size: SketchSize = SketchSize()) -> DataFrame:
    """``indicators.dup_rate`` of the recorded loads: from their sketches, and from the ledger for those that overflowed."""
    unsure = unsure_loads(sketches, size)
    sure = sketches.where(~F.col("load_id").isin(unsure)) if unsure else sketches
    told = sure.groupBy("load_id").agg(
        F.sum("rows").cast("long").alias("rows"), F.sum(F.theta_sketch_estimate("keys")).cast("long").alias("distinct_keys")
    )
    told = told.withColumn("dup_rate", F.lit(1.0) - F.col("distinct_keys") / F.col("rows"))
    return told.unionByName(indicators.dup_rate(ledger.where(F.col("load_id").isin(unsure)))) if unsure else told


def suspects(sketches: DataFrame, size: SketchSize = SketchSize()) -> tuple[list[int], list[str]]:
    """(buckets, loads): where an id under two apps can be, over all loads together.

    A bucket is cleared if its merged sketches are exact and have as many keys as
    ids. A load is cleared if it has no row in the other buckets. The driver
    reads a number per bucket and a name per load.
    """
    named = sketches.where(F.col("bucket") != _NO_ID)
    merged = named.groupBy("bucket").agg(F.theta_union_agg("keys", size.lg_k).alias("keys"), F.theta_union_agg("ids", size.lg_k).alias("ids"))
    keys, ids = F.theta_sketch_estimate("keys"), F.theta_sketch_estimate("ids")
    buckets = sorted(r[0] for r in merged.where((keys >= size.exact_below) | (keys != ids)).select("bucket").collect())
    if not buckets:
        return [], []
    return buckets, sorted(r[0] for r in named.where(F.col("bucket").isin(buckets)).select("load_id").distinct().collect())


def repeated_ids(sketches: DataFrame, ledger: DataFrame, size: SketchSize = SketchSize()) -> DataFrame:
    """(failures): review ids that silver would hold more than once, that is, under several apps, over the recorded loads.

    Equal to the uniqueness check of silver compacted from those loads, which
    holds a row per review key. Only suspect buckets of suspect loads are counted, by two columns of the ledger.
    """
    buckets, loads = suspects(sketches, size)
    if not buckets:
        return sketches.sparkSession.range(1).select(F.lit(0).cast("long").alias("failures"))
    rows = ledger.where(F.col("load_id").isin(loads)).where(_bucket(size).isin(buckets))
    apps = rows.select("appid", "recommendationid").distinct().groupBy("recommendationid").count()
    return apps.where("count > 1").agg(F.count(F.lit(1)).cast("long").alias("failures"))
