"""Dense 1-based row numbers within groups, without a per-group task.

``row_number() over (partition by g order by o)`` sends every row of a group
to one task; a group holding a third of the data then runs on one core. Here
the rows are range-partitioned on (g, o) instead, so a large group is spread
over many partitions in order. Each partition numbers its rows locally
(``monotonically_increasing_id`` counts rows in partition order), a small
table of per-(partition, group) counts gives each block its offset, and one
join turns local positions into group-wide numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import join_per_key
from ..session import checkpoint_dir


def number_within(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    out: str = "rn",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its group by ``order_cols``.

    ``order_cols`` must make the order total inside a group (end with a key),
    otherwise ties make the numbering, like ``row_number``, arbitrary.
    """
    spark: SparkSession = df.sparkSession
    keys = [*group_cols, *order_cols]
    # Without an explicit count AQE sizes the range partitions; coalesced
    # partitions are contiguous key ranges, so positions stay in order.
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged = (
        ranged.sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # The positions are used twice (block counts and the final join); cut the
    # lineage so both uses see the same partitioning, and a lost executor
    # re-reads the written copy instead of re-sampling range bounds.
    checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    blk = F.shiftright(F.col("_mid"), 33)
    blocks = (
        ranged.groupBy(blk.alias("_blk"), *group_cols)
        .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    )
    w = Window.partitionBy(*group_cols).orderBy("_blk")
    blocks = blocks.withColumn("_before", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    numbered = join_per_key(ranged.withColumn("_blk", blk), blocks, ["_blk", *group_cols])
    return numbered.withColumn(out, F.col("_mid") - F.col("_first") + F.col("_before") + F.lit(1)).drop(
        "_mid", "_blk", "_first", "_before"
    )
