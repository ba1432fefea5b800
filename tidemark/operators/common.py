"""Shared operator helpers: surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def sparse_surrogate(df: DataFrame, start: int, col: str = "sequence_number") -> DataFrame:
    """F4, sparse: unique, increasing per partition, gaps allowed — no shuffle, no driver work."""
    return df.withColumn(col, F.lit(start) + F.monotonically_increasing_id() + F.lit(1))


def dense_surrogate(df: DataFrame, order_col: str, start: int, col: str = "sequence_number") -> DataFrame:
    """F4, dense: ``start + row_number() over (order by order_col)`` without a single-partition window.

    Range-partition and sort by ``order_col``, pin the result with a reliable
    checkpoint (so the counted and the numbered rows are the same rows even
    after an executor loss), count rows per partition (one small row per
    partition reaches the driver), then number rows as partition offset +
    position inside the partition.
    """
    from ..session import checkpoint_dir, reliable_checkpoint

    spark = df.sparkSession
    checkpoint_dir(spark)
    # monotonically_increasing_id = (partition index << 33) + position in partition.
    ranged = (df.repartitionByRange(order_col).sortWithinPartitions(order_col)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = (reliable_checkpoint(ranged)
                    .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
                    .withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid"), 33)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()
    offsets, acc = [], start
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((r["_pid"], acc))
        acc += r["_n"]
    if not offsets:
        return ranged.drop("_mid", "_pid", "_pos").withColumn(col, F.lit(None).cast("bigint"))
    off = spark.createDataFrame(offsets, "_pid long, _base long")
    return (ranged.join(F.broadcast(off), "_pid")
                  .withColumn(col, (F.col("_base") + F.col("_pos") + 1).cast("bigint"))
                  .drop("_mid", "_pid", "_pos", "_base"))
