"""Dense 0..n-1 indices for 64-bit keys, computed distributed.

Spark ML factor models index users and items by 32-bit integers.  Instead of
rejecting larger keys (or collecting the distinct keys to the driver, as a
label indexer does), the distinct keys are range-partitioned and stored once
(``checkpoint``: the assignment must not change if a task is retried), each
range partition is numbered locally, and a per-partition offset -- a table
with one row per partition, so its size is bounded by the partition count,
not by the data -- is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.session import shared_dir, shuffle_partitions


def dense_index(df: DataFrame, key: str, out: str) -> DataFrame:
    """(key, out) for every distinct non-NULL key; ``out`` is 0..n-1 in key order."""
    spark = df.sparkSession
    shared_dir(spark)
    n = shuffle_partitions(spark)
    keys = (df.select(key).where(F.col(key).isNotNull()).distinct()
            .repartitionByRange(n, key).withColumn("_part", F.spark_partition_id())
            .checkpoint())
    counts = keys.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return (keys.join(F.broadcast(offsets), "_part")
            .select(key, (F.col("_off") + local).cast("int").alias(out)))
