"""Data-quality jobs: gold readiness and small-file compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def readiness(tables: dict[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """One row per table: rows, last event_date, ok (rows >= min_rows).

    Each input contributes one global aggregate; the union is as many rows as
    there are tables.
    """
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"),
                            F.max("event_date").alias("max_event_date"))
                     .select(F.lit(name).alias("table_name"), "rows", "max_event_date"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("rows") >= min_rows)


def compact(spark: SparkSession, path: str, out_path: str, partition_col: str = "event_date") -> None:
    """Rewrite a date-partitioned parquet table with few files per date.

    Rows are rebalanced by date, so a hot date still spreads over several
    tasks.  ``out_path`` is replaced as a whole.
    """
    from bazaar.session import spread_by_date
    df = spark.read.parquet(path)
    (spread_by_date(df, (partition_col,)).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(partition_col).parquet(out_path))
