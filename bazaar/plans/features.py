"""Daily feature table and time-series feature plans from the gold layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators import rollups as R
from bazaar.operators import timeseries as TS
from bazaar.plans.medallion import gold_table

TARGET = "total_revenue"


def aligned_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A gold table with its days moved, so that all entities share one span of
    sane years (the driver tables' spans hardly meet)."""
    day = F.col("event_date")
    if name == "traffic_kpi":
        moved = F.date_add(F.lit("2006-01-01").cast("date"),
                           F.pmod(F.datediff(day, F.lit("2000-01-01").cast("date")), F.lit(1461)).cast("int"))
    else:
        moved = F.date_add(day, 1826 if name == "inventory_kpi" else 3653)
    return gold_table(spark, sf_dir, name).withColumn("event_date", moved)


def feature_table(spark: SparkSession, sf_dir: str, gap_fill: bool = False, gold=gold_table) -> DataFrame:
    g = lambda name: gold(spark, sf_dir, name)
    return R.feature_table(g("daily_sales"), g("traffic_kpi"), g("payment_analytics"),
                           g("inventory_kpi"), g("returns_kpi"), g("review_analytics"),
                           gap_fill=gap_fill)


def model_frame(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    """All features, rows with a NULL dropped, and the chronological split."""
    return TS.chronological_split(TS.all_features(feature_table(spark, sf_dir), TARGET, keys), keys)


def product_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily revenue series per product (from gold top_products)."""
    return gold_table(spark, sf_dir, "top_products").select("event_date", "product_id",
                                                            "product_revenue")


def product_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["product_id"]
    s = product_series(spark, sf_dir)
    s = TS.lag_features(s, "product_revenue", keys, lags=(1, 7), prefix="rev")
    s = TS.rolling_features(s, "product_revenue", keys, widths=(7,), prefix="rev")
    return TS.round_doubles(s, 4)


def date_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in three layouts (and some junk) parsed back."""
    from bazaar.sources.testdata import table
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey")
    text = (F.when(k % 11 == 0, F.lit("bad"))
            .when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k % 3 == 1, F.date_format(d, "yyyyMMdd"))
            .otherwise(F.date_format(d, "dd/MM/yyyy")))
    df = o.select(k.alias("order_id"), text.alias("event_date"))
    df = df.withColumn("date_text", F.col("event_date"))
    return R.sane_dates(R.normalize_event_date(df))
