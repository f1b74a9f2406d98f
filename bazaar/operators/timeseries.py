"""Time-series features over one or many daily series.

``keys`` are the series keys: the windows are partitioned by them, so many
series (per product, per seller) spread over the cluster.  With no key there
is one series of one row per day, which is small by construction.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Lags, rolling widths and split fractions of the feature set.
TARGET_LAGS = (1, 2, 3, 7, 14, 28)
ROLL_WINDOWS = (7, 14, 28)
TRAFFIC_LAGS = (1, 7)
TRAIN_FRACTION = 0.70
VAL_END_FRACTION = 0.85


def _w(keys: Sequence[str], order: str = "event_date"):
    return Window.partitionBy(*keys).orderBy(order)


def calendar_features(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    d = F.col(date_col)
    dow = F.weekday(d)  # 0 = Monday
    return df.select(
        "*",
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"), F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        (dow >= 5).cast("int").alias("is_weekend"), F.quarter(d).alias("quarter"),
    )


def cyclical_features(df: DataFrame) -> DataFrame:
    two_pi = 2 * math.pi
    m, w = F.col("month"), F.col("day_of_week")
    return df.select(
        "*",
        F.sin(two_pi * m / 12).alias("month_sin"), F.cos(two_pi * m / 12).alias("month_cos"),
        F.sin(two_pi * w / 7).alias("dow_sin"), F.cos(two_pi * w / 7).alias("dow_cos"),
    )


def lag_features(df: DataFrame, target: str, keys: Sequence[str] = (),
                 lags: Sequence[int] = TARGET_LAGS, prefix: str = "revenue") -> DataFrame:
    w = _w(keys)
    return df.select("*", *[F.lag(target, k).over(w).alias(f"{prefix}_lag_{k}") for k in lags])


def rolling_features(df: DataFrame, target: str, keys: Sequence[str] = (),
                     widths: Sequence[int] = ROLL_WINDOWS, prefix: str = "revenue") -> DataFrame:
    """Mean / sample std / max of the ``n`` rows before the current one;
    NULL until the window is full (the current row is never included)."""
    cols = []
    for n in widths:
        w = _w(keys).rowsBetween(-n, -1)
        full = F.count(target).over(w) == n
        cols += [
            F.when(full, F.avg(target).over(w)).alias(f"{prefix}_roll_mean_{n}"),
            F.when(full, F.stddev_samp(target).over(w)).alias(f"{prefix}_roll_std_{n}"),
            F.when(full, F.max(target).over(w)).alias(f"{prefix}_roll_max_{n}"),
        ]
    return df.select("*", *cols)


def traffic_lag_features(df: DataFrame, keys: Sequence[str] = (),
                         lags: Sequence[int] = TRAFFIC_LAGS) -> DataFrame:
    w = _w(keys)
    cols = []
    for k in lags:
        cols.append(F.lag("total_sessions", k).over(w).alias(f"sessions_lag_{k}"))
        cols.append(F.lag("unique_visitors", k).over(w).alias(f"unique_visitors_lag_{k}"))
    return df.select("*", *cols)


def _guarded(num, den):
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))


def ratio_features(df: DataFrame, target: str = "total_revenue") -> DataFrame:
    return df.select(
        "*",
        _guarded("total_orders", "total_sessions").alias("conversion_rate"),
        _guarded("returned_orders", "total_orders").alias("return_rate"),
        _guarded(target, "total_orders").alias("avg_revenue_per_order"),
        _guarded(target, "unique_visitors").alias("revenue_per_visitor"),
    )


# Same-day functions of the target: leak the answer into the features.
LEAKY = ("avg_revenue_per_order", "revenue_per_visitor", "gross_revenue",
         "shipping_revenue", "payment_total")


def all_features(feature_df: DataFrame, target: str = "total_revenue",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Calendar + cyclical + lags + rolling + traffic lags + ratios, then drop
    rows with any NULL (the first 28 rows of every series)."""
    df = cyclical_features(calendar_features(feature_df))
    df = lag_features(df, target, keys)
    df = rolling_features(df, target, keys)
    df = traffic_lag_features(df, keys)
    df = ratio_features(df, target)
    return df.dropna()


def feature_columns(df: DataFrame, target: str = "total_revenue",
                    leakage: str = "reference", keys: Sequence[str] = ()) -> list[str]:
    skip = {target, "event_date", "gold_layer", "split", "rn", "n_rows", *keys}
    if leakage == "safe":
        skip |= set(LEAKY)
    return [c for c in df.columns if c not in skip]


def chronological_split(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """train / val / test by position in time within each series: the first
    floor(0.70 n) rows, then up to floor(0.85 n), then the rest."""
    rn = F.row_number().over(_w(keys))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    df = df.select("*", rn.alias("rn"), n.alias("n_rows"))
    train_end = F.floor(F.col("n_rows") * TRAIN_FRACTION)
    val_end = F.floor(F.col("n_rows") * VAL_END_FRACTION)
    return df.withColumn("split", F.when(F.col("rn") <= train_end, "train")
                         .when(F.col("rn") <= val_end, "val").otherwise("test"))


def split_summary(split_df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return split_df.groupBy(*keys, "split").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"))


def round_doubles(df: DataFrame, digits: int, cols: Sequence[str] | None = None) -> DataFrame:
    """Report format: double columns (all, or ``cols``) rounded to ``digits``."""
    pick = set(cols) if cols is not None else None
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() == "double" and (pick is None or f.name in pick)
                       else F.col(f.name) for f in df.schema.fields])
