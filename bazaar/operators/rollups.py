"""Daily roll-ups of gold tables and the daily feature table.

Gold tables are small (one row per day and category); the roll-ups reduce
them to one row per day (per series key when given) and the feature table
left-joins them onto the date spine.  Every join input is already grouped by
the join key, so AQE turns the joins into broadcast joins at run time when
the sides are small and keeps sort-merge joins otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions.lenient import normalize_event_date as _norm_col

# Sanity window on the year of a daily row (both exclusive).
MIN_YEAR_EXCL = 2000
MAX_YEAR_EXCL = 2030


def normalize_event_date(df: DataFrame, col: str = "event_date") -> DataFrame:
    dt = df.schema[col].dataType
    return df.withColumn(col, _norm_col(col, dt))


def sane_dates(df: DataFrame, col: str = "event_date", after_year: int = MIN_YEAR_EXCL,
               before_year: int = MAX_YEAR_EXCL) -> DataFrame:
    """Keep rows with after_year < year < before_year, written as a date range
    so the predicate can prune partitions / row groups."""
    lo = F.lit(f"{after_year + 1:04d}-01-01").cast("date")
    hi = F.lit(f"{before_year:04d}-01-01").cast("date")
    return df.where(F.col(col).isNotNull() & (F.col(col) >= lo) & (F.col(col) < hi))


def traffic_daily(traffic_kpi: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return traffic_kpi.groupBy("event_date", *keys).agg(
        F.sum("total_sessions").alias("total_sessions"),
        F.sum("unique_visitors").alias("unique_visitors"),
        F.sum("page_views").alias("page_views"),
        F.avg("avg_pages_per_session").alias("avg_pages_per_session"))


def payment_daily(payment_analytics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return payment_analytics.groupBy("event_date", *keys).agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.round(F.sum("payment_total"), 2).alias("payment_total"),
        F.avg("avg_payment").alias("avg_payment"),
        F.sum("fraud_transactions").alias("fraud_transactions"))


def inventory_daily(inventory_kpi: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return inventory_kpi.groupBy("event_date", *keys).agg(
        F.sum("units_sold").alias("inv_units_sold"),
        F.avg("avg_stock").alias("avg_stock"))


def returns_daily(returns_kpi: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return returns_kpi.groupBy("event_date", *keys).agg(
        F.sum("total_returns").alias("total_returns"),
        F.sum("returned_orders").alias("returned_orders"))


def reviews_daily(review_analytics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return review_analytics.groupBy("event_date", *keys).agg(
        F.sum("total_reviews").alias("total_reviews"),
        F.avg("avg_rating").alias("avg_rating"))


def date_spine(daily: DataFrame, keys: Sequence[str] = (), gap_fill: bool = False) -> DataFrame:
    """Distinct days of the target table; with ``gap_fill`` every calendar day
    between each series' first and last day (one sequence per series)."""
    spine = daily.select("event_date", *keys).distinct()
    if not gap_fill:
        return spine
    b = spine.groupBy(*keys).agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    return b.select(*keys, F.explode(F.sequence("lo", "hi")).alias("event_date"))


def fill_numeric(df: DataFrame, value=0) -> DataFrame:
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.fillna(value, subset=num)


def feature_table(daily_sales: DataFrame, traffic: DataFrame, payments: DataFrame,
                  inventory: DataFrame, returns: DataFrame, reviews: DataFrame,
                  keys: Sequence[str] = (), gap_fill: bool = False,
                  unique_days: bool = True, years: tuple[int, int] = (MIN_YEAR_EXCL, MAX_YEAR_EXCL)) -> DataFrame:
    """Spine + six left joins on the day (USING semantics) + NULL -> 0.

    ``unique_days``: the daily-sales input has one row per day (and series
    key), as the gold table has by construction, so "distinct days left-join
    daily sales" is daily sales itself and it is computed once.  Pass False
    for an input that may repeat a day after date normalisation.
    """
    ds = sane_dates(normalize_event_date(daily_sales), "event_date", *years)
    on = ["event_date", *keys]
    if unique_days and not gap_fill:
        out, first = ds, 1
    else:
        out, first = date_spine(ds, keys, gap_fill), 0
    for part in (ds,
                 traffic_daily(normalize_event_date(traffic)),
                 payment_daily(normalize_event_date(payments)),
                 inventory_daily(normalize_event_date(inventory)),
                 returns_daily(normalize_event_date(returns)),
                 reviews_daily(normalize_event_date(reviews)))[first:]:
        join_on = [k for k in on if k in part.columns]
        out = out.join(part, join_on, "left")
    return fill_numeric(out)
