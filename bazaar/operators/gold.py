"""Gold layer: daily KPI aggregates over silver tables.

All are hash aggregates (partial aggregation before the shuffle, so a hot
day or product is pre-combined map-side).  ``distinct="exact"`` uses
``count_distinct`` (batch); ``distinct="approx"`` uses HyperLogLog++
(``approx_count_distinct``, rsd 0.02), the only form Spark accepts in
a streaming aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions.rounding import round2_avg, round2_sum


#: Relative standard deviation of approximate distinct counts.
APPROX_RSD = 0.02


def _distinct(c: str, mode: str) -> Column:
    if mode == "exact":
        return F.count_distinct(F.col(c))
    if mode == "approx":
        return F.approx_count_distinct(F.col(c), APPROX_RSD)
    raise ValueError(f"distinct must be 'exact' or 'approx', got {mode!r}")


def _small_distinct(c: str, mode: str) -> Column:
    """The same for many small groups: an estimate whose sketch grows with its
    group (HyperLogLog of 4096 registers at most, rsd 0.016)."""
    if mode == "approx":
        return F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c), 12))
    return _distinct(c, mode)


def _default_mode(df: DataFrame, distinct: str | None) -> str:
    return distinct or ("approx" if df.isStreaming else "exact")


def _tag(df: DataFrame) -> DataFrame:
    return df.withColumn("gold_layer", F.lit("gold"))


def daily_sales(order_items: DataFrame, distinct: str | None = None) -> DataFrame:
    m = _default_mode(order_items, distinct)
    return _tag(order_items.groupBy("event_date").agg(
        round2_sum("price").alias("gross_revenue"),
        round2_sum("freight_value").alias("shipping_revenue"),
        round2_sum("item_total").alias("total_revenue"),
        _distinct("order_id", m).alias("total_orders"),
        _distinct("product_id", m).alias("total_products"),
        # item-level mean, as the contract defines it
        round2_avg("item_total").alias("avg_order_value"),
    ))


def top_products(order_items: DataFrame) -> DataFrame:
    return _tag(order_items.groupBy("event_date", "product_id").agg(
        F.count(F.lit(1)).alias("items_sold"),
        round2_sum("item_total").alias("product_revenue"),
        round2_avg("price").alias("avg_price"),
    ))


def seller_performance(order_items: DataFrame, distinct: str | None = None) -> DataFrame:
    m = _default_mode(order_items, distinct)
    return _tag(order_items.groupBy("event_date", "seller_id").agg(
        _small_distinct("order_id", m).alias("total_orders"),
        round2_sum("item_total").alias("seller_revenue"),
    ))


def payment_analytics(payments: DataFrame) -> DataFrame:
    return _tag(payments.groupBy("event_date", "payment_method").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        round2_sum("payment_value").alias("payment_total"),
        round2_avg("payment_value").alias("avg_payment"),
        F.sum("fraud_flag").alias("fraud_transactions"),
    ))


def review_analytics(reviews: DataFrame) -> DataFrame:
    return _tag(reviews.groupBy("event_date", "review_sentiment").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        round2_avg("rating").alias("avg_rating"),
    ))


def shipping_kpi(shipments: DataFrame) -> DataFrame:
    return _tag(shipments.groupBy("event_date", "shipping_status").agg(
        F.count(F.lit(1)).alias("total_shipments"),
        round2_avg("delivery_days").alias("avg_delivery_days"),
        round2_avg("shipping_fee").alias("avg_shipping_fee"),
    ))


def inventory_kpi(inventory: DataFrame) -> DataFrame:
    return _tag(inventory.groupBy("event_date", "inventory_status").agg(
        F.count(F.lit(1)).alias("total_products"),
        round2_avg("stock_on_hand").alias("avg_stock"),
        F.sum("units_sold").alias("units_sold"),
    ))


def traffic_kpi(traffic: DataFrame) -> DataFrame:
    return _tag(traffic.groupBy("event_date", "traffic_source").agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("unique_visitors").alias("unique_visitors"),
        F.sum("page_views").alias("page_views"),
        round2_avg("pages_per_session").alias("avg_pages_per_session"),
    ))


def returns_kpi(returns: DataFrame, distinct: str | None = None) -> DataFrame:
    m = _default_mode(returns, distinct)
    return _tag(returns.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_returns"),
        _distinct("order_id", m).alias("returned_orders"),
        _distinct("product_id", m).alias("returned_products"),
    ))


# gold table -> (silver source, builder)
GOLD = {
    "daily_sales": ("order_items", daily_sales),
    "top_products": ("order_items", top_products),
    "seller_performance": ("order_items", seller_performance),
    "payment_analytics": ("payments", payment_analytics),
    "review_analytics": ("reviews", review_analytics),
    "shipping_kpi": ("shipments", shipping_kpi),
    "inventory_kpi": ("inventory", inventory_kpi),
    "traffic_kpi": ("traffic", traffic_kpi),
    "returns_kpi": ("returns", returns_kpi),
}


# wire fields besides the keys that the tables are built from
USES = {
    "daily_sales": ("price", "freight_value"),
    "top_products": ("price", "freight_value"),
    "seller_performance": ("seller_id", "price", "freight_value"),
    "payment_analytics": ("payment_method", "payment_value"),
    "review_analytics": ("rating",),
    "shipping_kpi": ("ship_date", "delivery_date", "shipping_fee"),
    "inventory_kpi": ("stock_on_hand", "units_sold"),
    "traffic_kpi": ("sessions", "unique_visitors", "page_views"),
    "returns_kpi": ("order_id", "product_id"),
}


# tables whose builder counts distinct ids (takes ``distinct=``)
COUNTS_DISTINCT = frozenset({"daily_sales", "seller_performance", "returns_kpi"})


def build(table: str, silver_df: DataFrame, distinct: str | None = None) -> DataFrame:
    fn = GOLD[table][1]
    return fn(silver_df, distinct=distinct) if table in COUNTS_DISTINCT else fn(silver_df)
