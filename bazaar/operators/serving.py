"""Serving queries: the tables and figures a dashboard reads.

Every function returns a DataFrame; nothing is collected.  Figures that a
UI shows as a single number come back as one-row DataFrames built from a
global aggregate (partial aggregation on every task, one tiny merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions.rounding import round2_avg, round2_sum
from bazaar.operators.gold import APPROX_RSD

# Inventory states that raise an alert; the dashboard's
# display time zone.
ALERT_STATES = ("STOCKOUT", "LOW_STOCK", "OVERSTOCK")
DISPLAY_TZ = "Asia/Ho_Chi_Minh"


def _share(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Percent of the total, exact to two decimals.

    The input is already grouped by a small category set, so the un-keyed
    window only sees one row per category.
    """
    total = F.sum(value).over(Window.partitionBy())
    pct = F.round(F.try_divide(F.col(value).cast("decimal(38,0)") * 100, total), 2)
    return df.withColumn(name, pct.cast("double"))


def sales_kpi(order_items: DataFrame, window: str = "1 day", distinct: str | None = None) -> DataFrame:
    """Tumbling-window sales (window_start, window_end, revenue, orders, AOV)."""
    mode = distinct or ("approx" if order_items.isStreaming else "exact")
    orders = (F.count_distinct("order_id") if mode == "exact"
              else F.approx_count_distinct("order_id", APPROX_RSD))
    g = order_items.groupBy(F.window("event_timestamp", window).alias("w")).agg(
        round2_sum("item_total").alias("total_revenue"),
        orders.alias("total_orders"),
        round2_avg("item_total").alias("avg_order_value"),
    )
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "total_revenue", "total_orders", "avg_order_value")


def headline(sales: DataFrame) -> DataFrame:
    """Headline KPIs, 0 when the table is empty."""
    return sales.agg(
        F.coalesce(round2_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce(round2_avg("avg_order_value"), F.lit(0.0)).alias("avg_order_value"),
    )


def sales_window(sales: DataFrame) -> DataFrame:
    return sales.select("window_start", "total_revenue")


def sentiment_distribution(review_analytics: DataFrame) -> DataFrame:
    g = review_analytics.groupBy("review_sentiment").agg(F.sum("total_reviews").alias("total_reviews"))
    return _share(g, "total_reviews")


def inventory_alert(inventory_kpi: DataFrame) -> DataFrame:
    return inventory_kpi.where(F.col("inventory_status").isin(*ALERT_STATES)).select(
        "event_date", "inventory_status", "total_products", "avg_stock", "units_sold")


def inventory_status_distribution(alerts: DataFrame) -> DataFrame:
    g = alerts.groupBy("inventory_status").agg(F.sum("total_products").alias("total_products"))
    return _share(g, "total_products")


def sessions_by_source(traffic_kpi: DataFrame) -> DataFrame:
    g = traffic_kpi.groupBy("traffic_source").agg(F.sum("total_sessions").alias("total_sessions"))
    return _share(g, "total_sessions")


def _one_row_per_order(orders: DataFrame) -> DataFrame:
    one = F.min(F.struct("order_date", "customer_id")).alias("o")
    return orders.groupBy("order_id").agg(one).select("order_id", "o.customer_id", "o.order_date")


def _metrics(per_order: DataFrame, payments: DataFrame) -> DataFrame:
    paid = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("paid"), F.count(F.lit(1)).alias("n_payments"))
    j = per_order.join(paid, "order_id", "left")
    return j.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.round(F.sum("paid"), 2), F.lit(0.0)).alias("total_spent"),
        F.coalesce(F.sum("n_payments"), F.lit(0)).cast("bigint").alias("total_payments"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def customer_metrics(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Per customer: orders, amount paid, first/last order date.

    Both sides are first reduced to one row per order_id; the join then reuses
    that hash partitioning (no further exchange), and a customer with a third
    of all orders is pre-combined map-side by the final aggregate.
    """
    return _metrics(_one_row_per_order(orders), payments)


def top_customers(orders: DataFrame, payments: DataFrame, n: int = 10) -> DataFrame:
    """``customer_metrics`` of the n customers with most orders (ties broken by
    customer_id).

    Orders are reduced to one row per id once, with the payments of each; the
    n best of the customers' sums are a top-k, not a sort of all.
    """
    return (customer_metrics(orders, payments)
            .orderBy(F.desc("total_orders"), F.asc("customer_id")).limit(n))


def fraud_alert(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("fraud_flag") == 1).select(
        "order_id", "payment_method", "payment_value", "installments", "payment_category",
        "event_timestamp", "event_date")


def delivery_kpi(shipping_kpi: DataFrame) -> DataFrame:
    return shipping_kpi.select("event_date", "shipping_status", "total_shipments",
                               "avg_delivery_days", "avg_shipping_fee")


def to_display(df: DataFrame, tz: str | None = None) -> DataFrame:
    """Timestamp columns as text (optionally shown in another time zone)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            if tz:
                c = F.from_utc_timestamp(c, tz)
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)
