"""Adapters from the driver's TPC-H-like tables to the eight retail entities.

Each adapter is a plain projection (plus one join for reviews and one
aggregate for traffic) so Catalyst prunes the parquet scan to the columns it
needs.  Columns are typed (ids bigint, dates date, money double) and carry an
``event_timestamp``; the silver operators accept this typed form as well as the
all-string wire form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(c: str):
    return F.col(c).cast("date")


def orders(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("order_id"),
        _day("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_custkey") % 100000).alias("zip"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(k % 3 == 0, "mobile").when(k % 3 == 1, "desktop").otherwise("tablet")
        .alias("device_type"),
        F.when(k % 2 == 0, "organic").otherwise("paid").alias("order_source"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
    )


def order_items(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
        F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
    )


def payments(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint") % 300000
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_method"),
        (cents.cast("double") / 100).alias("payment_value"),
        (F.col("o_orderkey") % 12 + 1).cast("int").alias("installments"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
    )


def _line_id():
    return F.concat_ws("-", F.col("l_orderkey").cast("string"),
                       F.col("l_partkey").cast("string"),
                       F.col("l_linenumber").cast("string"))


def reviews(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "A")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # orders is the larger side only at tiny scale; both sides shuffle on the
    # order key (or AQE broadcasts a side that turns out small at run time).
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        _line_id().alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        _day("l_shipdate").alias("review_date"),
        (F.col("l_quantity").cast("int") % 7).alias("rating"),
        F.col("l_returnflag").alias("review_title"),
        F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
    )


def shipments(spark, sf_dir) -> DataFrame:
    return shipment_rows(table(spark, sf_dir, "lineitem"))


def shipment_rows(li: DataFrame, more=()) -> DataFrame:
    """Shipments of order lines, with further columns."""
    ship = _day("l_shipdate")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        ship.alias("ship_date"),
        F.when(F.col("l_quantity") == 1, F.lit(None).cast("date"))
        .otherwise(F.date_add(ship, (F.col("l_linenumber") - 2).cast("int")))
        .alias("delivery_date"),
        (F.col("l_quantity") / 2).alias("shipping_fee"),
        F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
        *more,
    )


def returns(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return li.select(
        _line_id().alias("return_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linestatus").alias("return_reason"),
        F.date_add(_day("l_shipdate"), 10).alias("return_date"),
        F.date_add(_day("l_shipdate"), 10).cast("timestamp").alias("event_timestamp"),
    )


def inventory(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    snap = F.date_add(F.lit("2001-01-01").cast("date"), (F.col("p_partkey") % 28).cast("int"))
    return p.select(
        snap.alias("snapshot_date"),
        F.col("p_partkey").alias("product_id"),
        (F.col("p_size") * 12 - 40).alias("stock_on_hand"),
        F.col("p_size").alias("units_received"),
        (F.col("p_partkey") % 50).cast("int").alias("units_sold"),
        snap.cast("timestamp").alias("event_timestamp"),
    )


def traffic(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    g = ev.groupBy(day.alias("date"), F.col("event_type").alias("traffic_source")).agg(
        (F.count(F.lit(1)) * 15).cast("int").alias("sessions"),
        F.count_distinct("user_id").cast("int").alias("unique_visitors"),
        (F.count(F.lit(1)) * 45 + F.sum(F.floor("value").cast("int")) % 97)
        .cast("int").alias("page_views"),
    )
    return g.select("date", "sessions", "unique_visitors", "page_views", "traffic_source",
                    F.col("date").cast("timestamp").alias("event_timestamp"))


ADAPTERS = {
    "orders": orders, "order_items": order_items, "payments": payments,
    "reviews": reviews, "shipments": shipments, "returns": returns,
    "inventory": inventory, "traffic": traffic,
}


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ADAPTERS[name](spark, sf_dir)


# --- the same adapters as SQL text (DuckDB oracle sub-queries) -------------
ENTITY_SQL = {
    "orders": """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
 o_custkey AS customer_id, o_custkey % 100000 AS zip, o_orderstatus AS order_status,
 o_orderpriority AS payment_method,
 CASE o_orderkey % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
 CASE o_orderkey % 2 WHEN 0 THEN 'organic' ELSE 'paid' END AS order_source,
 CAST(o_orderdate AS TIMESTAMP) AS event_timestamp FROM orders""",
    "order_items": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
 l_suppkey AS seller_id, l_extendedprice AS price, l_quantity AS freight_value,
 CAST(l_shipdate AS TIMESTAMP) AS event_timestamp FROM lineitem""",
    "payments": """SELECT o_orderkey AS order_id, o_orderpriority AS payment_method,
 CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 300000 AS DOUBLE) / 100 AS payment_value,
 CAST(o_orderkey % 12 + 1 AS INT) AS installments,
 CAST(o_orderdate AS TIMESTAMP) AS event_timestamp FROM orders""",
    "reviews": """SELECT concat(l_orderkey, '-', l_partkey, '-', l_linenumber) AS review_id,
 l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id,
 CAST(l_shipdate AS DATE) AS review_date, CAST(l_quantity AS INT) % 7 AS rating,
 l_returnflag AS review_title, CAST(l_shipdate AS TIMESTAMP) AS event_timestamp
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'""",
    "shipments": """SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS ship_date,
 CASE WHEN l_quantity = 1 THEN NULL
      ELSE CAST(l_shipdate AS DATE) + CAST(l_linenumber - 2 AS INT) END AS delivery_date,
 l_quantity / 2 AS shipping_fee, CAST(l_shipdate AS TIMESTAMP) AS event_timestamp FROM lineitem""",
    "returns": """SELECT concat(l_orderkey, '-', l_partkey, '-', l_linenumber) AS return_id,
 l_orderkey AS order_id, l_partkey AS product_id, l_linestatus AS return_reason,
 CAST(l_shipdate AS DATE) + 10 AS return_date,
 CAST(CAST(l_shipdate AS DATE) + 10 AS TIMESTAMP) AS event_timestamp
 FROM lineitem WHERE l_returnflag = 'R'""",
    "inventory": """SELECT DATE '2001-01-01' + CAST(p_partkey % 28 AS INT) AS snapshot_date,
 p_partkey AS product_id, p_size * 12 - 40 AS stock_on_hand, p_size AS units_received,
 CAST(p_partkey % 50 AS INT) AS units_sold,
 CAST(DATE '2001-01-01' + CAST(p_partkey % 28 AS INT) AS TIMESTAMP) AS event_timestamp FROM part""",
    "traffic": """SELECT CAST(ts AS DATE) AS date, CAST(count(*) * 15 AS INT) AS sessions,
 CAST(count(DISTINCT user_id) AS INT) AS unique_visitors,
 CAST(count(*) * 45 + sum(CAST(floor(value) AS INT)) % 97 AS INT) AS page_views,
 event_type AS traffic_source, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS event_timestamp
 FROM events GROUP BY CAST(ts AS DATE), event_type""",
}
