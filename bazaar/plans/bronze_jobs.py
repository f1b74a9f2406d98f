"""Batch bronze plans over the driver tables (publish -> parse -> silver)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import lenient_int
from bazaar.functions.rounding import round2_avg
from bazaar.operators import bronze as B
from bazaar.operators import publish
from bazaar.operators.dating import date_by_order
from bazaar.operators.silver import LINEAGE, silver
from bazaar.sources import testdata
from bazaar.specs import ENTITIES


#: Lineage that neither places a record in the log nor dates it.  Silver's
#: survivors are compared by all their columns, so what a plan leaves out of its
#: result is better dropped before.
UNPLACED = tuple(c for c in LINEAGE if c not in ("partition", "offset", "kafka_timestamp"))


def roundtrip_silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Typed entity -> JSON envelope -> bronze parse -> silver.

    Must equal the silver table built directly from the typed rows; topic
    positions are left out, so that the survivor is chosen as there.
    """
    env = B.to_wire(testdata.entity(spark, sf_dir, name), name)
    return silver(name, B.parse_envelope(env, name).drop("partition", "offset")).drop(*LINEAGE)


def events_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a topic: props JSON parsed to a typed field."""
    ev = testdata.table(spark, sf_dir, "events")
    env = ev.select(F.col("props").cast("binary").alias("value"), F.lit("events").alias("topic"),
                    F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                    F.col("ts").cast("timestamp").alias("timestamp"))
    raw = env.select(F.col("value").cast("string").alias("raw_json"), "offset",
                     F.col("timestamp").alias("kafka_timestamp"))
    p = raw.select("*", F.from_json("raw_json", "k STRING").alias("data"))
    return p.select(F.col("offset").alias("event_id"), "kafka_timestamp", "raw_json",
                    F.col("data.k").alias("k"),
                    lenient_int("data.k", T.StringType()).alias("k_int"))


def subsecond_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments stamped with the events' microseconds, through the wire and back."""
    ev = testdata.table(spark, sf_dir, "events")
    pay = ev.select(F.col("event_id").alias("order_id"), F.col("event_type").alias("payment_method"),
                    F.col("value").alias("payment_value"), F.lit(1).alias("installments"),
                    F.col("ts").cast("timestamp").alias("event_timestamp"))
    two = pay.unionByName(pay.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL '0.1' SECOND")))
    return silver("payments", B.parse_envelope(B.to_wire(two, "payments"), "payments")).drop(*LINEAGE)


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a producer sends them, with the send clock as ``event_time``:
    the order's own date must give the event time."""
    sent = publish.enrich(publish.json_safe(testdata.entity(spark, sf_dir, "orders").drop("event_timestamp")),
                          "ORDER_CREATED", 1)
    env = publish.to_json_value(sent).select(
        F.col("value").cast("binary").alias("value"), F.lit("orders_topic").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"))
    return B.parse_envelope(env, "orders").select("order_id", "event_timestamp", "event_date", "data_source")


def csv_like_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items as an export has them: text, and no time column.  The order
    id must not be read as a year."""
    items = testdata.entity(spark, sf_dir, "order_items").drop("event_timestamp")
    out = silver("order_items", items.select(*[F.col(c).cast("string").alias(c) for c in items.columns]))
    return out.select("order_id", "product_id", "seller_id", "price", "freight_value",
                      F.col("event_timestamp").isNull().alias("no_event_time"))


def fine_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean price per product over prices with many decimals, some of them
    NaN, infinite or huge."""
    li = testdata.table(spark, sf_dir, "lineitem")

    def at(line: int, every: int):
        return (F.col("l_linenumber") == line) & (F.col("l_orderkey") % every == 0)

    price = (F.when(at(6, 97), F.lit(float("nan"))).when(at(5, 89), F.lit(float("inf"))).when(at(4, 83), F.lit(4e18))
             .otherwise(F.col("l_extendedprice") / 1024 + F.lit(1e-12)))
    return (li.select(F.col("l_partkey").alias("product_id"), price.alias("price")).groupBy("product_id")
            .agg(round2_avg("price").alias("avg_price")))


# ------------------------------------------- records as a producer sends them

#: Orders whose id this divides are not on the topic in the fixture of undated records.
MISSING_ORDERS = 50


def reference_envelope(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Orders, order items or payments with the producer's fields only: the
    sender's clock as ``event_time`` and no business time.

    The log's position and clock come from the order id; every third order
    comes after its items and payments.
    """
    if name == "order_items":
        li = testdata.table(spark, sf_dir, "lineitem")
        rows = li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                         F.col("l_suppkey").alias("seller_id"), F.col("l_extendedprice").alias("price"),
                         F.col("l_quantity").cast("double").alias("freight_value"),
                         (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_place"))
    else:
        rows = testdata.entity(spark, sf_dir, name).drop("event_timestamp").withColumn("_place", F.col("order_id"))
    k = F.col("order_id")
    if name == "orders":
        rows, after = rows.where(k % MISSING_ORDERS != 0), F.lit(0)
    else:
        after = F.when(k % 3 == 0, F.lit(-600)).otherwise(F.lit(600))
    clock = F.timestamp_seconds(F.lit(1893456000) + k % 3600 + after)  # 2030-01-01
    sent = publish.enrich(publish.json_safe(rows.drop("_place")), name.upper(), 1)
    value = F.to_json(F.struct(*sent.columns), {"ignoreNullFields": "false"})
    full = publish.enrich(publish.json_safe(rows), name.upper(), 1)
    return full.select(value.cast("binary").alias("value"), F.lit(ENTITIES[name].topic).alias("topic"),
                       F.pmod(k, F.lit(8)).cast("int").alias("partition"), F.col("_place").cast("long").alias("offset"),
                       clock.alias("timestamp"))


def dated_silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Silver of undated records, dated by a join with their orders."""
    rows, orders = (B.parse_envelope(reference_envelope(spark, sf_dir, n), n) for n in (name, "orders"))
    return silver(name, date_by_order(rows, orders).drop(*UNPLACED, "kafka_timestamp")).drop(*LINEAGE)


def placed_envelope(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Shipments with a log position that any engine can repeat."""
    li = testdata.table(spark, sf_dir, "lineitem")
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    rows = testdata.shipment_rows(li, [(key * 8 + line).alias("_place")])
    env = B.to_wire(rows, name, offset_col="_place")
    return env.withColumn("partition", F.pmod(F.floor(F.col("offset") / 8), F.lit(8)).cast("int"))


def broken_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_items published with every 13th record truncated and every 17th
    record carrying only an unknown key."""
    li = testdata.table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    good = F.to_json(F.struct(k.cast("string").alias("order_id"),
                              F.col("l_partkey").cast("string").alias("product_id")))
    value = (F.when(k % 13 == 0, F.concat(F.lit('{"order_id": '), k.cast("string"), F.lit(', "price": ')))
             .when(k % 17 == 0, F.lit('{"unknown": 1}'))
             .otherwise(good))
    return li.select(value.cast("binary").alias("value"), F.lit("order_items_topic").alias("topic"),
                     F.lit(0).alias("partition"),
                     (k * 8 + F.col("l_linenumber")).cast("long").alias("offset"),
                     F.col("l_shipdate").cast("timestamp").alias("timestamp"))


def rejects_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects are exactly the broken records."""
    bad = B.rejects(B.parse_envelope(broken_envelope(spark, sf_dir), "order_items"), "order_items")
    return bad.select("offset", "raw_json", "topic")
