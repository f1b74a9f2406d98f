"""Declarative description of the eight retail entities.

Each entity is described once and every layer (bronze parse, silver typing,
streaming, fixtures) is driven from this table.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    name: str
    topic: str
    # column whose text gives the event time in bronze (see README, "event time")
    event_column: str
    # wire fields, in declared order; all strings on the wire
    fields: tuple[str, ...]
    ints: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    strings: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    dedup_keys: tuple[str, ...] = ()
    # wire fields that were added later: name -> silver type
    extra: dict = field(default_factory=dict)

    def wire_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in (*self.fields, *self.extra)])

    def extended(self, **types: str) -> Entity:
        """The entity with further wire fields, e.g. ``extended(coupon="string")``."""
        return replace(self, extra={**self.extra, **types})


# Topic names, event columns, wire field lists and dedup keys of
# the eight entities (they define the data contract and must not change).
ENTITIES: dict[str, Entity] = {
    "orders": Entity(
        "orders", "orders_topic", "order_date",
        ("order_id", "order_date", "customer_id", "zip", "order_status",
         "payment_method", "device_type", "order_source"),
        ints=("order_id", "customer_id", "zip"), dates=("order_date",),
        not_null=("order_id",), dedup_keys=("order_id", "event_timestamp")),
    "order_items": Entity(
        "order_items", "order_items_topic", "order_id",
        ("order_id", "product_id", "seller_id", "price", "freight_value"),
        ints=("order_id", "product_id", "seller_id"), doubles=("price", "freight_value"),
        not_null=("order_id", "product_id"),
        dedup_keys=("order_id", "product_id", "event_timestamp")),
    "payments": Entity(
        "payments", "payments_topic", "order_id",
        ("order_id", "payment_method", "payment_value", "installments"),
        ints=("order_id", "installments"), doubles=("payment_value",),
        dedup_keys=("order_id", "event_timestamp")),
    "reviews": Entity(
        "reviews", "reviews_topic", "review_date",
        ("review_id", "order_id", "product_id", "customer_id", "review_date",
         "rating", "review_title"),
        ints=("order_id", "product_id", "customer_id", "rating"),
        dates=("review_date",), strings=("review_id",),
        dedup_keys=("review_id", "event_timestamp")),
    "shipments": Entity(
        "shipments", "shipments_topic", "ship_date",
        ("order_id", "ship_date", "delivery_date", "shipping_fee"),
        ints=("order_id",), doubles=("shipping_fee",),
        dates=("ship_date", "delivery_date"),
        dedup_keys=("order_id", "event_timestamp")),
    "returns": Entity(
        "returns", "returns_topic", "return_date",
        ("return_id", "order_id", "product_id", "return_reason", "return_date"),
        ints=("order_id", "product_id"), dates=("return_date",), strings=("return_id",),
        dedup_keys=("return_id", "event_timestamp")),
    "inventory": Entity(
        "inventory", "inventory_topic", "snapshot_date",
        ("snapshot_date", "product_id", "stock_on_hand", "units_received", "units_sold"),
        ints=("product_id", "stock_on_hand", "units_received", "units_sold"),
        dates=("snapshot_date",),
        dedup_keys=("product_id", "event_timestamp")),
    "traffic": Entity(
        "traffic", "traffic_topic", "date",
        ("date", "sessions", "unique_visitors", "page_views", "traffic_source"),
        ints=("sessions", "unique_visitors", "page_views"), dates=("date",),
        dedup_keys=("date", "traffic_source", "event_timestamp")),
}

# Identifier columns.  The wire contract says "int"; ids are widened to 64 bit
# so that order/customer keys beyond 2^31 (reached long before 100 TB) are not
# turned into NULL and silently filtered out.
ID_COLUMNS = frozenset({"order_id", "customer_id", "product_id", "seller_id"})

# Scoring topic of the recommender (user_id, product_id); widened to 64 bit
# like every other id.
USER_EVENTS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
])

# Kafka-shaped envelope used by the file fallback source.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
