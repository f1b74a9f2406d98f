"""Order journey and replay log, as DataFrame jobs.

The journey is a ``unionByName`` of one projection per silver table: no
join, no per-order grouping, so an order with millions of events is just
more rows spread over many tasks.  Ordering is expressed by columns
(``order_id``, ``event_sequence``, ``event_time``); readers sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Journey steps (event type, sequence number) in journey order,
# and the tags of the day-level events.
STEPS = (
    ("orders", "ORDER_CREATED", 1),
    ("order_items", "ITEM_ADDED", 2),
    ("payments", "PAYMENT_COMPLETED", 3),
    ("shipments", "SHIPMENT_CREATED", 4),
    ("reviews", "REVIEW_SUBMITTED", 5),
    ("returns", "RETURN_REQUESTED", 6),
)
DAY_EVENTS = (("inventory", "INVENTORY_UPDATED", 100), ("traffic", "WEB_TRAFFIC", 200))

# Multiplicative hash for the seeded replay order (prime
# modulus below 2^31, multiplier the 32-bit golden-ratio constant reduced
# below it); (id mod p) * a + seed stays below 2^63 for any 64-bit id.
REPLAY_PRIME = 2147483647
REPLAY_MULT = 1640531527

# per source: (reference id column or None, amount column or None)
_REF = {
    "orders": (None, None),
    "order_items": ("product_id", "item_total"),
    "payments": ("payment_method", "payment_value"),
    "shipments": (None, "shipping_fee"),
    "reviews": ("review_id", None),
    "returns": ("return_id", None),
    "inventory": ("product_id", None),
    "traffic": ("traffic_source", None),
}

# wire fields besides the keys that a journey without payload is built from
USES = {
    "orders": (),
    "order_items": ("price", "freight_value"),
    "payments": ("payment_method", "payment_value"),
    "shipments": ("shipping_fee",),
    "reviews": ("order_id",),
    "returns": ("order_id",),
    "inventory": (),
    "traffic": (),
}


def _step(df: DataFrame, source: str, event_type: str, seq: int, with_payload: bool) -> DataFrame:
    ref, amount = _REF[source]
    cols = [
        (F.col("order_id") if "order_id" in df.columns else F.lit(None).cast("bigint")).alias("order_id"),
        F.lit(seq).alias("event_sequence"),
        F.lit(event_type).alias("event_type"),
        F.col("event_timestamp").alias("event_time"),
        F.col("event_date"),
        (F.col(ref).cast("string") if ref else F.lit(None).cast("string")).alias("ref_id"),
        (F.col(amount).cast("double") if amount else F.lit(None).cast("double")).alias("amount"),
    ]
    if with_payload:
        body = [c for c in df.columns if c not in ("silver_layer", "processing_time")]
        cols.append(F.to_json(F.struct(*body)).alias("payload"))
    return df.select(*cols)


def order_journey(silver: dict[str, DataFrame], with_payload: bool = False) -> DataFrame:
    parts = [_step(silver[src], src, et, seq, with_payload) for src, et, seq in STEPS if src in silver]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def journey_funnel(journey: DataFrame) -> DataFrame:
    """Orders reaching each step and events per step."""
    return journey.groupBy("event_sequence", "event_type").agg(
        F.count_distinct("order_id").alias("orders_reached"),
        F.count(F.lit(1)).alias("events"))


def event_log(journey: DataFrame, silver: dict[str, DataFrame], with_payload: bool = False) -> DataFrame:
    """Journey events plus day-level inventory and traffic events."""
    out = journey
    for src, et, seq in DAY_EVENTS:
        if src in silver:
            out = out.unionByName(_step(silver[src], src, et, seq, with_payload))
    return out


def daily_event_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("event_date", "event_type", "event_sequence").agg(
        F.count(F.lit(1)).alias("events"))


def replay_days(journey: DataFrame) -> DataFrame:
    """The day on which each order is replayed: that of its creation."""
    start = journey.where(F.col("event_sequence") == 1).select(
        "order_id", F.col("event_date").alias("replay_day"))
    return start.groupBy("order_id").agg(F.min("replay_day").alias("replay_day"))


def on_replay_days(journey: DataFrame, days: DataFrame) -> DataFrame:
    """The events of orders that have a day, with it."""
    return journey.join(days, "order_id", "inner")


def in_replay_order(events: DataFrame, seed: int = 42) -> DataFrame:
    """Events with their ``replay_day``, sorted, with the ``replay_key``."""
    key = F.pmod(F.pmod(F.col("order_id"), F.lit(REPLAY_PRIME)) * REPLAY_MULT + seed, F.lit(REPLAY_PRIME))
    # the key follows from the order id: it is sorted by, but made after the shuffle
    j = events.orderBy("replay_day", key, "order_id", "event_sequence", "event_time", "ref_id", "amount")
    return j.withColumn("replay_key", key)


def replay_log(journey: DataFrame, seed: int = 42) -> DataFrame:
    """Replay order: order days ascending, orders in a seeded pseudo-random
    order within the day, each order's events in journey order.

    The result is a global sort (range partitioned on the sort key), so a day
    holding a third of all orders is split over many tasks.
    """
    return in_replay_order(on_replay_days(journey, replay_days(journey)), seed)
