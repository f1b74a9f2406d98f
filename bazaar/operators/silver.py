"""Silver layer: typing, filtering, de-duplication and classification.

One function per entity; every one is ``DataFrame -> DataFrame`` and works on
a batch or a streaming frame.  Input may be the all-string bronze payload or
an already typed frame (columns are converted by their current type).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import classify, event_time, lenient_date, lenient_double, lenient_int
from bazaar.functions.rounding import ratio2
from bazaar.operators.dedup import dedup
from bazaar.specs import ENTITIES, ID_COLUMNS, Entity

# Classification thresholds and labels of the silver layer.
HIGH_VALUE_PAYMENT = 500
FRAUD_PAYMENT = 2000
POSITIVE_RATING = 4
NEUTRAL_RATING = 3
FAST_DAYS = 2
NORMAL_DAYS = 5
STOCKOUT_LEVEL = 0
LOW_STOCK_LEVEL = 20
OVERSTOCK_LEVEL = 500
HIGH_TRAFFIC_SESSIONS = 1000

# Bronze columns that silver rows keep.
LINEAGE = ("raw_json", "topic", "partition", "offset", "kafka_timestamp", "bronze_ingest_time",
           "bronze_layer", "data_source")


def typed(df: DataFrame, ent: Entity, id_type: str = "bigint") -> DataFrame:
    """Convert wire/typed columns to silver types in one projection."""
    dt = {f.name: f.dataType for f in df.schema.fields}
    out: list[Column] = []
    for f in ent.fields:
        if f not in dt:  # field absent from this input: a NULL of the silver type
            kind = ((id_type if f in ID_COLUMNS else "int") if f in ent.ints else
                    "double" if f in ent.doubles else "date" if f in ent.dates else "string")
            out.append(F.lit(None).cast(kind).alias(f))
            continue
        if f in ent.ints:
            target = id_type if f in ID_COLUMNS else "int"
            out.append(lenient_int(f, dt[f], target).alias(f))
        elif f in ent.doubles:
            out.append(lenient_double(f, dt[f]).alias(f))
        elif f in ent.dates:
            out.append(lenient_date(f, dt[f]).alias(f))
        else:
            out.append(F.col(f).cast("string").alias(f))
    # fields that were added to the wire later are typed in the plain way
    out += [F.trim(F.col(f).cast("string")).try_cast(kind).alias(f) for f, kind in ent.extra.items() if f in dt]
    if "event_timestamp" in dt:
        ts = event_time("event_timestamp", dt["event_timestamp"])
    elif ent.event_column in dt and ent.event_column not in ID_COLUMNS:
        # wire rows without bronze lineage (e.g. a CSV export): the event time
        # comes from the entity's declared event column
        ts = event_time(ent.event_column, dt[ent.event_column])
    else:
        ts = F.lit(None).cast("timestamp")
    ts = ts.alias("event_timestamp")
    lineage = [c for c in LINEAGE if c in dt]
    base = df.select(*out, ts, *lineage)
    return base.withColumn("event_date", F.to_date("event_timestamp"))


def _survivors(df: DataFrame, keys, watermark, keep) -> DataFrame:
    """One row per key.  event_date follows from event_timestamp, so a batch
    puts it back instead of carrying it through."""
    if df.isStreaming:
        return dedup(df, keys, watermark)
    if keep is not None:
        keep = {*keep, "event_timestamp"}
    out = dedup(df.drop("event_date"), keys, keep=keep)
    return out.withColumn("event_date", F.to_date("event_timestamp"))


def _derive(df: DataFrame, needs, **made: Column) -> DataFrame:
    """Add columns, if those that they need are there."""
    return df.select("*", *[c.alias(n) for n, c in made.items()]) if set(needs) <= set(df.columns) else df


def _finish(df: DataFrame, clock: bool) -> DataFrame:
    df = df.withColumn("silver_layer", F.lit("silver"))
    if clock:
        df = df.withColumn("processing_time", F.current_timestamp())
    return df


# ``keep``: the wire fields besides the keys that the reader uses.  A batch then
# drops those that its survivors don't depend on, and what is derived from them.

def silver_orders(df, *, watermark=None, clock=False, id_type="bigint", ent=None, keep=None) -> DataFrame:
    e = ent or ENTITIES["orders"]
    s = typed(df, e, id_type).where(F.col("order_id").isNotNull())
    return _finish(_survivors(s, e.dedup_keys, watermark, keep), clock)


def silver_order_items(df, *, watermark=None, clock=False, id_type="bigint", ent=None, keep=None) -> DataFrame:
    e = ent or ENTITIES["order_items"]
    s = typed(df, e, id_type).where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
    s = _survivors(s, e.dedup_keys, watermark, keep)
    s = _derive(s, ("price", "freight_value"), item_total=F.col("price") + F.col("freight_value"))
    return _finish(s, clock)


def silver_payments(df, *, watermark=None, clock=False, id_type="bigint", ent=None,
                    dedup_keys=None, keep=None) -> DataFrame:
    e = ent or ENTITIES["payments"]
    s = typed(df, e, id_type).where(F.col("payment_value") > 0)
    s = _survivors(s, dedup_keys or e.dedup_keys, watermark, keep)
    v = F.col("payment_value")
    s = _derive(s, ("payment_value",),
                payment_category=classify([(v >= HIGH_VALUE_PAYMENT, "HIGH_VALUE")], "NORMAL"),
                fraud_flag=classify([(v >= FRAUD_PAYMENT, 1)], 0))
    return _finish(s, clock)


def silver_reviews(df, *, watermark=None, clock=False, id_type="bigint", ent=None, keep=None) -> DataFrame:
    e = ent or ENTITIES["reviews"]
    s = typed(df, e, id_type).where(F.col("rating").between(1, 5))
    s = _survivors(s, e.dedup_keys, watermark, keep)
    r = F.col("rating")
    s = _derive(s, ("rating",), review_sentiment=classify(
        [(r >= POSITIVE_RATING, "POSITIVE"), (r == NEUTRAL_RATING, "NEUTRAL")], "NEGATIVE"))
    return _finish(s, clock)


def silver_shipments(df, *, watermark=None, clock=False, id_type="bigint", ent=None, keep=None) -> DataFrame:
    e = ent or ENTITIES["shipments"]
    s = _survivors(typed(df, e, id_type), e.dedup_keys, watermark, keep)
    s = _derive(s, ("delivery_date", "ship_date"), delivery_days=F.datediff("delivery_date", "ship_date"))
    d = F.col("delivery_days")
    s = _derive(s, ("delivery_days",), shipping_status=classify(
        [(d <= FAST_DAYS, "FAST"), (d <= NORMAL_DAYS, "NORMAL")], "DELAYED"))
    return _finish(s, clock)


def silver_returns(df, *, watermark=None, clock=False, id_type="bigint", ent=None, keep=None) -> DataFrame:
    e = ent or ENTITIES["returns"]
    s = _survivors(typed(df, e, id_type), e.dedup_keys, watermark, keep)
    return _finish(s.withColumn("return_flag", F.lit(1)), clock)


def silver_inventory(df, *, watermark=None, clock=False, id_type="bigint", ent=None, keep=None) -> DataFrame:
    e = ent or ENTITIES["inventory"]
    s = _survivors(typed(df, e, id_type), e.dedup_keys, watermark, keep)
    st = F.col("stock_on_hand")
    s = _derive(s, ("stock_on_hand",), inventory_status=classify(
        [(st <= STOCKOUT_LEVEL, "STOCKOUT"), (st <= LOW_STOCK_LEVEL, "LOW_STOCK"),
         (st >= OVERSTOCK_LEVEL, "OVERSTOCK")], "NORMAL"))
    return _finish(s, clock)


def silver_traffic(df, *, watermark=None, clock=False, id_type="bigint", ent=None, keep=None) -> DataFrame:
    e = ent or ENTITIES["traffic"]
    s = _survivors(typed(df, e, id_type), e.dedup_keys, watermark, keep)
    s = _derive(s, ("page_views", "sessions"),
                pages_per_session=ratio2("page_views", "sessions"),
                traffic_quality=classify([(F.col("sessions") >= HIGH_TRAFFIC_SESSIONS, "HIGH")], "NORMAL"))
    return _finish(s, clock)


SILVER = {
    "orders": silver_orders, "order_items": silver_order_items, "payments": silver_payments,
    "reviews": silver_reviews, "shipments": silver_shipments, "returns": silver_returns,
    "inventory": silver_inventory, "traffic": silver_traffic,
}


def silver(name: str, df: DataFrame, **kw) -> DataFrame:
    return SILVER[name](df, **kw)
