"""Event dates of order items and payments, which carry none of their own.

Both are dated by their order: a left outer join on ``order_id``.  Rows that
have a time already, or no order id to look up, pass by the stream's join and
are spread over the batch's, so they can't pile up on one key.  The date of an order is that of its first record in the
log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions import lenient_int

#: Bronze column with the time at which the log took a record; the streams' clock.
CLOCK = "kafka_timestamp"


def _key(df: DataFrame) -> DataFrame:
    return df.withColumn("_key", lenient_int("order_id", df.schema["order_id"].dataType, "bigint"))


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to look up, the others), both with ``_key``."""
    keyed = _key(rows)
    wanted = F.col("event_timestamp").isNull() & F.col("_key").isNotNull()
    return keyed.where(wanted), keyed.where(~wanted)


def _dated(joined: DataFrame, others: DataFrame, columns: list[str]) -> DataFrame:
    found = joined.withColumn("event_timestamp", F.col("_order_time"))
    both = found.select(*columns).unionByName(others.select(*columns))
    return both.withColumn("event_date", F.to_date("event_timestamp"))


def date_by_order(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Batch: rows of bronze order items or payments with their order's time.

    ``orders`` is bronze (or silver) orders.  Rows without a known order keep
    NULL.
    """
    log = [c for c in ("partition", "offset") if c in orders.columns]
    place = F.struct(*log, "event_timestamp")
    known = _key(orders).where(F.col("_key").isNotNull() & F.col("event_timestamp").isNotNull())
    times = known.groupBy(F.col("_key")).agg(F.min_by("event_timestamp", place).alias("_order_time"))
    # one pass over the rows, which may be costly to parse; 0 for every order,
    # in a form that the optimizer leaves in the join's keys
    times = times.withColumn("_spread", F.pmod("_key", F.lit(1).cast("bigint")))
    place = [c for c in ("partition", "offset") if c in rows.columns] or rows.columns
    wanted = F.col("event_timestamp").isNull() & F.col("_key").isNotNull()
    keyed = _key(rows).withColumn("_wanted", wanted)
    keyed = keyed.withColumn("_key", F.when(F.col("_wanted"), F.col("_key"))).withColumn(
        "_spread", F.when(F.col("_wanted"), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*place)))
    found = keyed.join(times, ["_key", "_spread"], "left").withColumn(
        "event_timestamp", F.when(F.col("_wanted"), F.col("_order_time")).otherwise(F.col("event_timestamp")))
    return found.select(*rows.columns).withColumn("event_date", F.to_date("event_timestamp"))


def date_by_order_stream(rows: DataFrame, orders: DataFrame, wait: str = "1 hour", clock: str = CLOCK) -> DataFrame:
    """Stream: the same as a stream-stream left outer join.

    An order is looked for among those that the log took up to ``wait`` before
    or after the row.  Both sides have a watermark of ``wait`` on the log's
    clock, so state is dropped once no partner can come, and a row without an
    order comes out then, with NULL.  Of the copies of an order within ``wait``
    the first to arrive counts; if copies with different dates arrive in one
    micro-batch, either may.
    """
    o = _key(orders).select(F.col("_key").alias("_order"), F.col("event_timestamp").alias("_order_time"),
                            F.col(clock).alias("_order_clock"))
    o = (o.where(F.col("_order").isNotNull() & F.col("_order_time").isNotNull())
         .withWatermark("_order_clock", wait).dropDuplicatesWithinWatermark(["_order"]))
    wanted, others = _split(rows)
    near = F.expr(f"_order_clock BETWEEN {clock} - INTERVAL {wait} AND {clock} + INTERVAL {wait}")
    joined = wanted.withWatermark(clock, wait).join(o, (F.col("_key") == F.col("_order")) & near, "leftOuter")
    return _dated(joined, others, rows.columns)
