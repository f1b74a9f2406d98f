"""Silver and gold tables that a stream brings up to date, key by key.

Survivors: a micro-batch adds a row if its key is new, or if it comes earlier
in the log than the key's row so far.  Nothing is rewritten: a reader takes the
first of the log for each key, which is the row that the batch job keeps,
whatever the order of arrival.  There is no state; a batch reads the keys of
the partitions that it touches.

Updates: an aggregation with a watermark emits the groups that a batch has
changed; its state for a day goes when the watermark has passed.  Each batch
is a version of its own, replaced as a whole by a replay, and a reader takes
the last version of each key.  Every so often a version holds all keys, so a
reader needs only the versions since.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaar.operators import gold as G
from bazaar.operators.dedup import dedup_batch
from bazaar.operators.silver import silver
from bazaar.session import spread_by_date
from bazaar.specs import ENTITIES
from bazaar.streaming import sinks
from bazaar.streaming.sources import read_layer

_PLACE = ("partition", "offset")


def touched(batch: DataFrame, column: str = "event_date") -> Column | None:
    """Filter on the distinct days of a batch (as many as the calendar has), NULL included.

    Days that follow one another are one range, so a backfill's filter is short.
    """
    days = [r[0] for r in batch.select(column).distinct().collect()]
    some = sorted(d for d in days if d is not None)
    runs: list[list] = []
    for d in some:
        if runs and (d - runs[-1][1]).days == 1:
            runs[-1][1] = d
        else:
            runs.append([d, d])
    single = [lo for lo, hi in runs if lo == hi]
    parts = [F.col(column).isin(single)] if single else []
    parts += [F.col(column).between(F.lit(lo), F.lit(hi)) for lo, hi in runs if lo != hi]
    if len(some) < len(days):
        parts.append(F.col(column).isNull())
    return reduce(lambda x, y: x | y, parts) if parts else None


# ---------------------------------------------------------------- survivors

def new_survivors(batch: DataFrame, stored: DataFrame, keys) -> DataFrame:
    """Rows of a de-duplicated ``batch`` that come before the stored row of their key."""
    have = (stored.groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
            .agg(F.min(F.struct(*_PLACE)).alias("_have")))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    earlier = F.col("_have").isNull() | (F.struct(*_PLACE) < F.col("_have"))
    return batch.join(have, same, "left").where(earlier).select(*batch.columns)


def survivors_job(rows: DataFrame, entity: str, out: str, ckpt: str, trigger=None,
                  partition_by: tuple[str, ...] = ("event_date",), schema: StructType | None = None):
    """Stream of bronze rows (with topic partition and offset) to a silver table.

    Read it with ``read_survivors``.  A replay finds its rows there already and
    adds nothing.
    """
    spark = rows.sparkSession
    keys = ENTITIES[entity].dedup_keys
    kind = schema or silver(entity, spark.createDataFrame([], rows.schema), clock=True).schema

    def add(batch: DataFrame, batch_id: int) -> None:
        fresh = silver(entity, batch, clock=True).persist()
        try:
            days = touched(fresh)
            if days is not None:
                stored = read_layer(spark, out, kind, missing_ok=True).where(days)
                new = new_survivors(fresh, stored, keys)
                if partition_by:
                    new = spread_by_date(new, partition_by)
                new.write.mode("append").partitionBy(*partition_by).parquet(out)
        finally:
            fresh.unpersist()

    w = rows.writeStream.option("checkpointLocation", ckpt).foreachBatch(add).queryName(f"survivors_{entity}")
    return sinks.apply_trigger(w, trigger).start()


def survivors(stored: DataFrame, entity: str) -> DataFrame:
    """One row per key of a table of ``survivors_job``: the first of the log."""
    return dedup_batch(stored, ENTITIES[entity].dedup_keys)


def read_survivors(spark: SparkSession, entity: str, path: str, schema: StructType | None = None) -> DataFrame:
    return survivors(read_layer(spark, path, schema), entity)


# ------------------------------------------------------------------ updates

def daily_groups(table: str, rows: DataFrame, delay: str) -> DataFrame:
    """A gold table over a stream, in groups whose state the watermark ends.

    The day is a one-day window on the event time.  Distinct counts are
    approximate.  Rows without a time have no window; ``late_rows_job`` sets
    them aside, and those behind the watermark.
    """
    timed = rows.withWatermark("event_timestamp", delay)
    day = timed.withColumn("event_date", F.window("event_timestamp", "1 day"))
    return G.build(table, day, distinct="approx").withColumn("event_date", F.to_date("event_date.start"))


# Group columns of the gold tables.
_GROUPS = {
    "daily_sales": ("event_date",), "top_products": ("event_date", "product_id"),
    "seller_performance": ("event_date", "seller_id"), "payment_analytics": ("event_date", "payment_method"),
    "review_analytics": ("event_date", "review_sentiment"), "shipping_kpi": ("event_date", "shipping_status"),
    "inventory_kpi": ("event_date", "inventory_status"), "traffic_kpi": ("event_date", "traffic_source"),
    "returns_kpi": ("event_date",),
}


def update_job(rows: DataFrame, table: str, out: str, ckpt: str, delay: str, trigger=None, whole_every: int = 100):
    """Bounded stateful gold: ``update`` mode, merged by key into ``out``.

    Batch n writes ``whole=false/version=n``, or, every ``whole_every``
    batches, all keys as ``whole=true/version=n``.  Read with ``read_updates``.
    """
    spark = rows.sparkSession
    keys = list(_GROUPS[table])

    def merge(batch: DataFrame, batch_id: int) -> None:
        whole = batch_id > 0 and batch_id % whole_every == 0
        if whole:
            before = versions(spark, out, batch.schema).where(F.col("version") < batch_id)
            batch = _last(before.unionByName(batch.withColumn("version", F.lit(batch_id).cast("long"))), keys)
        (batch.sortWithinPartitions("event_date").write.mode("overwrite")
         .parquet(f"{out}/whole={str(whole).lower()}/version={batch_id}"))

    w = (daily_groups(table, rows, delay).writeStream.outputMode("update").option("checkpointLocation", ckpt)
         .foreachBatch(merge).queryName(f"update_{table}"))
    return sinks.apply_trigger(w, trigger).start()


def versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows since the last whole version, with ``version``."""
    kind = StructType(list(schema.fields)).add("whole", "boolean").add("version", "long")
    every = read_layer(spark, path, kind, missing_ok=True)
    # no data column is read for this
    last = every.where("whole").agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]
    since = (F.col("version") == last) & F.col("whole") | (F.col("version") > last)
    return every.where(since).drop("whole")


def _last(rows: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys and c != "version"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("_row"))
    return newest.select(*keys, "_row.*")


def read_updates(spark: SparkSession, table: str, path: str, schema: StructType | None = None) -> DataFrame:
    """The merged table: the last version of every key."""
    if schema is None:
        schema = StructType([f for f in spark.read.parquet(path).schema if f.name not in ("whole", "version")])
    rows = versions(spark, path, schema)
    return _last(rows, list(_GROUPS[table])).select(*schema.names)


# ------------------------------------------------------------------ windows

def closed_windows(items: DataFrame, delay: str, window: str = "1 day") -> DataFrame:
    """Tumbling-window sales of a stream, each window once it is closed.

    Items are first summed by window and order, then by window, so orders are
    counted exactly and the state of a window goes when the watermark passes
    its end.
    """
    exact = F.col("item_total").try_cast("decimal(28,10)")
    per_order = items.withWatermark("event_timestamp", delay).groupBy(
        F.window("event_timestamp", window).alias("w"), "order_id").agg(
        F.sum("item_total").alias("total"), F.count("item_total").alias("n"),
        F.sum(exact).alias("exact"), F.count(exact).alias("n_exact"))
    per_window = per_order.groupBy("w").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.sum("exact").alias("exact"),
        F.sum("n_exact").alias("n_exact"), F.count("order_id").alias("total_orders"))
    mean = F.when(F.col("n") == F.col("n_exact"), F.round(F.try_divide("exact", "n"), 2).cast("double")).otherwise(
        F.round(F.try_divide("total", "n"), 2))
    return per_window.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                             F.round("total", 2).alias("total_revenue"), "total_orders",
                             mean.alias("avg_order_value"))


def window_job(items: DataFrame, out: str, ckpt: str, delay: str, window: str = "1 day", trigger=None):
    """Append closed windows to a table, partitioned by none: a row per window."""
    return sinks.start_append(closed_windows(items, delay, window), out, ckpt, trigger, partition_by=(),
                              name="sales_windows")
