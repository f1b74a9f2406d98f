"""Incremental bronze -> silver -> gold jobs (default trigger: availableNow)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators import bronze as B
from bazaar.operators import gold as G
from bazaar.operators.dating import date_by_order_stream
from bazaar.operators.gold import GOLD
from bazaar.operators.silver import silver
from bazaar.session import cluster_by_date
from bazaar.streaming import evolution, sinks
from bazaar.streaming.merge import survivors, touched
from bazaar.specs import ENTITIES, ENVELOPE_SCHEMA, Entity
from bazaar.streaming.sources import envelope_stream, layer_stream, source

def bronze_schema(spark: SparkSession, entity: str):
    """Declared bronze table schema (streams start before any file exists)."""
    empty = spark.createDataFrame([], ENVELOPE_SCHEMA)
    return B.parse_envelope(empty, entity, clock=True).schema


def silver_schema(spark: SparkSession, entity: str):
    empty = spark.createDataFrame([], bronze_schema(spark, entity))
    return silver(entity, empty, clock=True).schema


def bronze_job(spark: SparkSession, entity: str | Entity, src: str | DataFrame, out: str, ckpt: str,
               trigger=None, event_time: str = "business", files_per_date: int | None = None,
               defaults: dict | None = None, partition_by: tuple[str, ...] = ("event_date",),
               batch_bytes: int | None = None):
    """``src``: a folder of envelope files, of which a micro-batch reads
    ``batch_bytes`` at most, or any envelope stream (for Kafka
    ``sources.source(spark, topic, servers=...)``).

    With ``defaults`` the table may gain columns: an entity with further wire
    fields (``Entity.extended``) goes on in the same table and checkpoint, and
    ``evolution.read`` reads old and new rows together.
    """
    ent = ENTITIES[entity] if isinstance(entity, str) else entity
    env = envelope_stream(spark, src, max_bytes_per_trigger=batch_bytes) if isinstance(src, str) else src
    df = B.parse_envelope(env, ent, event_time=event_time, clock=True)
    if defaults is not None:
        df = evolution.fit(df, evolution.declare(spark, out, df.schema, defaults))
    return sinks.start_append(df, out, ckpt, trigger, partition_by, name=f"bronze_{ent.name}",
                              files_per_date=files_per_date)


def kafka_bronze_job(spark: SparkSession, entity: str, servers: str, out: str, ckpt: str, trigger="10 seconds",
                     starting: str = "earliest", **kw):
    """The entity's topic on ``servers`` into its bronze table (needs the Kafka connector)."""
    return bronze_job(spark, entity, source(spark, ENTITIES[entity].topic, servers=servers, starting=starting),
                      out, ckpt, trigger, **kw)


def silver_job(spark: SparkSession, entity: str, bronze_path: str, out: str, ckpt: str,
               trigger=None, watermark: str | None = None, files_per_date: int | None = None,
               unbounded: bool = False, without: tuple[str, ...] = (), batch_bytes: int | None = None):
    """De-duplication by state, the first arrival of a key survives.  Columns ``without`` are not read.

    Without a ``watermark`` the state holds every key for ever, which must be
    asked for with ``unbounded``.  ``merge.survivors_job`` needs no state.
    ``batch_bytes``: what a micro-batch reads at most; not for a backfill with
    a watermark, which would drop rows that come after later ones.
    """
    if not watermark and not unbounded:
        raise ValueError("give a watermark, or unbounded=True for state that is never dropped")
    if watermark and batch_bytes:
        raise ValueError("a backfill with a watermark is one micro-batch")
    rows = layer_stream(spark, bronze_path, bronze_schema(spark, entity), max_bytes_per_trigger=batch_bytes).drop(*without)
    df = silver(entity, rows, watermark=watermark, clock=True)
    return sinks.start_append(df, out, ckpt, trigger, name=f"silver_{entity}", files_per_date=files_per_date)


def dated_stream(spark: SparkSession, entity: str, bronze_path: str, orders_path: str, wait: str = "1 hour",
                 without: tuple[str, ...] = ()) -> DataFrame:
    """Bronze order items or payments, dated by the bronze orders; columns ``without`` are not read."""
    rows, orders = (layer_stream(spark, p, bronze_schema(spark, e)) for p, e in ((bronze_path, entity), (orders_path, "orders")))
    return date_by_order_stream(rows.drop(*without), orders.drop(*without), wait)


def dating_job(spark: SparkSession, entity: str, bronze_path: str, orders_path: str, out: str, ckpt: str,
               trigger=None, wait: str = "1 hour", files_per_date: int | None = None):
    """Append bronze rows with their dates to ``out``, a table like bronze."""
    df = dated_stream(spark, entity, bronze_path, orders_path, wait)
    return sinks.start_append(df, out, ckpt, trigger, name=f"dated_{entity}", files_per_date=files_per_date)


def touched_days(silver_all: DataFrame, batch: DataFrame) -> DataFrame | None:
    """The silver rows of the days that ``batch`` touches.

    The distinct days (as many as the calendar has) go to the scan as a
    partition filter, so only their folders are read; rows without a date are a
    partition of their own.
    """
    days = touched(batch)
    return None if days is None else silver_all.where(days)


def gold_complete_job(spark: SparkSession, table: str, silver_path: str, out: str, ckpt: str,
                      trigger=None, schema=None):
    """Stateful aggregation in complete mode (approximate distinct counts)."""
    src = GOLD[table][0]
    df = G.build(table, layer_stream(spark, silver_path, schema or silver_schema(spark, src)))
    return sinks.start_complete(df, out, ckpt, trigger, name=f"gold_{table}")


def gold_incremental(spark: SparkSession, table: str | list[str], silver_path: str, out: str,
                     ckpt: str, trigger=None, schema=None, resolve: bool = False):
    """Exact gold without aggregation state.

    Each micro-batch of new silver rows only names the days it touches; those
    days are re-aggregated from the silver table and replace their ``event_date`` partitions in the gold table (dynamic
    partition overwrite).  Re-running a batch recomputes the same days, so it
    is idempotent; work per batch is proportional to the touched days.

    ``table`` may be a list of gold tables built from the same silver table:
    the touched days are then read once (shared scan, persisted for the
    batch) and each table is written to ``<out>/<table>``.  ``resolve``: the
    silver table is one of ``merge.survivors_job``.
    """
    tables = [table] if isinstance(table, str) else list(table)
    srcs = {GOLD[t][0] for t in tables}
    if len(srcs) != 1:
        raise ValueError(f"tables come from different silver tables: {sorted(srcs)}")
    src = srcs.pop()
    declared = schema or silver_schema(spark, src)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select("event_date").persist()  # read twice, one narrow column
        try:
            rows = touched_days(spark.read.schema(declared).parquet(silver_path), batch)
            if rows is not None:
                rebuild(survivors(rows, src) if resolve else rows)
        finally:
            batch.unpersist()

    def rebuild(rows: DataFrame) -> None:
        shared = len(tables) > 1
        if shared:
            rows = rows.persist()
        try:
            for t in tables:
                res = G.build(t, rows, distinct="exact")
                dest = out if isinstance(table, str) else f"{out}/{t}"
                # one row per day and category: clustering by day is enough
                (cluster_by_date(res).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("event_date").parquet(dest))
        finally:
            if shared:
                rows.unpersist()

    name = "_".join(tables) if len(tables) <= 3 else f"{src}_{len(tables)}"
    q = (layer_stream(spark, silver_path, declared).writeStream
         .option("checkpointLocation", ckpt).foreachBatch(refresh).queryName(f"gold_inc_{name}"))
    return sinks.apply_trigger(q, trigger).start()
