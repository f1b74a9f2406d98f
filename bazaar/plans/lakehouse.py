"""Whole-lakehouse jobs: the batch build and the 26-query streaming app.

Layout under ``base``: ``bronze/<entity>``, ``silver/<entity>`` (both
partitioned by ``event_date``), ``gold/<table>`` (partitioned by
``event_date``, rebuilt per touched day) and ``_checkpoints/...``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.operators import bronze as B
from bazaar.operators import gold as G
from bazaar.operators import rollups as R
from bazaar.operators import serving as S
from bazaar.operators.dating import date_by_order
from bazaar.operators.gold import GOLD
from bazaar.operators.quality import readiness
from bazaar.operators.silver import silver
from bazaar.session import spread_by_date
from bazaar.specs import ENVELOPE_SCHEMA
from bazaar.streaming import jobs
from bazaar.streaming.jobs import silver_schema
from bazaar.streaming.merge import survivors, survivors_job
from bazaar.streaming.sources import layer_stream

#: Entities without a date of their own.
UNDATED = ("order_items", "payments")


def _write(df: DataFrame, path: str) -> None:
    """Replace the whole table, so days that are gone from the input go."""
    (spread_by_date(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("event_date").parquet(path))


def build_batch(spark: SparkSession, inputs: dict[str, str], base: str) -> None:
    """Envelope files per entity -> bronze -> silver -> gold tables (batch).

    Each layer is written and re-read, so later layers start from the stored
    table (lineage cut, partitions pruned by date).  A rebuild replaces every
    table."""
    for e, src in inputs.items():
        _write(B.parse_envelope(spark.read.schema(ENVELOPE_SCHEMA).parquet(src), e, clock=True),
               f"{base}/bronze/{e}")
    for e in inputs:
        rows = spark.read.parquet(f"{base}/bronze/{e}")
        if e in UNDATED and "orders" in inputs:
            rows = date_by_order(rows, spark.read.parquet(f"{base}/bronze/orders"))
        _write(silver(e, rows, clock=True), f"{base}/silver/{e}")
    for t, (src, _) in GOLD.items():
        if src in inputs:
            _write(G.build(t, spark.read.parquet(f"{base}/silver/{src}")), f"{base}/gold/{t}")


def stored_gold(spark: SparkSession, base: str, tables=GOLD) -> dict[str, DataFrame]:
    """The stored gold tables under ``base``."""
    return {t: spark.read.parquet(f"{base}/gold/{t}") for t in tables}


def stored_readiness(spark: SparkSession, base: str, tables=GOLD) -> DataFrame:
    """Rows and last day of the stored gold tables.

    Both come from folder names and file footers: the scans read no column.
    """
    return readiness(stored_gold(spark, base, tables))


def stored_features(spark: SparkSession, base: str, gap_fill: bool = False) -> DataFrame:
    """The daily feature table from stored gold."""
    g = stored_gold(spark, base)
    return R.feature_table(g["daily_sales"], g["traffic_kpi"], g["payment_analytics"], g["inventory_kpi"],
                           g["returns_kpi"], g["review_analytics"], gap_fill=gap_fill)


def stored_serving(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The dashboard's tables that stored gold and silver answer."""
    g = stored_gold(spark, base)
    sales = S.sales_kpi(read_silver(spark, base, "order_items"))
    return {"sales_kpi": sales, "headline": S.headline(sales), "sentiment": S.sentiment_distribution(g["review_analytics"]),
            "inventory_alert": S.inventory_alert(g["inventory_kpi"]), "sources": S.sessions_by_source(g["traffic_kpi"]),
            "delivery": S.delivery_kpi(g["shipping_kpi"]),
            "fraud_alerts": S.fraud_alert(read_silver(spark, base, "payments"))}


def read_silver(spark: SparkSession, base: str, entity: str) -> DataFrame:
    """A stored silver table, one row per key (the first of the log).  Tables
    whose rows are single already come out as they are."""
    return survivors(spark.read.parquet(f"{base}/silver/{entity}"), entity)


def start_streaming(spark: SparkSession, inputs: dict[str, str | DataFrame], base: str, trigger=None,
                    watermark: str | None = None, gold: str = "incremental",
                    files_per_date: int | None = None, survivor: str = "log", wait: str = "1 hour") -> list:
    """Start 8 bronze + 8 silver queries and the gold jobs: one incremental
    job per silver table (6, shared scans) or, with ``gold="complete"``, one
    stateful query per gold table (9).  With orders among the inputs, order
    items and payments get one more query that dates them by their orders.

    An input is a folder of envelope files or an envelope stream (Kafka).
    Silver and gold read their upstream tables as streams with declared
    schemas, so all queries can start before any data exists.  With the
    default availableNow trigger a layer starts when the one below has
    consumed its input; with a processing-time trigger all run together: use
    ``sinks.run_until_any_stops``.

    ``survivor="log"``: of the copies of a key the first of the log survives, as
    in ``build_batch``; silver needs no state, and is read with ``read_silver``.
    ``survivor="arrival"``: the first to arrive does, by state that ``watermark``
    bounds (complete-mode gold needs this form).
    """
    if gold == "complete" and survivor == "log":
        raise ValueError('complete-mode gold adds up all silver rows: use survivor="arrival"')
    ck = f"{base}/_checkpoints"
    once = trigger in (None, "availableNow", "once")

    def finished(queries):
        for q in queries:
            if once:
                q.awaitTermination()
        return queries

    qs = finished([jobs.bronze_job(spark, e, src, f"{base}/bronze/{e}", f"{ck}/bronze/{e}", trigger,
                                   files_per_date=files_per_date) for e, src in inputs.items()])
    upstream = {e: f"{base}/bronze/{e}" for e in inputs}
    undated = [e for e in UNDATED if e in inputs] if "orders" in inputs else []
    qs += finished([jobs.dating_job(spark, e, upstream[e], upstream["orders"], f"{base}/dated/{e}", f"{ck}/dated/{e}",
                                    trigger, wait, files_per_date) for e in undated])
    upstream |= {e: f"{base}/dated/{e}" for e in undated}
    if survivor == "log":
        qs += finished([survivors_job(layer_stream(spark, upstream[e], jobs.bronze_schema(spark, e)), e,
                                      f"{base}/silver/{e}", f"{ck}/silver/{e}", trigger, schema=silver_schema(spark, e))
                        for e in inputs])
    else:
        qs += finished([jobs.silver_job(spark, e, upstream[e], f"{base}/silver/{e}", f"{ck}/silver/{e}",
                                        trigger, watermark, files_per_date, unbounded=watermark is None) for e in inputs])
    if gold == "incremental":
        # one job per silver table: its touched days are read once for all
        # of its gold tables (shared scan)
        by_src: dict[str, list[str]] = {}
        for t, (src, _) in GOLD.items():
            if src in inputs:
                by_src.setdefault(src, []).append(t)
        for src, tables in by_src.items():
            qs.append(jobs.gold_incremental(spark, tables, f"{base}/silver/{src}", f"{base}/gold",
                                            f"{ck}/gold/{src}", trigger, silver_schema(spark, src),
                                            resolve=survivor == "log"))
    else:
        for t, (src, _) in GOLD.items():
            if src in inputs:
                qs.append(jobs.gold_complete_job(spark, t, f"{base}/silver/{src}", f"{base}/gold/{t}",
                                                 f"{ck}/gold/{t}", trigger, silver_schema(spark, src)))
    return qs

