"""Batch medallion plans: driver tables -> silver -> gold, lazily composed.

Each function but ``replay_log`` returns a DataFrame whose plan Catalyst
optimises end to end, without materialising data (the parquet scans only read
the columns the gold aggregate needs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.operators import gold as G
from bazaar.operators import journey as J
from bazaar.operators.silver import silver
from bazaar.session import CLEAN, preset, scratch_path
from bazaar.sources import testdata


def silver_table(spark: SparkSession, sf_dir: str, name: str, **kw) -> DataFrame:
    return silver(name, testdata.entity(spark, sf_dir, name), **kw)


def gold_table(spark: SparkSession, sf_dir: str, name: str, **kw) -> DataFrame:
    src, build = G.GOLD[name]
    return build(silver_table(spark, sf_dir, src, keep=G.USES[name]), **kw)


# --- serving tables ------------------------------------------------------
def sales_kpi(spark, sf_dir, window: str = "1 day", **kw) -> DataFrame:
    from bazaar.operators import serving as S
    return S.sales_kpi(silver_table(spark, sf_dir, "order_items"), window=window, **kw)


def customer_metrics(spark, sf_dir) -> DataFrame:
    from bazaar.operators import serving as S
    return S.customer_metrics(silver_table(spark, sf_dir, "orders"),
                              silver_table(spark, sf_dir, "payments"))


def all_silver(spark, sf_dir, names=None, keep=None) -> dict:
    """``keep``: entity -> the wire fields that are used besides its keys."""
    from bazaar.specs import ENTITIES
    return {n: silver_table(spark, sf_dir, n, keep=keep and keep[n]) for n in (names or ENTITIES)}


def replay_log(spark, sf_dir, seed: int = 42) -> DataFrame:
    """The journey in replay order.

    Each step's events get their order's day and are written before the next
    step's, so the shuffle files of a step don't lie beside those of all others
    and of the sort.
    """
    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        with preset(spark, CLEAN):
            df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def step(name: str) -> DataFrame:
        return J.order_journey({name: silver_table(spark, sf_dir, name, keep=J.USES[name])})

    days = written(J.replay_days(step("orders")), "replay-days")
    parts = [written(J.on_replay_days(step(n), days), f"replay-{n}") for n, _, _ in J.STEPS]
    events = parts[0]
    for p in parts[1:]:
        events = events.unionByName(p)
    return J.in_replay_order(events, seed)
