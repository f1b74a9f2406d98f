"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(near: DataFrame, large: bool) -> DataFrame:
    """``near`` has (a, b).  Hang the neighbours of each a on its smallest.

    The minimum is a map-side combined aggregate joined back on a, so a hub's
    neighbours are not gathered in one task (the join's other side has one
    row per a and can be split).
    """
    low = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    hung = near.join(low, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(low.select("a", F.col("m").alias("b"))))
    return out.where("a > b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest.

    Every round is written to the shared folder, so lineage stays short.
    Rounds grow with the logarithm of the longest path.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a > b").distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        grown = stored(_star(_both(edges), large=True), "large-star")
        edges = stored(_star(grown, large=False), "small-star")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
