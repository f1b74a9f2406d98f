"""One micro-batch into several tables, each exactly once.

A table is partitioned by the batch number below its other partition columns.
A batch replaces its own partitions only, so a replay after a failure between
two of the writes gives every table the same rows once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.operators import bronze as B
from bazaar.specs import Entity
from bazaar.streaming import sinks

BATCH = "batch_id"


@dataclass(frozen=True)
class Route:
    """Rows that meet ``where`` go to ``path``."""

    path: str
    where: Column
    partition_by: tuple[str, ...] = ("event_date",)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Replace what batch ``batch_id`` has in a table."""
    (df.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by, BATCH).parquet(path))


def start_split(df: DataFrame, routes: Callable[[DataFrame, int], list[Route]] | list[Route], checkpoint: str,
                trigger=None, name: str | None = None, done: Callable[[DataFrame, int], None] | None = None):
    """Write each micro-batch to several tables; it is computed once.

    ``routes`` may depend on the batch.  ``done`` runs when all are written.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for r in routes(batch, batch_id) if callable(routes) else routes:
                write_batch(batch.where(r.where), r.path, batch_id, r.partition_by)
            if done:
                done(batch, batch_id)
        finally:
            batch.unpersist()

    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return sinks.apply_trigger(w.queryName(name) if name else w, trigger).start()


def quarantine_job(env: DataFrame, entity: str | Entity, bronze: str, rejects: str, checkpoint: str, trigger=None,
                   partition_by: tuple[str, ...] = ("event_date",)):
    """Bronze rows to one table, malformed records to another, in one pass."""
    df = B.parse_envelope(env, entity, clock=True)
    bad = B.is_reject(entity)
    return start_split(df, [Route(bronze, ~bad, partition_by), Route(rejects, bad, ())], checkpoint, trigger)


def late_rows_job(df: DataFrame, delay: str, main: str, side: str, checkpoint: str, trigger=None,
                  time_col: str = "event_timestamp", partition_by: tuple[str, ...] = ("event_date",)):
    """Rows behind the watermark, or without a time, to a side table with the reason.

    The watermark of a batch is the largest event time of all batches before it
    less ``delay``, as Spark's own is.  The largest time so far is kept in two
    slots, by the batch's parity: a batch reads the slot of the one before and
    writes the other, so a replay splits the rows in the same way.
    """
    spark = df.sparkSession
    marks = f"{main.rstrip('/')}-watermark"
    kind = f"{BATCH} long, largest timestamp"

    def before(batch_id: int):
        """Largest event time of the batches before; None in the first."""
        if batch_id == 0:
            return None
        return spark.read.schema(kind).parquet(f"{marks}/slot={(batch_id - 1) % 2}").first()["largest"]

    def routes(batch: DataFrame, batch_id: int) -> list[Route]:
        largest = before(batch_id)
        t = F.col(time_col)
        late = F.lit(False) if largest is None else F.coalesce(
            t < F.lit(largest).cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(False))
        return [Route(main, ~late & t.isNotNull(), partition_by), Route(f"{side}/reason=late", late, ()),
                Route(f"{side}/reason=undated", t.isNull(), ())]

    def done(batch: DataFrame, batch_id: int) -> None:
        now = batch.agg(F.max(time_col).alias("largest"))
        old = F.lit(before(batch_id)).cast("timestamp")
        (now.select(F.lit(batch_id).cast("long").alias(BATCH), F.greatest("largest", old).alias("largest"))
         .coalesce(1).write.mode("overwrite").parquet(f"{marks}/slot={batch_id % 2}"))

    return start_split(df, routes, checkpoint, trigger, done=done)
