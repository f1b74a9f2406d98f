"""Stream sinks.

* append: parquet file sink (exactly-once through its commit log),
  partitioned by ``event_date``.
* complete (stateful aggregates): the parquet sink refuses complete mode, so
  each micro-batch result is an immutable version, published by one atomic
  create (``bazaar.streaming.manifest``); a version that is still being written
  is never seen, and one that is read is never changed.
* incremental gold: see ``bazaar.streaming.jobs.gold_incremental``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaar.session import cluster_by_date, is_local
from bazaar.streaming.manifest import Versions


#: Tasks that write one date of a backfill.
FILES_PER_DATE = 8


def apply_trigger(w, trigger):
    if trigger in (None, "availableNow"):
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    return w.trigger(processingTime=trigger)


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 partition_by: tuple[str, ...] = ("event_date",), name: str | None = None,
                 files_per_date: int | None = None) -> StreamingQuery:
    """Append to a date-partitioned parquet table.

    A live stream's rows carry a few dates, so by default they are written
    where they are, by all tasks.  A backfill (``availableNow``, ``once``) has
    many dates; there rows are first brought together by date, each date in
    ``files_per_date`` tasks (default: FILES_PER_DATE on a cluster, so a hot or
    NULL date is not one task's work; 1 in a local session).  Give
    ``files_per_date`` to cluster in either case; ``compact`` merges small
    files later.
    """
    if files_per_date is None and trigger in (None, "availableNow", "once"):
        files_per_date = 1 if is_local(df.sparkSession) else FILES_PER_DATE
    if partition_by and files_per_date:
        df = cluster_by_date(df, partition_by, files_per_date)
    w = (df.writeStream.format("parquet").outputMode("append").option("compression", "zstd")
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return apply_trigger(w, trigger).start()


def start_debug(df: DataFrame, trigger: str | None = None, rows: int = 20, mode: str = "append") -> StreamingQuery:
    """Print each micro-batch to the console."""
    w = (df.writeStream.format("console").outputMode(mode)
         .option("numRows", rows).option("truncate", False))
    return apply_trigger(w, trigger).start()


def start_complete(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                   keep: int = 10, name: str | None = None) -> StreamingQuery:
    """Publish every micro-batch's whole result as version ``batch number``.

    A replay of a published batch changes nothing.  The newest ``keep``
    versions stay, and those that a reader holds a lease on.
    """
    versions = Versions(df.sparkSession, path)

    def publish(batch: DataFrame, batch_id: int) -> None:
        versions.publish(batch_id, lambda folder: batch.write.parquet(folder))
        versions.retain(keep)

    w = (df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(publish))
    if name:
        w = w.queryName(name)
    return apply_trigger(w, trigger).start()


def read_complete(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A published version of a complete-mode table, by default the latest.

    For reads that last longer than ``keep`` batches use ``reading``.
    """
    versions = Versions(spark, path)
    number = versions.latest() if version is None else version
    if number is None:
        raise ValueError(f"nothing is published under {path}")
    return spark.read.parquet(versions.folder(number))


@contextmanager
def reading(spark: SparkSession, path: str):
    """The latest version, spared by retention while the block runs."""
    with Versions(spark, path).lease() as folder:
        yield spark.read.parquet(folder)


def run_until_any_stops(queries: list[StreamingQuery]) -> None:
    """Block until one of the queries ends, then stop the others; its error is raised.

    Queries of the session that are not in the list, running or ended, don't
    matter.
    """
    if not queries:
        return
    streams = SparkSession.getActiveSession().streams
    try:
        while True:
            streams.resetTerminated()  # what ends from here on is not missed
            if not all(q.isActive for q in queries):
                break
            try:
                streams.awaitAnyTermination()
            except StreamingQueryException:
                pass  # its own, if it is in the list, is raised below
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if q.exception():
            raise q.exception()


def publish_envelopes(frames: dict[str, DataFrame], path: str, mode: str = "append") -> None:
    """Batch publication of several entities at once (the file stand-in for a
    multi-topic producer): envelopes unioned and written partitioned by
    ``topic``, so a reader of ``<path>/topic=<t>`` sees one topic.

    ``frames`` maps entity name -> typed rows with ``event_timestamp``.
    """
    from bazaar.operators.bronze import to_wire
    envs = [to_wire(df, name) for name, df in frames.items()]
    out = envs[0]
    for e in envs[1:]:
        out = out.unionByName(e)
    out.write.mode(mode).partitionBy("topic").parquet(path)


def publish_kafka(env: DataFrame, servers: str) -> None:
    """Envelope rows to Kafka (needs the connector on the classpath); the
    ``topic`` column routes each record."""
    (env.select("topic", F.col("partition").cast("int").alias("partition"), "value")
     .write.format("kafka").option("kafka.bootstrap.servers", servers).save())
