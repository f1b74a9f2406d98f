"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that matter at any scale; every one can be overridden by the caller
# or by spark-submit (values already present in the session are kept).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: A query's shuffle files go when it has ended, not when the driver happens to collect garbage.
CLEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: For streams with much state: on disk instead of the executors' heap, a join's in one store, rows not counted at each put.
BIG_STATE = {
    "spark.sql.streaming.stateStore.providerClass": DEFAULT_CONF["spark.sql.streaming.stateStore.providerClass"],
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextmanager
def preset(spark: SparkSession, *confs: dict):
    """Settings for the queries and streams that are started inside the block;
    the caller's own values stay, and so does the session afterwards."""
    mine = {k: v for conf in confs for k, v in conf.items() if spark.conf.get(k, None) is None}
    for k, v in mine.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


def get_spark(master: str | None = None, app: str = "bazaar",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset so spark-submit decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf)
    for k, v in merged.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune_local(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (tests, the bench)."""
    try:
        return spark.sparkContext.master.split("[")[0] == "local"
    except Exception:  # sessions without the classic context API
        return False


LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def tune_local(spark: SparkSession) -> None:
    """In one process, listing a table of thousands of tiny date folders by a
    task each costs more than reading it: use one task per core there.  A
    cluster's setting is left alone."""
    if is_local(spark):
        spark.conf.set(LISTING_KEY, str(spark.sparkContext.defaultParallelism))


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Without the setting a local session gets a folder under the system temp
    folder; on a cluster that would be each machine's own, so it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="bazaar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # sessions without the classic context API
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread_by_date(df, partition_cols=("event_date",)):
    """Bring each date's rows together for a date-partitioned batch write.

    A rebalance: adaptive execution splits a hot date by size over several
    tasks and merges small dates, so files have about the advisory size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    """
    return df.hint("rebalance", *partition_cols)


def cluster_by_date(df, partition_cols=("event_date",), files_per_date: int = 1):
    """The same for a stream's backfill, where nothing adapts at run time:
    hash on (date, bucket), so a date is written by ``files_per_date`` tasks."""
    from pyspark.sql import functions as F
    n = shuffle_partitions(df.sparkSession)
    if files_per_date == 1:
        return df.repartition(n, *partition_cols)
    bucket = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_date))
    return df.repartition(n, *partition_cols, bucket)
