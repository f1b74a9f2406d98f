"""Stream sources: Kafka when servers are given, otherwise a file stream of the
same Kafka-shaped envelope (value, topic, partition,
offset, timestamp)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from bazaar.specs import ENVELOPE_SCHEMA


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting: str = "earliest") -> DataFrame:
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .load()
            .select("value", "topic", "partition", "offset", "timestamp"))


def _limits(reader, files: int | None, size: int | None):
    """What one micro-batch reads at most: files, or bytes of files."""
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.option("maxBytesPerTrigger", size) if size else reader


def envelope_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                    max_bytes_per_trigger: int | None = None) -> DataFrame:
    """File fallback: every new file under ``path`` is read once (progress is
    kept in the query checkpoint, so "latest" means "files not yet seen")."""
    r = spark.readStream.schema(ENVELOPE_SCHEMA).format(fmt)
    return _limits(r, max_files_per_trigger, max_bytes_per_trigger).load(path)


def source(spark: SparkSession, topic: str, *, servers: str | None = None,
           path: str | None = None, starting: str = "earliest") -> DataFrame:
    """Kafka if ``servers`` is given, else files under ``path``."""
    if servers:
        return kafka_stream(spark, servers, topic, starting)
    if path is None:
        raise ValueError("need servers or path")
    return envelope_stream(spark, path)


def layer_stream(spark: SparkSession, path: str, schema=None,
                 max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Stream a parquet layer table written by a file sink (schema taken from
    the table itself when not given)."""
    if schema is None:
        schema = spark.read.parquet(path).schema
    return _limits(spark.readStream.schema(schema), max_files_per_trigger, max_bytes_per_trigger).parquet(path)


def read_layer(spark: SparkSession, path: str, schema=None, missing_ok: bool = False) -> DataFrame:
    """Batch read of a layer table; an empty frame of ``schema`` when the
    table does not exist yet and ``missing_ok``.  Any other failure is raised."""
    try:
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if missing_ok and schema is not None and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
