"""Bronze layer: Kafka-shaped envelope -> raw text + parsed string payload.

Works on batch and streaming frames.  The payload is parsed with a fixed
all-string schema (numbers keep their text, unknown keys are dropped, a
malformed record becomes an all-NULL payload while ``raw_json`` keeps the
text).  ``rejects`` isolates such records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.specs import ENTITIES, ID_COLUMNS, Entity

# Business time that the publisher adds for entities without a date column of
# their own (order items, payments).  It is not the record's ``event_time``,
# which is the clock of the sender.
BUSINESS_TIME = "business_time"


def payload_schema(ent: Entity) -> T.StructType:
    return T.StructType(ent.wire_schema().fields + [T.StructField(BUSINESS_TIME, T.StringType())])


def parse_envelope(env: DataFrame, ent: Entity | str, event_time: str = "business",
                   clock: bool = False) -> DataFrame:
    ent = ENTITIES[ent] if isinstance(ent, str) else ent
    base = env.select(
        F.col("value").cast("string").alias("raw_json"), "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"))
    parsed = base.select("*", F.from_json("raw_json", payload_schema(ent)).alias("data"))
    flat = parsed.select("raw_json", "topic", "partition", "offset", "kafka_timestamp",
                         *[F.col(f"data.{f}").alias(f) for f in (*ent.fields, *ent.extra)],
                         F.col(f"data.{BUSINESS_TIME}").alias("_event_text"))
    text = F.trim("_event_text").try_cast("timestamp")
    own = F.trim(F.col(ent.event_column)).try_cast("timestamp")
    if event_time == "literal":
        ts = own
    elif ent.event_column in ID_COLUMNS:
        ts = text  # never read an id as a time
    else:
        # the entity's own date decides the day; the business time adds the
        # time of that day
        ts = F.when(own.isNull(), text).when(F.to_date(text) == F.to_date(own), text).otherwise(own)
    out = flat.withColumn("event_timestamp", ts).withColumn("event_date", F.to_date("event_timestamp"))
    out = out.drop("_event_text")
    if clock:
        out = out.withColumn("bronze_ingest_time", F.current_timestamp())
    return out.withColumn("bronze_layer", F.lit("bronze")).withColumn("data_source", F.lit(ent.topic))


def is_reject(ent: Entity | str) -> Column:
    """Whether a record's text is present but its payload parsed to nothing."""
    ent = ENTITIES[ent] if isinstance(ent, str) else ent
    bad = F.col("raw_json").isNotNull()
    for f in ent.fields:
        bad = bad & F.col(f).isNull()
    return bad


def rejects(bronze: DataFrame, ent: Entity | str) -> DataFrame:
    """Records whose text is present but whose payload parsed to nothing."""
    return bronze.where(is_reject(ent))


def to_wire(df: DataFrame, ent: Entity | str, topic: str | None = None,
            offset_col: str | None = None, partitions: int = 8) -> DataFrame:
    """Publish side (JSON event): typed rows -> Kafka-shaped envelope.

    Every field is sent as text (NULL kept as JSON null); the event time is
    added as ``business_time`` in ISO form with microseconds.  ``partition`` is a hash of the
    record's text over ``partitions`` topic partitions; ``offset`` is a caller-chosen unique column,
    else a 64-bit hash of the record text -- deterministic, so a task retried
    after an executor loss publishes the same envelope.
    """
    ent = ENTITIES[ent] if isinstance(ent, str) else ent
    fields = [F.col(f).cast("string").alias(f) for f in ent.fields]
    ev = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(BUSINESS_TIME)
    value = F.to_json(F.struct(*fields, ev), {"ignoreNullFields": "false"})
    off = F.col(offset_col).cast("long") if offset_col else F.xxhash64(value)
    return df.select(
        value.cast("binary").alias("value"),
        F.lit(topic or ent.topic).alias("topic"),
        F.pmod(F.xxhash64(value), F.lit(partitions)).cast("int").alias("partition"),
        off.alias("offset"),
        F.col("event_timestamp").alias("timestamp"),
    )
