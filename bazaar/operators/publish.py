"""Publish-side record preparation (what a producer does before sending).

* ``coerce_timestamps``: listed columns that exist become timestamps, text
  that does not parse becomes NULL.
* ``json_safe``: NaN -> NULL, timestamps -> ISO-8601 text.
* ``enrich``: event_time (send clock), event_type, event_sequence.
* ``to_json_value``: the record as JSON text, NULLs kept as ``null``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def coerce_timestamps(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    present = {f.name: f.dataType for f in df.schema.fields}
    out = df
    for c in cols:
        if c in present and not isinstance(present[c], T.TimestampType):
            out = out.withColumn(c, F.trim(F.col(c).cast("string")).try_cast("timestamp"))
    return out


def json_safe(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def enrich(df: DataFrame, event_type: str, sequence: int) -> DataFrame:
    return df.select("*",
                     F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
                     F.lit(event_type).alias("event_type"), F.lit(sequence).alias("event_sequence"))


def to_json_value(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
