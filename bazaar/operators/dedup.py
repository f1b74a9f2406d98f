"""Duplicate removal by key.

Batch: one survivor per key.  Rows with bronze lineage keep the first record of
the log (smallest topic partition and offset); without lineage it is the
smallest row (remaining columns compared left to right, NULL first).  It is written as an
aggregate (``min`` of a struct), so Spark combines map-side before the
shuffle: a key that holds a third of all rows leaves one row per map task,
never one giant group in one task.

Streaming: Spark's stateful ``dropDuplicates`` (first arrival survives).  With
a watermark on ``event_timestamp`` -- which is part of every entity key -- the
state for keys older than the watermark is evicted, so state stays bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_batch(df: DataFrame, keys: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """``keep``: the columns besides the keys that the reader uses.  Rows are
    compared from left to right, so the columns behind the last of them can't
    change what it holds and are left out of the comparison and the result."""
    keys = list(keys)
    first = [c for c in ("partition", "offset") if c in df.columns and c not in keys]
    rest = first + [c for c in df.columns if c not in keys and c not in first]
    if keep is not None:
        rest = rest[:max((i + 1 for i, c in enumerate(rest) if c in keep), default=0)]
    cols = [c for c in df.columns if c in keys or c in rest]
    if not rest:
        return df.select(*cols).dropDuplicates(keys)
    if len(rest) == 1:  # the smallest value, NULL first, without a struct: hashed, where a struct is sorted
        c = F.col(rest[0])
        least = F.when(F.count(c) == F.count(F.lit(1)), F.min(c))
        return df.groupBy(*keys).agg(least.alias(rest[0])).select(*cols)
    agg = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_survivor"))
    return agg.select(*keys, "_survivor.*").select(*cols)


def dedup_stream(df: DataFrame, keys: Sequence[str], watermark: str | None = None,
                 time_col: str = "event_timestamp", within_watermark: bool = False) -> DataFrame:
    """``within_watermark``: keys that need not contain the event time (e.g.
    re-sent records keyed by business id only); a duplicate is dropped if it
    arrives within the watermark delay of the first copy, and state for a key
    expires after that delay (``dropDuplicatesWithinWatermark``)."""
    if watermark:
        df = df.withWatermark(time_col, watermark)
    if within_watermark:
        if not watermark:
            raise ValueError("within_watermark needs a watermark")
        return df.dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


def dedup(df: DataFrame, keys: Sequence[str], watermark: str | None = None,
          keep: Sequence[str] | None = None) -> DataFrame:
    if df.isStreaming:
        return dedup_stream(df, keys, watermark)
    return dedup_batch(df, keys, keep)
