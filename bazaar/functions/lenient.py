"""Null-on-failure conversions with the semantics of non-ANSI casts.

The session runs with ANSI on; a plain ``cast`` raises on bad text, and
``try_cast('12.0' as int)`` gives NULL where the wire contract expects 12 (the
producer serialises nullable integers through floats).  These helpers keep the
lenient behaviour while staying inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: integer text, optionally followed by a fractional part that a
# non-ANSI cast truncates away; like that cast, characters up to 0x20
# (spaces, tabs, line breaks, control characters) around it are ignored.
# ``\z`` is the absolute end: ``$`` would also accept a trailing line
# terminator such as U+0085.
INT_TEXT = r"^[\x00-\x20]*([+-]?[0-9]+)(\.[0-9]*)?[\x00-\x20]*\z"

# The three date layouts accepted by the date normaliser, in
# order of preference.
DATE_LAYOUTS = ("yyyy-MM-dd", "yyyyMMdd", "dd/MM/yyyy")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c, dtype: T.DataType, target: str = "int") -> Column:
    """Integer (``int`` or ``bigint``) from text or number; NULL when not integral."""
    c = _col(c)
    if isinstance(dtype, T.StringType):
        return F.regexp_extract(c, INT_TEXT, 1).try_cast(target)
    if isinstance(dtype, (T.NullType,)):
        return F.lit(None).cast(target)
    return c.try_cast(target)


def lenient_double(c, dtype: T.DataType) -> Column:
    c = _col(c)
    if isinstance(dtype, T.StringType):
        return F.trim(c).try_cast("double")
    return c.try_cast("double")


def lenient_date(c, dtype: T.DataType) -> Column:
    """Date from a date, timestamp or ISO-like text (date prefix); else NULL."""
    c = _col(c)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    return F.trim(c.cast("string")).try_cast("date")


def event_time(c, dtype: T.DataType) -> Column:
    """Event timestamp (session time zone) from text, date or timestamp."""
    c = _col(c)
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    return F.trim(c.cast("string")).try_cast("timestamp")


def normalize_event_date(c, dtype: T.DataType) -> Column:
    """First layout that parses wins; dates pass through unchanged."""
    c = _col(c)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    s = c.cast("string")
    return F.coalesce(*[F.try_to_date(s, fmt) for fmt in DATE_LAYOUTS])
