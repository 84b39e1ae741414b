"""Scalar casts from JSON text to typed columns (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient_cast(c: Column, to: T.DataType, strict: bool = False) -> Column:
    """Text -> type.  Lenient (default): bad text or overflow gives null, so one
    bad message never stops a stream.  ``strict=True`` fails the job instead."""
    if isinstance(to, T.TimestampType):
        return parse_event_time(c, strict=strict)
    return c.cast(to) if strict else c.try_cast(to)


def parse_event_time(c: Column, strict: bool = False) -> Column:
    """ISO-8601 text (``2024-01-01T10:00:00.123Z``) or epoch-ms digits -> timestamp,
    kept at millisecond precision."""
    as_long = c.cast(T.LongType()) if strict else c.try_cast(T.LongType())
    as_ts = c.cast(T.TimestampType()) if strict else c.try_cast(T.TimestampType())
    dated = F.when(c.rlike(r"^\s*[+-]?[0-9]{4,}-"), as_ts)  # a time alone would take today's date
    parsed = F.when(c.rlike(r"^\s*-?[0-9]+\s*$"), F.timestamp_millis(as_long)).otherwise(as_ts if strict else dated)
    return F.date_trunc("millisecond", parsed)


def to_ntz(c: Column) -> Column:
    """Timestamp -> timestamp_ntz in the session zone (UTC), for zone-free reports."""
    return c.cast(T.TimestampNTZType())
