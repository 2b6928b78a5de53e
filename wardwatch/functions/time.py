"""Time helpers on TIMESTAMP_NTZ readings.

Readings are wall-clock UTC without zone; nothing here depends on the
session's time zone but the session clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = ("second", "minute", "hour", "day")


def ntz_literal(value: str | _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal from text or a naive datetime (no zone shift)."""
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def trunc_ntz(unit: str, ts: Column | str) -> Column:
    """``DATE_TRUNC(unit, ts)`` that stays TIMESTAMP_NTZ (Spark's returns TIMESTAMP)."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")     # through the session zone and back


def boundaries_between(unit: str, start: Column | str, end: Column | str) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end`` (BIGINT).

    Warehouse ``DATEDIFF`` semantics: 10:00:59 -> 10:01:01 is one minute,
    whereas Spark's ``timestamp_diff`` counts whole elapsed units (0). Both
    ends are truncated to the unit first, so the elapsed count between two
    aligned instants is exactly the boundary count.
    """
    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {_UNITS}")
    return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))


def to_event_time(ts: Column | str) -> Column:
    """NTZ reading time (UTC wall clock) as TIMESTAMP, the type a watermark requires, in any session zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts))


def from_event_time(ts: Column) -> Column:
    """The UTC wall clock of a TIMESTAMP, as NTZ, in any session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
