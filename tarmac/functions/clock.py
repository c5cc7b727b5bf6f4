"""Arithmetic on zone-less timestamps that does not depend on the session time zone.

``timestampdiff`` and casts to a zoned timestamp read the wall clock in the session's zone,
where some hours are missing or double. Subtracting zone-less timestamps does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def floor_div(value: Column, by: int) -> Column:
    """Integer division toward minus infinity, exact over the whole range of ``bigint``."""
    step = F.lit(by).cast("long")
    return F.call_function("div", value - F.pmod(value, step), step)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, rounded toward zero."""
    return (end - start).cast("interval second").cast("long")


def millis_between(start: Column, end: Column) -> Column:
    length = (end - start).cast("interval second").cast("decimal(18,6)")
    return F.call_function("div", (length * MICROS).cast("long"), F.lit(1_000).cast("long"))


def epoch_micros(ts: Column) -> Column:
    return (_since_epoch(ts) * MICROS).cast("long")


def whole_seconds(micros: Column) -> Column:
    return F.call_function("div", micros, F.lit(MICROS).cast("long"))


def _since_epoch(ts: Column) -> Column:
    return (ts - _epoch()).cast("interval second").cast("decimal(18,6)")


def to_instant(ts: Column) -> Column:
    """The wall clock read as UTC: the zoned timestamp that watermarks and event-time windows need."""
    return F.timestamp_micros(epoch_micros(ts))


def to_wall_clock(instant: Column) -> Column:
    """Undoes ``to_instant``."""
    return wall_clock(F.unix_micros(instant))


def wall_clock(micros: Column) -> Column:
    """Undoes ``epoch_micros``."""
    seconds = (micros.cast("decimal(24,0)") / MICROS).cast("decimal(18,6)")
    zero = F.lit(0)
    return _epoch() + F.make_dt_interval(zero, zero, zero, seconds)


def day_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def period_start(period: str, ts: Column) -> Column:
    """First moment of the calendar period (year, quarter, month, week, day) around ``ts``."""
    day = ts.cast("date") if period == "day" else F.trunc(ts.cast("date"), period)
    return day.cast("timestamp_ntz")
