"""Event-time columns and duration arithmetic.

Operators do their time arithmetic on whole microseconds since the epoch. That keeps it exact,
independent of the session zone, and inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """``"1 hour 30 minutes"`` -> 5400000000. Amounts may be negative."""
    words = duration.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for amount, unit in zip(words[::2], words[1::2]):
        name = unit.lower().removesuffix("s")
        if name not in _UNITS:
            raise ValueError(f"unknown unit {unit!r} in {duration!r}")
        total += int(amount) * _UNITS[name]
    return total


def interval(length: int) -> str:
    """Microseconds as text Spark's window and watermark functions accept."""
    return f"{length} microseconds"


def event_time(value: Column, unit: str = "seconds") -> Column:
    """Epoch numbers (seconds, milliseconds, microseconds) or zone-free timestamps -> timestamp."""
    if unit == "seconds":
        return F.timestamp_seconds(value)
    if unit == "milliseconds":
        return F.timestamp_millis(value)
    if unit == "microseconds":
        return F.timestamp_micros(value)
    if unit == "timestamp":
        return value.cast("timestamp")
    raise ValueError(f"unknown unit {unit!r}")


def floor_micros(value: Column, width: int, offset: int = 0) -> Column:
    """Start of the epoch-aligned bucket of ``width`` microseconds holding ``value``."""
    return value - F.pmod(value - F.lit(offset), F.lit(width))


def bucket_start(ts: Column, width: int, offset: int = 0) -> Column:
    return floor_micros(F.unix_micros(ts), width, offset)


def epoch_text(ts: Column) -> Column:
    """``2024-01-01 05:00:00.0``, the text form reports use."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.S")


def next_midnight(ts: Column) -> Column:
    """Start of the following day, when daily counters reset."""
    return F.date_trunc("day", ts) + F.expr("INTERVAL 1 DAY")
