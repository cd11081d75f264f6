"""Time columns. All times are UTC without zone; the session zone must be UTC too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(text: str) -> Column:
    """A time literal without zone."""
    return F.lit(text).cast("timestamp_ntz")


def hour_start(time: Column | str) -> Column:
    """Start of the hour; ``date_trunc`` gives a zoned time, so it is cast back."""
    return F.date_trunc("hour", time).cast("timestamp_ntz")


def shifted(time: Column, hours: int) -> Column:
    return time + F.expr(f"INTERVAL {hours} HOUR")


def epoch_seconds(time: Column) -> Column:
    return F.unix_seconds(time.cast("timestamp"))


def epoch_micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end``, signed."""
    return (F.floor(epoch_seconds(end) / 60) - F.floor(epoch_seconds(start) / 60)).cast("long")


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit("1970-01-01").cast("date"))


def parsed(time: Column, source_tz: str | None = None) -> Column:
    """A time from text or time; what can't be parsed is null; local times of ``source_tz`` become UTC."""
    got = F.try_to_timestamp(time.cast("string"))
    return (F.to_utc_timestamp(got, source_tz) if source_tz else got).cast("timestamp_ntz")
