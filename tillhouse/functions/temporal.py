"""Durations, time of day and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DURATION = "decimal(18,8)"
DAY_SECONDS = 86400


def _elapsed(start: Column | str, end: Column | str, unit_micros: float) -> Column:
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(unit_micros)).cast(DURATION)


def hours_elapsed(start: Column | str, end: Column | str) -> Column:
    return _elapsed(start, end, 3.6e9)


def days_elapsed(start: Column | str, end: Column | str) -> Column:
    return _elapsed(start, end, 8.64e10)


def within(start: str, end: str, hours: int) -> Column:
    """Both moments known and at most `hours` apart."""
    return (
        F.col(start).isNotNull()
        & F.col(end).isNotNull()
        & (F.col(end) <= F.col(start) + F.expr(f"interval {hours} hours"))
    )


def clock_seconds(value: Column | str, is_text: bool = False) -> Column:
    """Seconds since midnight, from a timestamp or from 'HH:mm[:ss]' text."""
    value = F.col(value) if isinstance(value, str) else value
    if not is_text:
        return (F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)).cast("int")
    seconds = F.when(F.length(value) >= 8, F.substring(value, 7, 2).cast("int")).otherwise(F.lit(0))
    return F.substring(value, 1, 2).cast("int") * 3600 + F.substring(value, 4, 2).cast("int") * 60 + seconds


def shift_hours(start: Column, end: Column) -> Column:
    """Length of a shift given as seconds of day; an end not after the start is on the next day."""
    wrap = F.when(end <= start, F.lit(DAY_SECONDS)).otherwise(F.lit(0))
    return ((end - start + wrap) / F.lit(3600.0)).cast("decimal(18,2)")


def week_start(day: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(F.col(day) if isinstance(day, str) else day, "week")
