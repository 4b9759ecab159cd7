"""Bounds of a user-given time window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def window_bound(text: Column, is_end: bool = False) -> Column:
    """``YYYY-MM-DD`` (the whole day when it is the end) or a full timestamp; else NULL."""
    trimmed = F.trim(text)
    day = F.try_to_timestamp(trimmed, F.lit("yyyy-MM-dd"))
    if is_end:
        day = day + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    moment = F.try_to_timestamp(trimmed, F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(day, moment).cast("timestamp_ntz")


def has_window(start: Column, end: Column) -> Column:
    """Both bounds are known and the end is later."""
    return F.coalesce(end > start, F.lit(False))


def clock_seconds(moment: Column) -> Column:
    """Seconds since 1970-01-01 00:00:00 on the same clock, with fractions.

    Unlike a cast to ``timestamp`` this knows no time zone, so the difference of two
    timestamps without zone is never an hour off.
    """
    seconds = F.extract(F.lit("SECOND"), moment).cast("double")
    whole = (
        F.unix_date(F.to_date(moment)) * F.lit(86_400).cast("bigint")
        + F.hour(moment) * 3600 + F.minute(moment) * 60
    )
    return whole + seconds


def elapsed_seconds(start: Column, end: Column, with_zone: bool = False) -> Column:
    """Seconds between two timestamps of one type, with fractions."""
    if with_zone:
        return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000.0)
    # to the microsecond, which removes the error of subtracting two large doubles
    return F.round(clock_seconds(end) - clock_seconds(start), 6)
