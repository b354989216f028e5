"""Time and place expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def utc(ts: Column) -> Column:
    """The timestamp whose fields in the session's zone are those of ``ts`` in UTC; for formatting only."""
    return F.to_utc_timestamp(ts.cast("timestamp"), F.current_timezone())


def floor_to_interval(ts: Column, minutes: Column | int) -> Column:
    """Start of the interval a timestamp falls in, counted from midnight UTC; null for interval 0."""
    step = minutes if isinstance(minutes, Column) else F.lit(minutes)
    minute = F.floor(F.unix_seconds(ts.cast("timestamp")) / 60)
    of_day = F.pmod(minute, F.lit(1440))
    floored = F.floor(F.try_divide(of_day, F.nullif(step, F.lit(0)))) * step
    return F.timestamp_seconds((minute - of_day + floored) * 60)


def iso_text(ts: Column) -> Column:
    """Timestamp as ``2024-01-31T10:05:00Z``, in UTC whatever the session's zone."""
    return F.date_format(utc(ts), ISO_SECONDS)


def in_window(ts: Column, run_ts: Column, window_days: int = 7) -> Column:
    """True inside the look-back window that ends at ``run_ts``."""
    return (ts >= run_ts - F.make_dt_interval(days=F.lit(window_days))) & (ts <= run_ts)


def zone_to_region(location: Column) -> Column:
    """``us-central1-a`` becomes ``us-central1``; anything else is kept."""
    dashes = F.length(location) - F.length(F.replace(location, F.lit("-")))
    return F.when(dashes == 2, F.substring_index(location, "-", 2)).otherwise(location)
