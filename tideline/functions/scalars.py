"""Scalar column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def element(array: Column, position: Column) -> Column:
    """Array element at a zero-based position, NULL when the array is shorter."""
    return F.get(array, position)


def date_of(timestamp: Column) -> Column:
    """Calendar date of a timestamp or ISO text; text that is no date gives NULL."""
    return timestamp.try_cast("date")


def utc_wall_clock(instant: Column) -> Column:
    """UTC wall clock of an instant, whatever zone the session uses."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        secs=F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)
    )


def iso_utc(wall_clock: Column) -> Column:
    """ISO-8601 text of a UTC wall clock with microseconds and offset."""
    text = wall_clock.cast("string")
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(
        F.substring(text, 1, 10),
        F.lit("T"),
        F.substring(text, 12, 8),
        F.lit("."),
        fraction,
        F.lit("+00:00"),
    )


def day_label(wall_clock: Column) -> Column:
    """``YYYY_MM_DD``: underscores keep partition discovery from reading a date."""
    return F.translate(F.substring(wall_clock.cast("string"), 1, 10), "-", "_")
