"""Time expressions: parsing, printing and event-time windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text form writers use for a reading's time.
WIRE_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# What a time must begin with.
DATED = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def parse_time(text: Column, pattern: str | None = None) -> Column:
    """Text to timestamp, null when it is not one.

    Without a pattern every ISO form with a date is read, with or without a fraction;
    a time alone is none, as it would be another one each day. With one, only text of exactly that form is; ``WIRE_PATTERN`` so refuses whole
    seconds, which some writers print without a fraction.
    """
    if pattern is None:
        return F.when(F.rlike(text, F.lit(DATED)), text.try_cast("timestamp"))
    return F.try_to_timestamp(text, F.lit(pattern))


def wire_time(time: Column) -> Column:
    """A time as writers put it on the wire, always with six digits."""
    return F.date_format(time, WIRE_PATTERN)


def display_time(time: Column) -> Column:
    """A time for people: six digits, or none for a whole second."""
    whole = F.date_trunc("second", time) == time
    return F.when(whole, F.date_format(time, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def event_window(time: Column | str, width_s: int, slide_s: int | None = None) -> Column:
    """Epoch-aligned windows ``[start, end)``; tumbling unless a slide is given."""
    if slide_s is None:
        return F.window(time, f"{width_s} seconds")
    return F.window(time, f"{width_s} seconds", f"{slide_s} seconds")


def interval_micros(text: str) -> int:
    """Microseconds of an interval such as ``2 minutes``."""
    number, unit = text.split()
    seconds = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return round(float(number) * seconds[unit.removesuffix("s")] * 1_000_000)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end, with the fraction."""
    return (
        F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    ) / F.lit(1e6)
