"""Labels shown on reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# More alerts than this give the label.
CRITICAL_ABOVE = 10
WARNING_ABOVE = 5

MISSING = "N/A"


def health(alerts: Column) -> Column:
    """System health from a number of alerts."""
    return (
        F.when(alerts > CRITICAL_ABOVE, F.lit("Critical"))
        .when(alerts > WARNING_ABOVE, F.lit("Warning"))
        .otherwise(F.lit("Good"))
    )


def alert_label(sensor_type: Column) -> Column:
    """The name of an upper-bound alert, as in HIGH_TEMPERATURE."""
    return F.concat(F.lit("HIGH_"), F.upper(sensor_type))


def or_missing(number: Column) -> Column:
    """A number as text, N/A when there is none. Zero is a number."""
    return F.coalesce(number.cast("string"), F.lit(MISSING))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when the whole is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def numbered_sensor(number: Column) -> Column:
    """A sensor's name from its number, as in SENSOR-007."""
    return F.format_string("SENSOR-%03d", number)


def status_key(label: Column) -> Column:
    """The form of a health label that style sheets use."""
    return F.lower(label)


def fixed(number: Column, digits: int = 2) -> Column:
    """A number as text with so many decimals."""
    return F.format_string(f"%.{digits}f", number)


def grouped(count: Column) -> Column:
    """A whole number as text with its thousands set apart, as in 99,990."""
    return F.format_number(count, 0)
