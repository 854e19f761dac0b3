"""Readings that break a rule, and the newest of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import display_time
from ..functions.labels import alert_label
from ..functions.rules import HOT, UPPER, Rule, breaks_rule
from ..schema import sequence_of


def alerts(readings: DataFrame, rules: Sequence[Rule] = UPPER) -> DataFrame:
    """The readings that break one of the rules, unchanged.

    The filter keeps no state, so on a stream late readings alert too, whatever
    the watermark.
    """
    return readings.filter(breaks_rule(rules))


def hot_readings(readings: DataFrame, rules: Sequence[Rule] = HOT) -> DataFrame:
    """Temperature alerts in the short form, works on streams like ``alerts``."""
    return alerts(readings, rules).select(
        "timestamp", "sensor_id", "sensor_type", F.col("value").alias("temperature_value"), "location"
    )


def violations(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """Each reading outside a range of its type, with the range and the side.

    ``rules`` is a rule table. It carries no broadcast hint: its size decides.
    Types without a rule never alert; a type with several rules gives one row for
    each rule broken. Also works with a stream of readings.
    """
    low = F.coalesce(F.col("value") < F.col("lo"), F.lit(False))
    high = F.coalesce(F.col("value") > F.col("hi"), F.lit(False))
    return (
        readings.join(rules, "sensor_type")
        .filter(low | high)
        .withColumn("side", F.when(low, F.lit("low")).otherwise(F.lit("high")))
    )


def newest(rows: DataFrame, count: int = 10, tie_break: Sequence[str] | None = None) -> DataFrame:
    """The ``count`` newest rows, newest first.

    ``tie_break`` orders equal times: the position of landed readings by default, or
    their event_id where they have no position.
    """
    tie_break = sequence_of(rows) if tie_break is None else tie_break
    order = [F.desc("timestamp"), *(F.asc(name) for name in tie_break)]
    return rows.orderBy(*order).limit(count)


def alert_lines(rows: DataFrame) -> DataFrame:
    """Alerts as the dashboard lists them."""
    return rows.select(
        "sensor_id",
        alert_label(F.col("sensor_type")).alias("type"),
        "location",
        display_time(F.col("timestamp")).alias("timestamp"),
    )
