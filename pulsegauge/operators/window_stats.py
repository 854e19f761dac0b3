"""Statistics per sensor type over event-time windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import event_window
from ..functions.labels import health
from ..functions.rules import UPPER, Rule, breaks_rule

WIDTH_S = 30
SLIDE_S = 10
WATERMARK = "2 minutes"

STATS = ["message_count", "avg_value", "max_value", "min_value"]


def window_stats(
    readings: DataFrame, width_s: int = WIDTH_S, slide_s: int | None = None, chained: bool = False
) -> DataFrame:
    """Count, average, maximum and minimum per window and sensor type.

    The same call serves tables and streams; give a stream its watermark first.
    Only one partial row per window and type leaves each task, however uneven the
    types and times are.

    Sliding windows of a table are put together from panes no two windows cut apart:
    readings are grouped once, and only panes are copied into the windows they belong
    to. A stream does so if ``chained``, in two stateful steps, which takes append mode;
    otherwise, for update mode, each reading is copied.
    """
    if slide_s is not None and (chained or not readings.isStreaming):
        parts = panes(readings, math.gcd(width_s, slide_s))
        # A stream's second step takes its time and watermark from the panes' windows.
        return from_panes(parts, "pane" if readings.isStreaming else "start", width_s, slide_s)
    return _flat(
        readings.groupBy(
            event_window("timestamp", width_s, slide_s).alias("window"), "sensor_type"
        ).agg(
            F.count("*").alias("message_count"),
            F.avg("value").alias("avg_value"),
            F.max("value").alias("max_value"),
            F.min("value").alias("min_value"),
        )
    )


def panes(readings: DataFrame, pane_s: int) -> DataFrame:
    """Figures of short windows, which add up to those of longer ones."""
    grouped = readings.groupBy(event_window("timestamp", pane_s).alias("pane"), "sensor_type").agg(
        F.count("*").alias("messages"),
        F.count("value").alias("values"),
        F.sum("value").alias("total"),
        F.max("value").alias("top"),
        F.min("value").alias("bottom"),
    )
    when = "pane" if readings.isStreaming else F.col("pane.start").alias("start")
    return grouped.select(when, "sensor_type", "messages", "values", "total", "top", "bottom")


def from_panes(panes: DataFrame, time: str, width_s: int, slide_s: int | None = None) -> DataFrame:
    """Statistics of windows from the figures of panes that lie in them as a whole."""
    return _flat(
        panes.groupBy(event_window(time, width_s, slide_s).alias("window"), "sensor_type").agg(
            F.sum("messages").alias("message_count"),
            F.try_divide(F.sum("total"), F.sum("values")).alias("avg_value"),
            F.max("top").alias("max_value"),
            F.min("bottom").alias("min_value"),
        )
    )


def _flat(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "sensor_type",
        *STATS,
    )


def health_by_window(
    readings: DataFrame, rules: Sequence[Rule] = UPPER, width_s: int = 3600
) -> DataFrame:
    """Messages, alerts and the health label of each window on its own."""
    return (
        readings.groupBy(event_window("timestamp", width_s).alias("window"))
        .agg(
            F.count("*").alias("total_messages"),
            F.count_if(breaks_rule(rules)).alias("total_alerts"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "total_messages",
            "total_alerts",
            health(F.col("total_alerts")).alias("system_health"),
        )
    )
