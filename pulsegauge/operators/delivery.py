"""Reports on a delivery log, which has one row per attempt to send a message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import elapsed_seconds, event_window
from ..functions.labels import fixed, grouped, ratio

REPORT_S = 10


def delivery_summary(log: DataFrame) -> DataFrame:
    """One row: counts, success rate, mean latency of successes, throughput.

    Rates are 0 where there is nothing to divide by.
    """
    counts = log.agg(
        F.count_if("ok").alias("messages_sent"),
        F.count_if(~F.col("ok")).alias("messages_failed"),
        F.coalesce(F.avg(F.when(F.col("ok"), F.col("latency_ms"))), F.lit(0.0)).alias(
            "avg_latency_ms"
        ),
        F.min("start_ts").alias("first"),
        F.max("end_ts").alias("last"),
    )
    sent, failed = F.col("messages_sent"), F.col("messages_failed")
    duration = F.coalesce(elapsed_seconds(F.col("first"), F.col("last")), F.lit(0.0))
    per_second = ratio(sent, F.col("duration_s"))
    return counts.withColumn("duration_s", duration).select(
        "messages_sent",
        "messages_failed",
        (100 * ratio(sent, sent + failed)).alias("success_rate"),
        "avg_latency_ms",
        "duration_s",
        per_second.alias("per_second"),
        (per_second * 60).alias("per_minute"),
        (per_second * 3600).alias("per_hour"),
        failed.alias("error_count"),
    )


def delivery_report(summary: DataFrame) -> DataFrame:
    """A summary as text for people."""
    return summary.select(
        grouped(F.col("messages_sent")).alias("messages_sent"),
        grouped(F.col("messages_failed")).alias("messages_failed"),
        F.concat(fixed(F.col("success_rate")), F.lit("%")).alias("success_rate"),
        F.concat(fixed(F.col("duration_s")), F.lit(" seconds")).alias("duration"),
        F.concat(fixed(F.col("avg_latency_ms")), F.lit(" ms")).alias("latency"),
        F.concat(fixed(F.col("per_second")), F.lit(" messages/second")).alias("throughput"),
        F.concat(fixed(F.col("per_second"), 0), F.lit(" msg/s")).alias("per_second"),
        F.concat(fixed(F.col("per_minute"), 0), F.lit(" msg/min")).alias("per_minute"),
        F.concat(fixed(F.col("per_hour"), 0), F.lit(" msg/hr")).alias("per_hour"),
    )


def first_errors(log: DataFrame, count: int = 3) -> DataFrame:
    """The first failed attempts."""
    return log.filter(~F.col("ok")).orderBy("seq").limit(count).select("seq", "error")


def delivery_progress(log: DataFrame, report_s: int = REPORT_S) -> DataFrame:
    """After each interval with attempts: how many so far, and the mean rate.

    Attempts count whether they succeeded or not. Time runs from the first start.
    """
    return progress(intervals(log, report_s))


def intervals(log: DataFrame, report_s: int = REPORT_S) -> DataFrame:
    """The attempts of each interval, and the first of their starts.

    A stream needs a watermark on ``start_ts`` for its intervals to close.
    """
    return (
        log.groupBy(event_window("start_ts", report_s).alias("interval"))
        .agg(F.count("*").alias("attempts"), F.min("start_ts").alias("first"))
        .select(
            F.col("interval.end").alias("report_ts"),
            F.date_trunc("month", "interval.start").alias("month"),
            "attempts",
            "first",
        )
    )


def progress(intervals: DataFrame, sent: int = 0, started: Column | None = None) -> DataFrame:
    """Running totals over intervals, after ``sent`` attempts since ``started``.

    The running total is taken in two steps, over months and then within each, so
    that no task sees more than one month's intervals or one row for each month.
    """
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    months = (
        intervals.groupBy("month")
        .agg(F.sum("attempts").alias("in_month"), F.min("first").alias("first"))
        .select(
            "month",
            (F.sum("in_month").over(so_far) - F.col("in_month")).alias("before"),
            F.min("first").over(so_far).alias("started"),
        )
    )
    in_month = (
        Window.partitionBy("month")
        .orderBy("report_ts")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    same_month = F.col("month") == F.col("of_month")
    messages = F.sum("attempts").over(in_month) + F.col("before") + sent
    earliest = [F.col("started"), F.col("first")] + ([] if started is None else [started])
    return (
        # Asked the same of both times it is used, the grouping into intervals is
        # done once: a left join adds no filter, and the start needs ``first``.
        intervals.join(months.withColumnRenamed("month", "of_month"), same_month, "left")
        .select(
            "report_ts",
            elapsed_seconds(F.least(*earliest), F.col("report_ts")).alias("elapsed_s"),
            messages.alias("messages"),
        )
        .withColumn("rate", ratio(F.col("messages"), F.col("elapsed_s")))
    )
