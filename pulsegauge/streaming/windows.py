"""Window statistics of a stream that lose no reading.

A stateful aggregation forgets a window once the watermark has passed it, and a reading
that comes later still vanishes; Spark only counts it. Here each batch leaves partials of
the windows it touched, which add up, so there is no state to forget. Readings of windows
that had closed before the batch, by the same rule, are set aside with a reason, as are
those without a time. What is in the windows and what is aside are all readings.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.clock import interval_micros
from ..operators.window_stats import WATERMARK, WIDTH_S, from_panes, panes
from ..schema import PANE_SCHEMA
from . import commits
from .batches import stream_id, together, write_batch

LATE, NO_TIME = "late", "no_time"


def keep_window_partials(
    readings: DataFrame, root: str, checkpoint: str, *, width_s: int = WIDTH_S, delay: str = WATERMARK
) -> DataStreamWriter:
    """A stream of readings on its way to ``root/panes`` and ``root/aside``, not yet started.

    A window has closed for a batch if its end is not after the watermark, the newest
    time of the batches before less ``delay``. A batch shows when it is committed, with
    the number of readings set aside.
    """
    held_back = interval_micros(delay)

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark, stream = batch.sparkSession, stream_id(batch.sparkSession)
        passed = commits.committed_counts(spark, root, stream, batch_id - 1)["watermark"] if batch_id else None
        # By hand, as window() leaves rows without a time out.
        width, micros = F.lit(width_s * 1_000_000), F.unix_micros("timestamp")
        end = micros - F.pmod(micros, width) + width
        closed = F.lit(False) if passed is None else end <= passed
        reason = F.when(F.col("timestamp").isNull(), F.lit(NO_TIME)).when(closed, F.lit(LATE))
        sorted_out = batch.withColumn("reason", reason).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = sorted_out.agg(
                F.count("*").alias("messages"),
                F.count_if(F.col("reason").isNull()).alias("good"),
                F.count_if(F.col("reason") == LATE).alias(LATE),
                F.count_if(F.col("reason") == NO_TIME).alias(NO_TIME),
                F.max(F.unix_micros("timestamp")).alias("newest"),
            ).first()
            on_time = sorted_out.filter("reason is null").drop("reason")
            writes = [lambda: write_batch(panes(on_time, width_s), f"{root}/panes", stream, batch_id)]
            if found["good"] < found["messages"]:
                aside = sorted_out.filter("reason is not null")
                writes.append(lambda: write_batch(aside, f"{root}/aside", stream, batch_id))
            together(spark, *writes)
        finally:
            sorted_out.unpersist()
        known = [x for x in (passed, None if found["newest"] is None else found["newest"] - held_back) if x is not None]
        counts = {"messages": found["messages"], "good": found["good"]}
        counts["bad"] = {name: found[name] for name in (LATE, NO_TIME) if found[name]}
        commits.commit(spark, root, stream, batch_id, counts | {"watermark": max(known, default=None)})

    return readings.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)


def _committed(spark: SparkSession, folder: str, root: str, fields: list[T.StructField]) -> DataFrame:
    placed = T.StructType([*fields, T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())])
    return commits.folders(spark, folder, placed).filter(commits.committed(commits.snapshot(spark, root)))


def window_stats_so_far(
    spark: SparkSession, root: str, width_s: int = WIDTH_S, slide_s: int | None = None
) -> DataFrame:
    """Statistics of the windows, of all streams; wider ones too, and sliding by whole partials."""
    return from_panes(_committed(spark, f"{root}/panes", root, PANE_SCHEMA.fields), "start", width_s, slide_s)


def set_aside(spark: SparkSession, root: str, readings: DataFrame) -> DataFrame:
    """The readings that are in no window, with the reason and the batch they came in."""
    reason = T.StructField("reason", T.StringType())
    return _committed(spark, f"{root}/aside", root, [*readings.schema.fields, reason])
