"""A report on a delivery log as it grows."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.delivery import REPORT_S, intervals, progress
from ..schema import PROGRESS_SCHEMA
from . import commits
from .batches import stream_id, write_batch


def keep_delivery_progress(
    log: DataFrame, root: str, checkpoint: str, report_s: int = REPORT_S
) -> DataStreamWriter:
    """A stream of attempts on its way to ``root/progress``, not yet started.

    ``log`` has a watermark on ``start_ts``. Attempts are counted by interval in Spark's
    state, and an interval that closes goes on to the running total. Intervals close in
    order, so that carries two numbers from batch to batch, in the batch's commit.
    """

    def report(batch: DataFrame, batch_id: int) -> None:
        spark, stream = batch.sparkSession, stream_id(batch.sparkSession)
        closed = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = closed.agg(
                F.coalesce(F.sum("attempts"), F.lit(0)).alias("n"), F.min(F.unix_micros("first")).alias("first")
            ).first()
            before = commits.committed_counts(spark, root, stream, batch_id - 1) if batch_id else {}
            sent, started = before.get("total", 0), before.get("started")
            reported = progress(closed, sent, None if started is None else F.timestamp_micros(F.lit(started)))
            write_batch(reported, f"{root}/progress", stream, batch_id)
        finally:
            closed.unpersist()
        known = [x for x in (started, found["first"]) if x is not None]
        counts = {"messages": found["n"], "good": found["n"], "bad": {}}
        carried = {"total": sent + found["n"], "started": min(known, default=None)}
        commits.commit(spark, root, stream, batch_id, counts | carried)

    return (
        intervals(log, report_s)
        .writeStream.outputMode("append")
        .foreachBatch(report)
        .option("checkpointLocation", checkpoint)
    )


def progress_so_far(spark: SparkSession, root: str) -> DataFrame:
    """The report of each stream's closed intervals."""
    placed = T.StructType(
        [*PROGRESS_SCHEMA.fields, T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())]
    )
    at = commits.snapshot(spark, root)
    return commits.folders(spark, f"{root}/progress", placed).filter(commits.committed(at)).drop("batch_id")
