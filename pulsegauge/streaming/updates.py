"""Window statistics that change as readings arrive."""

from __future__ import annotations

import functools
import math
import operator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.window_stats import STATS
from .batches import stream_id, write_batch

KEYS = ["window_start", "window_end", "sensor_type"]
# Size of files only; the rows are the same whatever it is.
ROWS_PER_FILE = 1_000_000
UPDATE_SCHEMA = (
    "window_start timestamp, window_end timestamp, sensor_type string, message_count bigint, "
    "avg_value double, max_value double, min_value double, stream string, batch_id bigint"
)


def keep_updates(stats: DataFrame, table: str, checkpoint: str) -> DataStreamWriter:
    """A stream of window statistics in update mode on its way to a table.

    A window's row is written again with each batch that changes it. Nothing is
    replaced: ``latest_stats`` finds the newest row.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        # Every task that keeps state has some of the few rows that changed. Cached,
        # they are counted and brought together without touching the state again.
        changed = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            files = max(1, math.ceil(changed.count() / ROWS_PER_FILE))
            write_batch(changed.repartition(files), table, stream_id(batch.sparkSession), batch_id)
        finally:
            changed.unpersist()

    return (
        stats.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
    )


def latest_stats(spark: SparkSession, table: str, base: str | None = None) -> DataFrame:
    """The newest row of each window and type.

    Of several streams that wrote to the table, each has its own state and rows. With
    ``base``, a folder ``fold_updates`` wrote, batches it covers are not read, so their
    folders may be deleted at any time after.
    """
    return _latest(_updates(spark, table, base)).drop("stream", "batch_id")


def fold_updates(spark: SparkSession, table: str, target: str, base: str | None = None) -> None:
    """Write the newest rows so far into a new folder ``target``, to be a ``base``.

    The last batch of each stream it covers is noted in ``target``, first of all, so
    that what a stream adds meanwhile is read later and not lost.
    """
    rows = _updates(spark, table, base)
    covered = rows.groupBy("stream").agg(F.max("batch_id").alias("upto"))
    covered.write.parquet(f"{target}/covered")
    _latest(_until(rows, _covered(spark, target))).write.parquet(f"{target}/stats")


def _covered(spark: SparkSession, base: str) -> dict[str, int]:
    """A row for each stream that ever wrote to the table."""
    return {r["stream"]: r["upto"] for r in spark.read.parquet(f"{base}/covered").collect()}


def _until(rows: DataFrame, upto: dict[str, int], after: bool = False) -> DataFrame:
    """The batches covered, or all others. On folder names, so others are not read."""
    covered = [(F.col("stream") == s) & (F.col("batch_id") <= n) for s, n in upto.items()]
    known = functools.reduce(operator.or_, covered, F.lit(False))
    return rows.filter(~known if after else known)


def _updates(spark: SparkSession, table: str, base: str | None) -> DataFrame:
    rows = spark.read.schema(UPDATE_SCHEMA).parquet(table)
    if base is None:
        return rows
    later = _until(rows, _covered(spark, base), after=True)
    return later.unionByName(spark.read.schema(UPDATE_SCHEMA).parquet(f"{base}/stats"))


def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS, "stream").agg(
        *(F.max_by(name, "batch_id").alias(name) for name in STATS),
        F.max("batch_id").alias("batch_id"),
    )
