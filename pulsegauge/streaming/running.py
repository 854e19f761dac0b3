"""Running statistics on a stream.

A batch is worked off like a table, so one type with most of the readings is
spread over the cluster here too. Between batches only the last readings of each
type are kept, in a table of their own.

Readings arrive out of order. With a ``delay`` they are held back until the watermark,
the newest time so far less the delay, has passed them, and are then released in the
order of their times. What is released comes after all that was released before, so the
result is that of the whole table in order, whatever the batches were. Readings that
arrive behind the watermark of the batch before are set aside in ``late``: the readings
after them have been given their statistics already.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.clock import interval_micros
from ..operators.running import HISTORY, MIN_ROWS, ROWS_PER_SLICE, last_rows, running_stats
from ..schema import sequence_of
from . import commits
from .batches import latest_turns, read_turn, stream_id, together, write_batch, write_turn

LATE = "late"


def keep_running_stats(
    readings: DataFrame,
    root: str,
    checkpoint: str,
    *,
    key: str = "sensor_type",
    order_by: Sequence[str] | None = None,
    history: int = HISTORY,
    min_rows: int = MIN_ROWS,
    slices: int | None = None,
    delay: str | None = None,
) -> DataStreamWriter:
    """A stream of readings on its way to ``root/stats``, not yet started.

    With ``delay``, as in ``2 minutes``, readings are put in the order of ``order_by``,
    a time first; ``provisional_stats`` has those that are still held back. One
    without a time comes before all others, so it is late in all batches but the first.
    Without a delay readings are put in order within a batch only, a batch as a whole
    follows the ones before it, and a late reading counts when it arrives.

    The last readings are in ``root/recent`` and those held back in ``root/pending``. A
    batch shows in ``stats`` and ``late`` when it is committed. A stream with a new
    checkpoint starts without any.
    """
    order_by = ["timestamp", *sequence_of(readings)] if order_by is None else list(order_by)
    arrival = ["arrived", *order_by]
    held_back = None if delay is None else interval_micros(delay)

    def work_off(batch: DataFrame, batch_id: int) -> None:
        spark, stream = batch.sparkSession, stream_id(batch.sparkSession)
        fresh = (
            batch.filter(F.col("value").isNotNull())
            .select(key, F.lit(batch_id).cast("bigint").alias("arrived"), *order_by, "value")
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        try:
            passed = None if held_back is None else _watermark(spark, root, stream, batch_id - 1)
            behind = _behind(order_by[0], passed) if passed is not None else F.lit(False)
            found = fresh.agg(
                F.count("*").alias("n"), F.count_if(behind).alias("late"), F.max(_micros(fresh, order_by)).alias("newest")
            ).first()
            kept = read_turn(spark, f"{root}/recent", stream, batch_id - 1, fresh.schema)
            if held_back is None:
                released, watermark, count = fresh, None, found["n"]
            else:
                watermark = _later(passed, found["newest"], held_back)
                waiting = read_turn(spark, f"{root}/pending", stream, batch_id - 1, fresh.schema)
                held = waiting.unionByName(fresh.filter(~behind)).withColumn("arrived", F.lit(batch_id).cast("bigint"))
                held = held.persist(StorageLevel.MEMORY_AND_DISK)
                count = held.count()
                released = held.filter(_behind(order_by[0], watermark))
                held_still = held.filter(~_behind(order_by[0], watermark))
            known = kept.unionByName(released)
            stats = running_stats(
                known,
                key=key,
                order_by=arrival,
                history=history,
                min_rows=min_rows,
                slices=slices if slices is not None else math.ceil(count / ROWS_PER_SLICE),
            )
            new = stats.filter(F.col("arrived") == batch_id).drop("arrived")
            writes = [
                lambda: write_batch(new, f"{root}/stats", stream, batch_id),
                lambda: write_turn(last_rows(known, key, arrival, history), f"{root}/recent", stream, batch_id),
            ]
            if held_back is not None:
                writes.append(lambda: write_turn(held_still, f"{root}/pending", stream, batch_id))
            if found["late"]:
                writes.append(
                    lambda: write_batch(fresh.filter(behind).drop("arrived"), f"{root}/{LATE}", stream, batch_id)
                )
            together(spark, *writes)
        finally:
            fresh.unpersist()
            if held_back is not None:
                held.unpersist()
        counts = {"messages": found["n"], "good": found["n"] - found["late"], "bad": {LATE: found["late"]}}
        commits.commit(spark, root, stream, batch_id, counts | {"watermark": watermark})

    return readings.writeStream.foreachBatch(work_off).option("checkpointLocation", checkpoint)


def _micros(rows: DataFrame, order_by: Sequence[str]) -> Column:
    """The time rows are in the order of; null where that is none."""
    kind = dict(rows.dtypes)[order_by[0]]
    return F.unix_micros(F.col(order_by[0]).cast("timestamp")) if kind.startswith("timestamp") else F.lit(None).cast("long")


def _behind(time: str, watermark: int | None) -> Column:
    """Whether the watermark has passed a row. One without a time lies before all others."""
    passed = F.lit(False) if watermark is None else F.unix_micros(F.col(time).cast("timestamp")) <= watermark
    return F.coalesce(passed, F.lit(True)) if watermark is not None else F.col(time).isNull()


def _later(passed: int | None, newest: int | None, delay: int) -> int | None:
    known = [x for x in (passed, None if newest is None else newest - delay) if x is not None]
    return max(known, default=None)


def _watermark(spark: SparkSession, root: str, stream: str, batch_id: int) -> int | None:
    """The watermark after a batch. Without any time by then, one before all times."""
    if batch_id < 0:
        return None
    found = commits.committed_counts(spark, root, stream, batch_id)["watermark"]
    return -(1 << 62) if found is None else found


def _table(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    at = commits.snapshot(spark, root)
    placed = T.StructType([*schema.fields, T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())])
    found = commits.folders(spark, f"{root}/{name}", placed).filter(commits.committed(at))
    return found.select(schema.fieldNames())


def stats_table(spark: SparkSession, root: str, readings: DataFrame, **options) -> DataFrame:
    """The statistics so far, of all streams; ``readings`` and options as they were kept with."""
    shape = _shape(readings, options)
    return _table(spark, root, "stats", running_stats(shape, slices=1, **options).schema)


def late_readings(spark: SparkSession, root: str, readings: DataFrame, **options) -> DataFrame:
    """Readings that came behind the watermark and have no statistics."""
    return _table(spark, root, LATE, _shape(readings, options).schema)


def provisional_stats(spark: SparkSession, root: str, readings: DataFrame, **options) -> DataFrame:
    """Statistics of the readings held back, as if no other came; of all streams."""
    shape = _shape(readings, options)
    order_by = [c for c in shape.columns if c not in (options.get("key", "sensor_type"), "value")]
    kept = T.StructType([T.StructField("arrived", T.LongType()), *shape.schema.fields])
    at = commits.snapshot(spark, root)
    out = None
    for stream in at.upto:
        upto = {stream: at.upto[stream]}
        recent = latest_turns(spark, f"{root}/recent", kept, upto).withColumn("arrived", F.lit(0))
        pending = latest_turns(spark, f"{root}/pending", kept, upto).withColumn("arrived", F.lit(1))
        stats = running_stats(recent.unionByName(pending), order_by=["arrived", *order_by], **options)
        stats = stats.filter("arrived = 1").drop("arrived")
        out = stats if out is None else out.unionByName(stats)
    if out is None:
        return spark.createDataFrame([], running_stats(shape, slices=1, **options).schema)
    return out


def _shape(readings: DataFrame, options: dict) -> DataFrame:
    """No rows, with the columns that are kept."""
    order_by = options.get("order_by") or ["timestamp", *sequence_of(readings)]
    columns = [options.get("key", "sensor_type"), *order_by, "value"]
    fields = {f.name: f for f in readings.schema.fields}
    return readings.sparkSession.createDataFrame([], T.StructType([fields[c] for c in columns]))
