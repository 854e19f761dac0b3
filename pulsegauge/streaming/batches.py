"""Tables written a batch at a time.

Each batch of a stream has folders ``stream=ID/batch_id=N`` of its own. A batch that
runs again after a failure writes the same folders again, so nothing is lost or doubled.
The id is that of the stream's checkpoint: it stays over restarts, and a stream that
starts over with a new checkpoint gets another, so it adds to a table and never writes
over what is there.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run the writes of a batch at the same time; all must succeed.

    They read the same cached rows and each is too small to fill a cluster.
    """
    with ThreadPoolExecutor(len(writes)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in started:
        write.result()


def stream_id(spark: SparkSession) -> str:
    """The id of the stream a batch belongs to. To be asked for in the batch's own thread."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


# Rows of one value, in a batch, that a task writes one after the other.
ROWS_PER_TASK = 200_000
# Values so few that a task may write a file for each.
FEW_VALUES = 10


def write_batch(
    rows: DataFrame,
    table: str,
    stream: str,
    batch_id: int,
    by: str | None = None,
    count: int = 0,
    grouped: bool = False,
    held: int = 0,
    values: int = 1,
) -> None:
    """Write the rows of a batch, in folders by the column ``by`` where given.

    Those are the outer ones, so that a query on few of its values lists few folders.
    With ``count``, how many rows there are, a large batch has its rows counted by value:
    a value with many is written by several tasks, and each of the others by one, as a
    file costs more than its rows where a batch spans hundreds of dates. Rows that come
    out of a grouping, ``grouped``, are together already. So are cached ones that at least
    ``held`` tasks hold, with ``values`` of ``by`` at most, where these are few: tasks
    that write take over what several hold, and nothing is shuffled.
    """
    tasks = max(1, -(-count // ROWS_PER_TASK))
    if grouped:
        placed = rows
    elif held >= tasks and values <= FEW_VALUES:
        placed = rows.coalesce(tasks)
    else:
        slices = _slices(rows, by) if by is not None and count > ROWS_PER_TASK else {}
        placed = gathered(rows, by, slices)
    if by is None:
        placed.write.mode("overwrite").parquet(f"{table}/stream={stream}/batch_id={batch_id}")
        return
    placed = placed.withColumn("stream", F.lit(stream)).withColumn("batch_id", F.lit(batch_id))
    # Replaces the folders it writes to and no others.
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(by, "stream", "batch_id").parquet(table)


def _slices(rows: DataFrame, by: str) -> dict[object, int]:
    """The values with more rows than a task writes, and how many tasks are to write each."""
    large = rows.groupBy(by).agg(F.count("*").alias("n")).filter(F.col("n") > ROWS_PER_TASK)
    return {row[by]: -(-row["n"] // ROWS_PER_TASK) for row in large.collect()}


def gathered(rows: DataFrame, by: str | None = None, slices: Mapping[object, int] | None = None) -> DataFrame:
    """Rows brought together into files of a good size, by a column where given.

    Otherwise every task writes a file, and one for every value of the column. A
    value with many rows still goes to several tasks; that takes adaptive execution,
    and without it the rows stay where they are. The rows of a value in ``slices`` go to
    up to so many tasks whatever their bytes.
    """
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return rows
    if by is None or not slices:
        return rows.hint("rebalance", *([by] if by else []))
    counts = functools.reduce(
        lambda chosen, value: F.when(F.col(by).eqNullSafe(F.lit(value)), F.lit(slices[value])).otherwise(chosen),
        slices,
        F.lit(1),
    )
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(*rows.columns), counts))
    return sliced.hint("rebalance", by, "_slice").drop("_slice")


# What a stream carries from batch to batch is kept in a few folders in turn. A batch
# writes one and leaves the others, so that a batch that runs again finds what the one
# before it left, and a reader finds the newest though older ones are being replaced.
AS_OF = "as_of"
TURNS = 16


def write_turn(rows: DataFrame, table: str, stream: str, batch_id: int, grouped: bool = False) -> None:
    """Keep rows for the next batch; ``grouped`` ones are together already."""
    marked = rows.withColumn(AS_OF, F.lit(batch_id).cast("bigint"))
    turn = f"{table}/stream={stream}/turn={batch_id % TURNS}"
    (marked if grouped else gathered(marked)).write.mode("overwrite").parquet(turn)


def read_turn(
    spark: SparkSession, table: str, stream: str, batch_id: int, schema: T.StructType
) -> DataFrame:
    """What was kept by a batch; nothing before the first one."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table}/stream={stream}/turn={batch_id % TURNS}")


def latest_turns(
    spark: SparkSession, table: str, schema: T.StructType, upto: Mapping[str, int] | None = None
) -> DataFrame:
    """What each stream kept last, or with its batch ``upto`` at the latest."""
    marked = T.StructType(
        [
            *schema.fields,
            T.StructField(AS_OF, T.LongType()),
            T.StructField("stream", T.StringType()),
        ]
    )
    kept = spark.read.schema(marked).option("ignoreMissingFiles", "true").parquet(table)
    if upto is not None:
        within = [(F.col("stream") == s) & (F.col(AS_OF) <= n) for s, n in upto.items()]
        kept = kept.filter(functools.reduce(operator.or_, within, F.lit(False)))
    latest = kept.groupBy("stream").agg(F.max(AS_OF).alias("_latest"))
    joined = kept.join(latest, "stream").filter(F.col(AS_OF) == F.col("_latest"))
    return joined.select(schema.fieldNames())
