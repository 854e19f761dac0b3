"""Starting, waiting for and stopping streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Fixed value: how often the dashboard's figures are renewed.
REFRESH = "3 seconds"


def triggered(writer: DataStreamWriter, every: str | None = None, once: bool = False):
    """Set when batches run: as soon as there is data, at an interval, or, with
    ``once``, over all there is and then no more."""
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def append_parquet(
    rows: DataFrame, path: str, checkpoint: str, *, name: str | None = None, by: str | None = None
) -> DataStreamWriter:
    """A stream of rows on its way to a Parquet folder, each row once."""
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if by is not None:
        writer = writer.partitionBy(by)
    return writer.queryName(name) if name else writer


def console(
    rows: DataFrame, checkpoint: str, *, mode: str = "append", name: str | None = None
) -> DataStreamWriter:
    """A stream of rows on its way to the driver's output, for a look."""
    writer = (
        rows.writeStream.outputMode(mode)
        .format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
    )
    return writer.queryName(name) if name else writer


def wait_for_any(spark: SparkSession) -> None:
    """Wait until one of the session's queries ends; raise if it failed.

    The others are stopped then, so that none runs on unnoticed.
    """
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()


def finish(query: StreamingQuery) -> None:
    """Work off what has arrived, then stop."""
    query.processAllAvailable()
    query.stop()
