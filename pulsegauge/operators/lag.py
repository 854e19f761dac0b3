"""How far a reader is behind."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import OFFSETS_SCHEMA

HIGH_LAG = 100


def positions(records: DataFrame) -> DataFrame:
    """Per topic and partition the offset after the last record read."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("position"))


def consumer_lag(offsets: DataFrame, high: int = HIGH_LAG) -> DataFrame:
    """Lag of each partition, and whether it is high.

    ``lag`` is position minus commit. Where the table knows the latest offset of
    the topic, ``total_lag`` is that minus commit. Partitions without a commit are
    left out; a commit at 0 counts as one.
    """
    lag = F.col("position") - F.col("committed")
    return offsets.filter(F.col("committed").isNotNull()).select(
        "topic",
        "partition",
        "committed",
        "position",
        lag.alias("lag"),
        (F.col("latest") - F.col("committed")).alias("total_lag"),
        (lag > high).alias("high"),
    )


def high_lag(offsets: DataFrame, high: int = HIGH_LAG) -> DataFrame:
    """The partitions whose lag is high."""
    return consumer_lag(offsets, high).filter("high").drop("high")


def offsets_from_progress(spark: SparkSession, progress: dict) -> DataFrame:
    """The offsets table of a running stream, from its last progress report."""
    return spark.createDataFrame(offset_rows(progress), OFFSETS_SCHEMA)


def offset_rows(progress: dict) -> list[tuple]:
    """Rows of the offsets table from a stream's progress report.

    A report has one entry per topic partition, or one number for a source without
    partitions, which is named by its description. What the batch started from is
    committed, what it reached is the position.
    """
    rows = []
    for source in progress["sources"]:
        start, end, latest = (
            _offsets(source, name) for name in ("startOffset", "endOffset", "latestOffset")
        )
        for topic, partitions in end.items():
            for partition, position in partitions.items():
                rows.append(
                    (
                        topic,
                        int(partition),
                        start.get(topic, {}).get(partition),
                        position,
                        latest.get(topic, {}).get(partition),
                    )
                )
    return rows


def _offsets(source: dict, name: str) -> dict:
    reported = source.get(name)
    if isinstance(reported, str):
        reported = json.loads(reported)
    if isinstance(reported, dict) and all(isinstance(v, dict) for v in reported.values()):
        return reported
    if isinstance(reported, dict):
        reported = next(iter(reported.values()))
    # The last entry read, counted from 0.
    return {} if reported is None else {source.get("description", "source"): {"0": int(reported) + 1}}
