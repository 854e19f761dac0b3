"""Files as tables and streams, and the tables landing leaves behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..streaming.commits import Snapshot, read, snapshot



def stream_parquet(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    glob: str = "*.parquet",
    max_files: int | None = None,
) -> DataFrame:
    """The Parquet files of a folder, also those still to come, as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(folder)


def stored(rows: DataFrame, path: str) -> DataFrame:
    """Rows written to a new folder and read back from there.

    For a small result several others are made from: what it took to get it is
    done once, and not again if an executor is lost.
    """
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def landed_readings(spark: SparkSession, root: str, at: Snapshot | None = None) -> DataFrame:
    """All readings landed under ``root``. Filter on event_date to read fewer."""
    return read(spark, root, "readings", at)


def landed_alerts(spark: SparkSession, root: str, at: Snapshot | None = None) -> DataFrame:
    """All alerts landed under ``root``."""
    return read(spark, root, "alerts", at)


def landed_bad_records(spark: SparkSession, root: str, at: Snapshot | None = None) -> DataFrame:
    """All records set aside under ``root``."""
    return read(spark, root, "bad_records", at)


def register_views(spark: SparkSession, root: str) -> None:
    """Name the landed tables ``live_sensors`` and ``live_alerts`` for SQL.

    Both show what is committed when they are made; call again to see more.
    """
    at = snapshot(spark, root)
    landed_readings(spark, root, at).createOrReplaceTempView("live_sensors")
    landed_alerts(spark, root, at).createOrReplaceTempView("live_alerts")
