"""From readings to the records a writer sends."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.wire import record_key, record_text


def encode(readings: DataFrame, *, keyed: bool = True) -> DataFrame:
    """``key`` and ``value`` of the record for each reading, both binary."""
    return readings.select(
        record_key(keyed).alias("key"), record_text().cast("binary").alias("value")
    )
