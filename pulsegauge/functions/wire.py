"""The record a writer sends for a reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import WIRE_FIELDS
from .clock import wire_time


def record_key(keyed: bool = True) -> Column:
    """The sensor, so that its readings stay in order on one partition, or null."""
    return (F.col("sensor_id") if keyed else F.lit(None)).cast("string").cast("binary")


def record_text() -> Column:
    """The reading as a JSON object with all its fields."""
    fields = [
        wire_time(F.col(name)).alias(name) if name == "timestamp" else F.col(name)
        for name in WIRE_FIELDS
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
