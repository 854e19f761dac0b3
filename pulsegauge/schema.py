"""Schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# One sensor message as it appears on the wire. Every field may be missing.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("quality", T.StringType()),
    ]
)

WIRE_FIELDS = WIRE_SCHEMA.fieldNames()

# Where a record came from; carried along so that bad records can be found
# again and so that equal timestamps still have a fixed order.
POSITION_FIELDS = ["topic", "partition", "offset"]



def sequence_of(rows: DataFrame) -> list[str]:
    """The columns that tell readings of one time apart."""
    return POSITION_FIELDS if set(POSITION_FIELDS) <= set(rows.columns) else ["event_id"]


# A record as the Kafka source delivers it.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Landed readings: the typed message, its position, and the partition columns
# of the table folder.
LANDED_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("quality", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

BAD_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.BinaryType()),
        T.StructField("reason", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Figures of the readings of one type in a short window, which add up.
PANE_SCHEMA = T.StructType(
    [
        T.StructField("start", T.TimestampType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("messages", T.LongType()),
        T.StructField("values", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("top", T.DoubleType()),
        T.StructField("bottom", T.DoubleType()),
    ]
)

# After an interval of a delivery log: attempts so far.
PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("report_ts", T.TimestampType()),
        T.StructField("elapsed_s", T.DoubleType()),
        T.StructField("messages", T.LongType()),
        T.StructField("rate", T.DoubleType()),
    ]
)

# What a batch held, written when all of it is there.
COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("messages", T.LongType()),
        T.StructField("good", T.LongType()),
        T.StructField("bad", T.MapType(T.StringType(), T.LongType())),
        T.StructField("oldest", T.TimestampType()),
        T.StructField("newest", T.TimestampType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Figures of the readings of one sensor and type, which add up.
PARTIAL_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("messages", T.LongType()),
        T.StructField("alerts", T.LongType()),
        T.StructField("values", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("top", T.DoubleType()),
        T.StructField("bottom", T.DoubleType()),
    ]
)

# The same for one type, with a sketch of its sensors.
TYPE_PARTIAL_SCHEMA = T.StructType(
    [*PARTIAL_SCHEMA.fields[1:], T.StructField("sensors", T.BinaryType())]
)

# A null bound leaves that side open.
RULE_SCHEMA = T.StructType(
    [
        T.StructField("rule_set", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()),
    ]
)

# One row per attempt to send a message.
DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("thread", T.IntegerType()),
        T.StructField("start_ts", T.TimestampType()),
        T.StructField("end_ts", T.TimestampType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)

# How far a reader is on each partition.
OFFSETS_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("committed", T.LongType()),
        T.StructField("position", T.LongType()),
        T.StructField("latest", T.LongType()),
    ]
)
