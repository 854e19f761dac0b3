"""From messages to typed readings, with the records that are none set aside."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import parse_time
from ..schema import POSITION_FIELDS, WIRE_FIELDS, WIRE_SCHEMA

_CORRUPT = "_corrupt_record"

# What JSON allows around a value.
BLANKS = " \t\r\n"
# Why a record may be none, in the order they are tried.
REASONS = ("empty", "bad_encoding", "bad_json", "bad_value", "bad_timestamp")
# The largest finite number.
MOST = sys.float_info.max


def decode(
    records: DataFrame,
    *,
    fields: Sequence[str] = WIRE_FIELDS,
    time_pattern: str | None = None,
) -> DataFrame:
    """Read the JSON message in ``value`` of each record against the fixed schema.

    The result has one row per record: the message's fields, ``metric_value``,
    the record's position where the input has it, and ``reason``, which is null for
    a good reading. For others ``payload`` is the message as received and reason
    the first of

    ``empty``         no payload, or blank
    ``bad_encoding``  not UTF-8
    ``bad_json``      not a JSON object, a field of the wrong type, or text after it
    ``bad_value``     the value is no finite number
    ``bad_timestamp`` no time, or one that cannot be read

    Of two objects in one message only the first is read. Unknown fields are dropped
    and missing ones are null. ``fields`` narrows what
    is read from the JSON; value and timestamp always are, as reasons need them.
    """
    wanted = [f for f in WIRE_FIELDS if f in {*fields, "value", "timestamp"}]
    message = T.StructType(
        [WIRE_SCHEMA[name] for name in wanted] + [T.StructField(_CORRUPT, T.StringType())]
    )
    position = [name for name in POSITION_FIELDS if name in records.columns]

    payload = F.col("value").cast("binary").alias("payload")
    text = F.try_validate_utf8(F.col("value").cast("string"))
    parsed = F.from_json(text, message, {"columnNameOfCorruptRecord": _CORRUPT})
    # inline() keeps from_json in a step of its own. As a plain struct column it
    # would be copied into every filter on the reason and the JSON parsed again
    # for each copy.
    read = records.select(*position, payload, F.inline(F.array(parsed))).withColumn(
        "timestamp", parse_time(F.col("timestamp"), time_pattern)
    )

    received = F.col("payload").cast("string")
    # NaN is larger than any number in this comparison.
    no_number = F.coalesce(F.abs("value") > MOST, F.lit(False))
    # Most end as they are to, which spares the copy without blanks.
    closed = F.endswith(received, F.lit("}")) | F.endswith(F.rtrim(received, F.lit(BLANKS)), F.lit("}"))
    trailing = ~closed
    # The first test settles it for a good reading.
    reason = (
        F.when(F.col(_CORRUPT).isNull() & F.col("timestamp").isNotNull() & ~no_number & ~trailing, F.lit(None))
        .when(received.isNull() | (F.btrim(received, F.lit(BLANKS)) == ""), F.lit("empty"))
        .when(~F.is_valid_utf8(received), F.lit("bad_encoding"))
        .when(F.col(_CORRUPT).isNotNull() | trailing, F.lit("bad_json"))
        .when(no_number, F.lit("bad_value"))
        .otherwise(F.lit("bad_timestamp"))
    )
    return read.select(
        *wanted,
        F.col("value").cast("double").alias("metric_value"),
        *position,
        F.when(reason.isNotNull(), F.col("payload")).alias("payload"),
        reason.alias("reason"),
    )


def readings(decoded: DataFrame) -> DataFrame:
    """The good rows of ``decode``."""
    return decoded.filter(F.col("reason").isNull()).drop("reason", "payload")


def bad_records(decoded: DataFrame) -> DataFrame:
    """The other rows of ``decode``: payload, reason and position."""
    position = [name for name in POSITION_FIELDS if name in decoded.columns]
    return decoded.filter(F.col("reason").isNotNull()).select("payload", "reason", *position)
