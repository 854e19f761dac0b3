"""The events table read as sensor telemetry.

Test data has no sensors, so events stand in for them: event types for sensor
types, users for sensors. Every row of the table takes part.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.wire import record_key, record_text
from ..session import working_folder
from . import files
from .kafka import TOPIC
from .tables import stream_parquet

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Event type, then the sensor type and unit it stands for.
SENSORS = (
    ("view", "temperature", "celsius"),
    ("click", "humidity", "percent"),
    ("purchase", "pressure", "hPa"),
    ("signup", "light", "lux"),
    ("error", "motion", "boolean"),
)
LOCATIONS = ("building_a", "building_b", "building_c")
PARTITIONS = 3
THREADS = 16
# Batches of the table as a stream.
BATCHES = 4
ROWS_PER_BATCH = 1_000_000
# A batch's file is read by several tasks where it is larger than a few row groups.
ROW_GROUP_BYTES = 1 << 20
# Scatters delays over ids.
SCATTER = 7919
# The reader's last commit in the offsets binding.
COMMITTED_BEFORE = "2024-01-25 00:00:00"
UNCOMMITTED = 20
UNREAD = 7


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def batches_of(rows: DataFrame, disorder_s: int = 0) -> tuple[Column, int]:
    """The batch a row is of, and how many there are: stretches of time of one length, rows
    without a time in the first.

    There are more the longer the table is. With ``disorder_s`` a row comes up to so many
    seconds after its time, as its id has it.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    known = rows.agg(F.count("*").alias("n"), F.min(micros).alias("low"), F.max(micros).alias("high")).first()
    count = max(BATCHES, -(-known["n"] // ROWS_PER_BATCH))
    if known["low"] is None or known["low"] == known["high"]:
        return F.lit(0), 1
    arrives = micros
    if disorder_s:
        arrives = micros + F.pmod(F.col("event_id") * SCATTER, F.lit(disorder_s)) * 1_000_000
    part = F.floor((arrives - known["low"]) * count / (known["high"] - known["low"]))
    return F.least(F.coalesce(part, F.lit(0)), F.lit(count - 1)).cast("int"), count


@functools.cache
def _prepared(application: str, folder: str, disorder_s: int) -> str:
    """A folder with the events in a file for each batch, written once for a session.

    The events are dealt out in one job. Streams take files in the order of their times,
    which are set afterwards. Row groups are small, as a task reads one at least and a batch
    is worked off by as many tasks as read it. Each batch has a task of its own that writes
    it, so that none has to write several one after the other.
    """
    spark = SparkSession.active()
    rows = events(spark, folder)
    target = working_folder(spark, "batches")
    part, count = batches_of(rows, disorder_s)
    dealt = rows.withColumn("part", part).repartitionById(count, "part")
    dealt.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).partitionBy("part").parquet(target)
    # By number, as there may be more than have the same count of digits.
    written = files.matching(spark, f"{target}/part=*/part-*")
    written.sort(key=lambda entry: int(entry.path.rsplit("part=", 1)[1].split("/")[0]))
    for place, entry in enumerate(written):
        files.set_modified(spark, entry.path, 1_600_000_000_000 + 1000 * place)
    return target


def events_stream(spark: SparkSession, folder: str, disorder_s: int = 0) -> DataFrame:
    """The table as a stream of several batches in the order of time.

    The time can carry a watermark, and nothing is later than ``disorder_s``. Rows
    without a time are in the first batch. A batch is one file, of which few tasks read
    their share, so its rows are dealt out to all cores before anything is done with them.
    """
    target = _prepared(spark.sparkContext.applicationId, folder, disorder_s)
    rows = stream_parquet(spark, f"{target}/part=*", EVENTS_SCHEMA, glob="part-*.parquet", max_files=1)
    dealt = rows.repartition(spark.sparkContext.defaultParallelism, *EVENTS_SCHEMA.fieldNames())
    return dealt.withColumn("ts", F.col("ts").cast("timestamp"))


def _by_event_type(index: int) -> Column:
    chosen = None
    for sensor in SENSORS:
        is_type = F.col("event_type") == sensor[0]
        value = F.lit(sensor[index])
        chosen = F.when(is_type, value) if chosen is None else chosen.when(is_type, value)
    return chosen


def as_readings(rows: DataFrame) -> DataFrame:
    """One reading per event, with the event's id as its sequence number."""
    place = F.element_at(
        F.array(*(F.lit(name) for name in LOCATIONS)),
        (F.pmod("user_id", F.lit(len(LOCATIONS))) + 1).cast("int"),
    )
    pressure = F.col("event_type") == "purchase"
    degraded = F.pmod("event_id", F.lit(4)) == 3
    return rows.select(
        "event_id",
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("sensor_id"),
        _by_event_type(1).alias("sensor_type"),
        place.alias("location"),
        F.when(pressure, F.col("value") + 1000).otherwise(F.col("value")).alias("value"),
        _by_event_type(2).alias("unit"),
        F.col("ts").alias("timestamp"),
        F.when(degraded, F.lit("degraded")).otherwise(F.lit("good")).alias("quality"),
    )


def as_records(rows: DataFrame) -> DataFrame:
    """One record per event as Kafka would deliver it, some in fifty of them odd.

    By ``event_id`` modulo 50, these kinds are bad: 0 broken JSON, 1 null, 2 an array,
    3 a JSON null, 4 blank, 5 the value as text, 6 NaN, 7 not UTF-8, 8 no time, 11 too
    large a number, 12 infinity, 13 a time without a date, 14 text after the object.
    Two are good: 9 has a time without a fraction, 10 a field nobody knows.
    """
    kind, text = F.pmod("event_id", F.lit(50)), F.col("text")
    sent = (
        F.when(kind == 0, "{bad json")
        .when(kind == 1, F.lit(None))
        .when(kind == 2, "[]")
        .when(kind == 3, "null")
        .when(kind == 4, " ")
        .when(kind == 5, F.regexp_replace(text, '"value":([^,]*)', '"value":"$1"'))
        .when(kind == 6, F.regexp_replace(text, '"value":[^,]*', '"value":NaN'))
        .when(kind == 8, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"junk"'))
        .when(kind == 9, F.regexp_replace(text, r"\.[0-9]{6}\"", '"'))
        .when(kind == 10, F.concat(F.lit('{"extra":1,'), F.substr(text, F.lit(2))))
        .when(kind == 11, F.regexp_replace(text, '"value":[^,]*', '"value":1e400'))
        .when(kind == 12, F.regexp_replace(text, '"value":[^,]*', '"value":-Infinity'))
        .when(kind == 13, F.regexp_replace(text, '"timestamp":"[^T]*T', '"timestamp":"'))
        .when(kind == 14, F.concat(text, F.lit(" and more")))
        .otherwise(text)
    )
    mark = F.when(kind == 7, F.unhex(F.lit("FF"))).otherwise(F.lit("").cast("binary"))
    # explode() keeps the text, and then the payload, a value that is there rather
    # than an expression the reader of the records repeats for each use of it.
    return (
        as_readings(rows)
        .select(
            "event_id", "sensor_id", "timestamp", F.explode(F.array(record_text())).alias("text")
        )
        .select(
            record_key().alias("key"),
            F.explode(F.array(F.concat(mark, sent.cast("binary")))).alias("value"),
            F.lit(TOPIC).alias("topic"),
            F.pmod(_user_number(), F.lit(PARTITIONS)).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("timestamp").cast("timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
    )


def _user_number() -> Column:
    return F.substring_index("sensor_id", "_", -1).cast("bigint")


def as_delivery_log(rows: DataFrame) -> DataFrame:
    """One attempt per event; errors are failed ones. An attempt takes its latency."""
    ok = F.col("event_type") != "error"
    taken = F.round(F.col("value") * 1000).cast("int")
    return rows.select(
        F.col("event_id").alias("seq"),
        F.pmod("user_id", F.lit(THREADS)).cast("int").alias("thread"),
        F.col("ts").alias("start_ts"),
        F.timestamp_add("MICROSECOND", taken, F.col("ts")).alias("end_ts"),
        ok.alias("ok"),
        F.when(ok, F.col("value")).alias("latency_ms"),
        F.when(~ok, F.col("props")).alias("error"),
    )


def as_offsets(rows: DataFrame) -> DataFrame:
    """The offsets table of a reader that read all but the newest.

    Events are in the order of their time and each takes the next offset of its
    partition, so offsets are counts. Partition 0 was committed up to a day, 1 nearly
    to the end, 2 never.
    """
    earlier = F.col("ts") < F.lit(COMMITTED_BEFORE).cast("timestamp_ntz")
    partition = F.pmod("user_id", F.lit(PARTITIONS)).cast("int")
    return (
        rows.groupBy(partition.alias("partition"))
        .agg(F.count_if(earlier).alias("earlier"), F.count("*").alias("position"))
        .select(
            F.lit(TOPIC).alias("topic"),
            "partition",
            F.when(F.col("partition") == 0, F.col("earlier"))
            .when(F.col("partition") == 1, F.col("position") - UNCOMMITTED)
            .alias("committed"),
            "position",
            (F.col("position") + UNREAD).alias("latest"),
        )
    )
