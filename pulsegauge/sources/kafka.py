"""Reading and writing a Kafka topic.

The connector is not part of Spark: submit with
``--packages org.apache.spark:spark-sql-kafka-0-10_<scala>:<spark version>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

TOPIC = "iot-sensors"
# Records of a batch, which are all cached once. A first start on a backlog is many batches.
MAX_PER_TRIGGER = 5_000_000


def read_options(
    servers: str,
    topics: str = TOPIC,
    *,
    starting: str = "latest",
    max_per_trigger: int | None = MAX_PER_TRIGGER,
    group_id: str | None = None,
    lost_data_fails: bool = True,
) -> dict[str, str]:
    """Options of a topic read as a stream.

    ``starting`` counts only for a query's first start; later ones go on from its
    checkpoint. ``max_per_trigger`` bounds a batch, and with it what a batch keeps
    in memory. No group id is set unless one is given, as Spark keeps offsets in
    the checkpoint and makes up an id for each query.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting,
        "failOnDataLoss": str(lost_data_fails).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group_id is not None:
        options["kafka.group.id"] = group_id
    return options


def read_stream(spark: SparkSession, servers: str, topics: str = TOPIC, **options) -> DataFrame:
    """A topic as a stream of records."""
    return (
        spark.readStream.format("kafka").options(**read_options(servers, topics, **options)).load()
    )


def replay_options(
    servers: str, topics: str = TOPIC, *, starting: str = "earliest", ending: str = "latest"
) -> dict[str, str]:
    """Options of a bounded stretch of a topic, read as a table."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting,
        "endingOffsets": ending,
    }


def replay(spark: SparkSession, servers: str, topics: str = TOPIC, **options) -> DataFrame:
    """A bounded stretch of a topic as a table of records."""
    return spark.read.format("kafka").options(**replay_options(servers, topics, **options)).load()


def write_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """Options of a topic written to: all replicas acknowledge, three retries, gzip."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.compression.type": "gzip",
    }


def write(records: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Append a table of encoded records to a topic."""
    records.write.format("kafka").options(**write_options(servers, topic)).save()


def write_stream(
    records: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC
) -> DataStreamWriter:
    """A stream of encoded records on its way to a topic, not yet started."""
    return (
        records.writeStream.format("kafka")
        .options(**write_options(servers, topic))
        .option("checkpointLocation", checkpoint)
    )
