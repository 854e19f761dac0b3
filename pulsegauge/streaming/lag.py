"""The lag of running streams, batch by batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.lag import offset_rows
from ..schema import OFFSETS_SCHEMA
from ..sources import files


class LagLog(StreamingQueryListener):
    """Leaves the offsets of each batch of the session's streams in a folder.

    Register it with ``spark.streams.addListener``; ``offsets_over_batches`` reads what
    it left. A report that comes again for a batch replaces the one before.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        rows = offset_rows(report)
        if rows:
            names = OFFSETS_SCHEMA.fieldNames()
            lines = "\n".join(json.dumps(dict(zip(names, row)) | {"at": report["timestamp"]}) for row in rows)
            place = f"stream={report['id']}/batch_id={report['batchId']}"
            files.create(self.spark, f"{self.folder}/{place}/offsets.json", lines)


def offsets_over_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The offsets table with the stream, the batch and the time of each report."""
    schema = T.StructType(
        [
            *OFFSETS_SCHEMA.fields,
            T.StructField("at", T.TimestampType()),
            T.StructField("stream", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)
