"""Landing a stream of records: each batch read once, several tables written."""

from __future__ import annotations

import functools
import operator
import time
from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.rules import UPPER, Rule, breaks_rule
from ..operators import snapshot
from ..operators.alerts import alerts, newest
from ..operators.parsing import REASONS, bad_records, decode, readings
from ..operators.snapshot import (
    alerts_document,
    metrics_document,
    page_document,
    write_document,
)
from ..schema import LANDED_SCHEMA, PARTIAL_SCHEMA, TYPE_PARTIAL_SCHEMA
from ..sources import files
from . import commits
from .batches import latest_turns, read_turn, stream_id, together, write_batch, write_turn

# Alerts listed on the dashboard.
LISTED = 10
LISTED_SCHEMA = LANDED_SCHEMA[:-3]
# Batches after which the fleet's partials are folded into one.
FOLD_EVERY = 64
# What is added up of each batch, and how.
PARTIALS = {
    "fleet": (PARTIAL_SCHEMA, snapshot.merge_partials),
    "types": (TYPE_PARTIAL_SCHEMA, snapshot.merge_type_partials),
}


def land(
    records: DataFrame,
    root: str,
    checkpoint: str,
    rules: Sequence[Rule] = UPPER,
    documents: str | None = None,
    exact: bool = True,
) -> DataStreamWriter:
    """A stream of records on its way to the tables under ``root``, not yet started.

    ``readings`` and ``alerts`` by date, and ``bad_records``. Beside these each batch
    leaves its own partials in ``fleet``, which ``fleet`` adds up, and the newest alerts
    so far. What a batch writes depends on what it holds; only every ``FOLD_EVERY``-th
    adds up the partials since the last time. The landed tables are never read again.
    A batch shows in all tables at once, when its commit is written, with its counts of
    messages, good readings and bad records by reason; see ``commits``.

    With ``documents`` the dashboard's documents are written there after each batch.
    Unless ``exact``, they tell about how many sensors there are, and what they take
    does not grow with these.
    """

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark)
        # Held for seconds, so packing costs more than it saves. The session is the stream's own.
        spark.conf.set("spark.sql.inMemoryColumnarStorage.compressed", "false")
        decoded = decode(batch).drop("metric_value").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts, lie = _counted(decoded, rules)
            good = readings(decoded)
            found = alerts(good, rules)
            kept = f"{root}/newest_alerts"
            listed = read_turn(spark, kept, stream, batch_id - 1, LISTED_SCHEMA)
            listed = newest(listed.unionByName(found), LISTED)

            def by_batch(rows: DataFrame, name: str, *how) -> None:
                write_batch(rows, f"{root}/{name}", stream, batch_id, *how)

            dated = (False, lie.held, lie.dates)
            bad = sum(counts["bad"].values())
            together(
                spark,
                # Those with the most files first.
                lambda: by_batch(_dated(good), "readings", "event_date", counts["good"], *dated),
                lambda: by_batch(_dated(found), "alerts", "event_date", lie.alerts, *dated),
                lambda: by_batch(bad_records(decoded), "bad_records", None, bad, False, lie.held),
                lambda: by_batch(snapshot.partials(good, rules), "fleet", None, 0, True),
                lambda: by_batch(snapshot.type_partials(good, rules), "types", None, 0, True),
                # Few, and in one task.
                lambda: write_turn(listed, kept, stream, batch_id, True),
            )
        finally:
            decoded.unpersist()
        commits.commit(spark, root, stream, batch_id, counts)
        if batch_id % FOLD_EVERY == FOLD_EVERY - 1:
            fold_fleet(spark, root, stream, batch_id)
        if documents is not None:
            state = fleet(spark, root) if exact else fleet_by_type(spark, root)
            publish(state, newest_alerts(spark, root), documents, batch_id)

    return records.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)


class Lie(NamedTuple):
    """How the rows of a batch lie: alerts, dates its readings span, tasks that hold it."""

    alerts: int
    dates: int
    held: int


def _counted(decoded: DataFrame, rules: Sequence[Rule]) -> tuple[dict[str, object], Lie]:
    """What a batch holds and how, observed in the pass that fills its cache, whole as it
    is, and reads a few columns of it.

    That pass ends in no shuffle, as each of its tasks is then counted once however
    often it runs.
    """
    seen = Observation()
    good = F.col("reason").isNull()
    time_of = F.when(good, F.col("timestamp"))
    place = (F.spark_partition_id() + 1).alias("place")
    observed = decoded.select("reason", "timestamp", "sensor_type", "value", place).observe(
        seen,
        F.count("*").alias("messages"),
        F.count_if(good).alias("good"),
        *(F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS),
        *(
            F.date_format(least(time_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(name)
            for name, least in (("oldest", F.min), ("newest", F.max))
        ),
        F.count_if(good & breaks_rule(rules)).alias("alerts"),
        (F.datediff(F.max(time_of), F.min(time_of)) + 1).alias("dates"),
        F.max("place").alias("held"),
    )
    observed.write.format("noop").mode("overwrite").save()
    found = seen.get
    bad = {reason: found[reason] for reason in REASONS if found[reason]}
    counts = {name: found[name] for name in ("messages", "good", "oldest", "newest")} | {"bad": bad}
    return counts, Lie(found["alerts"], found["dates"] or 0, found["held"] or 0)


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", F.to_date("timestamp"))


def _folds(spark: SparkSession, root: str) -> dict[str, int]:
    """The last fold of each stream that is there as a whole: a row per stream."""
    try:
        done = spark.read.schema("upto long, stream string").parquet(f"{root}/fleet_folded")
    except AnalysisException:  # none yet
        return {}
    latest = done.groupBy("stream").agg(F.max("upto").alias("upto"))
    return {r["stream"]: r["upto"] for r in latest.collect()}


def _parts(spark: SparkSession, root: str, name: str = "fleet") -> DataFrame:
    """Each stream's last fold and the partials of the committed batches after it, not yet added up."""
    schema = T.StructType(
        [
            *PARTIALS[name][0].fields,
            T.StructField("stream", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    at = commits.snapshot(spark, root)
    folds = _folds(spark, root)
    with files.listing(spark):
        parts = spark.read.schema(schema).parquet(f"{root}/{name}").filter(commits.committed(at))
    if folds:
        # On folder names, so that folded batches are not read.
        covered = [(F.col("stream") == s) & (F.col("batch_id") <= n) for s, n in folds.items()]
        parts = parts.filter(~functools.reduce(operator.or_, covered))
        folded = spark.read.schema(schema).parquet(f"{root}/{name}_folds")
        wanted = [(F.col("stream") == s) & (F.col("batch_id") == n) for s, n in folds.items()]
        parts = parts.unionByName(folded.filter(functools.reduce(operator.or_, wanted)))
    return parts


def fold_fleet(spark: SparkSession, root: str, stream: str, batch_id: int) -> None:
    """Add up a stream's partials up to a batch, for readers to start from.

    A fold counts from when it is listed in ``fleet_folded``, after it was written.
    """
    for name, (_, merge) in PARTIALS.items():
        parts = _parts(spark, root, name).filter((F.col("stream") == stream) & (F.col("batch_id") <= batch_id))
        write_batch(merge(parts), f"{root}/{name}_folds", stream, batch_id)
    listed = spark.range(1).select(F.lit(batch_id).cast("long").alias("upto"))
    listed.write.mode("overwrite").parquet(f"{root}/fleet_folded/stream={stream}/batch_id={batch_id}")


def tidy(spark: SparkSession, root: str, keep_s: float = commits.KEEP_S) -> dict[str, int]:
    """Pack and delete what has piled up under ``root``; streams may go on meanwhile.

    Besides ``commits.compact`` and ``commits.vacuum``, partials of the fleet that a fold
    has stood in for since ``keep_s`` go, and all of a stream's folds but the last.
    """
    written = commits.compact(spark, root)
    gone = commits.vacuum(spark, root, keep_s)
    now = time.time() * 1000
    folds: dict[str, list[tuple[int, str]]] = {}
    for entry in files.matching(spark, f"{root}/fleet_folded/stream=*/batch_id=*"):
        if now - entry.modified_ms >= keep_s * 1000:
            stream, batch = entry.path.rsplit("/", 2)[1:]
            folds.setdefault(stream, []).append((int(batch.removeprefix("batch_id=")), entry.path))
    for stream, found in folds.items():
        last = max(found)[0]
        earlier = [path for batch, path in found if batch < last]
        covered = [(f"{name}/{stream}", last) for name in PARTIALS]
        covered += [(f"{name}_folds/{stream}", last - 1) for name in PARTIALS]
        for folder, upto in covered:
            for entry in files.matching(spark, f"{root}/{folder}/batch_id=*"):
                if int(entry.path.rsplit("batch_id=", 1)[1]) <= upto:
                    earlier.append(entry.path)
        # Lists of folds first, so that none names what is gone.
        for path in earlier:
            files.delete(spark, path)
        gone += len(earlier)
    return {**written, "deleted": gone}


def fleet(spark: SparkSession, root: str) -> DataFrame:
    """The partials of all readings landed so far, of all streams."""
    return snapshot.merge_partials(_parts(spark, root))


def fleet_by_type(spark: SparkSession, root: str) -> DataFrame:
    """The type partials of all readings landed so far: a row per type, whatever the fleet."""
    return snapshot.merge_type_partials(_parts(spark, root, "types"))


def newest_alerts(spark: SparkSession, root: str) -> DataFrame:
    """The newest alerts landed so far, newest first."""
    upto = commits.snapshot(spark, root).upto
    return newest(latest_turns(spark, f"{root}/newest_alerts", LISTED_SCHEMA, upto), LISTED)


def publish(parts: DataFrame, listed: DataFrame, documents: str, as_of: int = 0) -> None:
    """Write the dashboard's documents from the state of the fleet."""
    parts = parts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts.count()
        together(
            parts.sparkSession,
            lambda: write_document(metrics_document(parts, listed), f"{documents}/metrics", as_of),
            lambda: write_document(page_document(parts, listed), f"{documents}/page", as_of),
            lambda: write_document(alerts_document(listed), f"{documents}/alerts", as_of),
        )
    finally:
        parts.unpersist()
