"""The events as a stream: what a batch is worked off by."""

from pyspark.sql import functions as F

from pulsegauge.sources import events


def test_a_batch_is_read_by_several_tasks(spark, tmp_path):
    """The file of a large batch has many row groups, and all its rows come once."""
    import pyarrow.parquet as pq

    rows = spark.range(0, 1_200_000, 1, 2).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.rand(1).alias("value"),
        F.lit("{}").alias("props"),
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    target = events._prepared(spark.sparkContext.applicationId, str(tmp_path), 0)
    files = [f.removeprefix("file:") for f in spark.read.parquet(target).inputFiles()]
    held = [pq.ParquetFile(f).metadata for f in files]
    assert len(held) == events.BATCHES and sum(m.num_rows for m in held) == 1_200_000
    assert all(m.num_row_groups >= 4 for m in held)


def _few(spark, folder, count):
    rows = spark.range(0, count, 1, 1).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.pmod("id", F.lit(7)).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.lit("{}").alias("props"),
    )
    rows.write.parquet(f"{folder}/events.parquet")


def test_a_batch_is_worked_off_by_all_cores(spark, tmp_path):
    """However small its file is, and each row comes once."""
    _few(spark, tmp_path, 4000)
    tasks, ids = [], []

    def seen(batch, batch_id):
        found = batch.select("event_id", F.spark_partition_id().alias("task")).collect()
        tasks.append({row["task"] for row in found})
        ids.extend(row["event_id"] for row in found)

    stream = events.events_stream(spark, str(tmp_path)).writeStream.foreachBatch(seen)
    stream.option("checkpointLocation", f"{tmp_path}/kept").trigger(availableNow=True).start().awaitTermination()
    assert sorted(ids) == list(range(4000))
    assert [len(t) for t in tasks] == [spark.sparkContext.defaultParallelism] * events.BATCHES


def test_batches_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A file for each batch, and no task has to write half of them."""
    monkeypatch.setattr(events, "BATCHES", 12)
    _few(spark, tmp_path, 1200)
    target = events._prepared(spark.sparkContext.applicationId, str(tmp_path), 0)
    names = [f.rsplit("/", 1)[1] for f in spark.read.parquet(target).inputFiles()]
    assert len(names) == 12
    assert len({name.split("-")[1] for name in names}) >= 8


def test_each_batch_has_a_task_that_writes_it(spark, tmp_path, monkeypatch):
    """And no task writes two, as some did where batches were dealt out by a hash."""
    monkeypatch.setattr(events, "BATCHES", 40)
    _few(spark, tmp_path, 4000)
    target = events._prepared(spark.sparkContext.applicationId, str(tmp_path), 0)
    written = spark.read.parquet(target)
    names = [f.rsplit("/", 1)[1] for f in written.inputFiles()]
    assert len(names) == len({name.split("-")[1] for name in names}) == 40
    assert written.count() == written.select("event_id").distinct().count() == 4000
