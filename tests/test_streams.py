"""Streams over several batches: late rows, restarts, batches that run again."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pulsegauge.operators import snapshot
from pulsegauge.operators.alerts import alerts, hot_readings, newest, violations
from pulsegauge.functions.rules import RANGE, rule_table
from pulsegauge.operators.running import running_stats
from pulsegauge.operators.window_stats import WATERMARK, window_stats
from pulsegauge.session import working_folder
from pulsegauge.sources import kafka, tables
from pulsegauge.streaming import batches, landing, queries, updates
from pulsegauge.streaming.running import keep_running_stats

from .test_running import by_list, collected, sample_rows

START = datetime(2024, 1, 1)
READINGS = (
    "event_id bigint, sensor_id string, sensor_type string, location string, value double, "
    "timestamp timestamp"
)
RECORDS = "value string, topic string, partition int, offset bigint"


class Feed:
    """A folder of JSON files read as a stream, a file to a batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.files = spark, folder / "feed", schema, 0
        self.folder.mkdir()

    def add(self, rows):
        names = [part.split()[0] for part in self.schema.split(", ")]
        lines = [
            json.dumps({n: v.isoformat() if isinstance(v, datetime) else v for n, v in zip(names, row)})
            for row in rows
        ]
        path = self.folder / f"{self.files:03d}.json"
        path.write_text("\n".join(lines))
        # Files are taken in the order of their times, which are whole seconds.
        os.utime(path, (1_700_000_000 + self.files,) * 2)
        self.files += 1

    def stream(self):
        return (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", "1")
            .json(str(self.folder))
        )


def run(writer):
    query = queries.triggered(writer, once=True).start()
    query.awaitTermination()
    return query


def at(seconds):
    return START + timedelta(seconds=seconds)


def reading(seconds, value, kind="temperature", event_id=0):
    return (event_id, "s", kind, "lab", value, at(seconds))


LATE = [
    [reading(5, 36.0)],
    [reading(600, 37.0)],
    [reading(6, 39.0), reading(540, 38.0), (9, "s", "temperature", "lab", 50.0, None)],
]


@pytest.fixture
def late_feed(spark, tmp_path):
    return Feed(spark, tmp_path, READINGS)


def run_late(feed, writer):
    """Add each file once the one before is done with, watermark and all."""
    query = writer.start()
    for rows in LATE:
        feed.add(rows)
        query.processAllAvailable()
    query.stop()
    return query


def test_update_mode_drops_rows_of_windows_long_closed(spark, late_feed, tmp_path):
    stream = late_feed.stream().withWatermark("timestamp", WATERMARK)
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    query = run_late(late_feed, updates.keep_updates(window_stats(stream), table, checkpoint))
    found = {r["window_start"]: r["message_count"] for r in updates.latest_stats(spark, table).collect()}
    assert found == {at(0): 1, at(600): 1, at(540): 1}
    dropped = [
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    ]
    assert sum(dropped) == 1


def test_append_mode_gives_only_closed_windows(spark, late_feed, tmp_path):
    stream = late_feed.stream().withWatermark("timestamp", WATERMARK)
    table = str(tmp_path / "t")
    run_late(
        late_feed, queries.append_parquet(window_stats(stream), table, str(tmp_path / "c"))
    )
    assert [r["window_start"] for r in spark.read.parquet(table).collect()] == [at(0)]


def test_alerts_keep_late_rows(spark, late_feed, tmp_path):
    stream = late_feed.stream().withWatermark("timestamp", WATERMARK)
    table = str(tmp_path / "t")
    run_late(
        late_feed, queries.append_parquet(hot_readings(stream), table, str(tmp_path / "c"))
    )
    values = sorted(r["temperature_value"] for r in spark.read.parquet(table).collect())
    assert values == [36.0, 37.0, 38.0, 39.0, 50.0]


def test_updates_over_batches_and_a_restart(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    table, checkpoint, base = (str(tmp_path / n) for n in ("t", "c", "base"))
    rows = [reading(s, float(s)) for s in (1, 2, 31, 3, 32, 33)]

    def step():
        stream = feed.stream().withWatermark("timestamp", WATERMARK)
        run(updates.keep_updates(window_stats(stream), table, checkpoint))

    feed.add(rows[:2])
    feed.add(rows[2:4])
    step()
    updates.fold_updates(spark, table, base)
    feed.add(rows[4:])
    step()
    batch = window_stats(spark.createDataFrame(rows, READINGS))
    for known in (None, base):
        latest = updates.latest_stats(spark, table, known)
        assert latest.columns == batch.columns
        assert sorted(map(str, latest.collect())) == sorted(map(str, batch.collect()))


def test_sliding_windows_on_a_stream_match_the_table(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    rows = [reading(s, float(s % 7)) for s in range(0, 100, 3)]
    feed.add(rows[:20])
    feed.add(rows[20:])
    table = str(tmp_path / "t")
    stream = feed.stream().withWatermark("timestamp", WATERMARK)
    run(updates.keep_updates(window_stats(stream, 30, 10), table, str(tmp_path / "c")))
    batch = window_stats(spark.createDataFrame(rows, READINGS), 30, 10)
    shape = lambda df: sorted(
        str(r) for r in df.withColumn("avg_value", F.round("avg_value", 6)).collect()
    )
    assert shape(updates.latest_stats(spark, table)) == shape(batch)


def message(i, value, seconds):
    kind = ("temperature", "humidity", "light")[i % 3]
    return json.dumps(
        {"sensor_id": f"s{i % 4}", "sensor_type": kind, "location": "lab", "value": value,
         "unit": "u", "timestamp": at(seconds).isoformat(), "quality": "good"}
    )


def record(i):
    text = "{bad" if i % 10 == 9 else message(i, 25.0 + i, i * 7200)
    return (text, "iot-sensors", i % 3, i)


def test_landing_over_batches_restart_and_replay(spark, tmp_path):
    feed = Feed(spark, tmp_path, RECORDS)
    root, checkpoint, documents = (str(tmp_path / n) for n in ("root", "c", "documents"))
    everything = [record(i) for i in range(40)]

    feed.add(everything[:15])
    feed.add(everything[15:25])
    run(landing.land(feed.stream(), root, checkpoint, documents=documents))
    run(landing.land(feed.stream(), root, checkpoint, documents=documents))  # nothing new: nothing changes
    assert tables.landed_readings(spark, root).count() + tables.landed_bad_records(spark, root).count() == 25
    # A batch whose end was not recorded runs again after a restart.
    (tmp_path / "c" / "commits" / "1").unlink()
    (tmp_path / "c" / "commits" / ".1.crc").unlink(missing_ok=True)
    feed.add(everything[25:])
    run(landing.land(feed.stream(), root, checkpoint, documents=documents))

    landed = tables.landed_readings(spark, root)
    bad = tables.landed_bad_records(spark, root)
    assert sorted(r["offset"] for r in bad.collect()) == [9, 19, 29, 39]
    assert sorted(r["offset"] for r in landed.collect()) == [i for i in range(40) if i % 10 != 9]
    assert landed.select("batch_id").distinct().count() == 3
    assert landed.filter(F.col("event_date") != F.to_date("timestamp")).count() == 0
    found = tables.landed_alerts(spark, root)
    assert sorted(r["offset"] for r in found.collect()) == sorted(
        r["offset"] for r in alerts(landed).collect()
    )

    assert snapshot.totals(landing.fleet(spark, root)).first() == snapshot.fleet_snapshot(landed).first()
    assert [r["offset"] for r in landing.newest_alerts(spark, root).collect()] == [
        r["offset"] for r in newest(alerts(landed), 10, ["offset"]).collect()
    ]
    shown = {
        name: json.loads(snapshot.latest_document(spark, f"{documents}/{name}").first()["document"])
        for name in ("metrics", "page", "alerts")
    }
    assert shown["metrics"]["total_messages"] == shown["page"]["total_messages"] == 36
    assert len(shown["alerts"]) == 10 and shown["alerts"] == shown["page"]["alerts"]

    tables.register_views(spark, root)
    assert spark.sql("select count(*) from live_sensors").first()[0] == 36
    assert spark.sql("select count(*) from live_alerts").first()[0] == found.count()


def folders(root):
    return [p for p in root.rglob("*.parquet") if "_temporary" not in str(p)]


def test_a_new_checkpoint_adds_and_never_replaces(spark, tmp_path):
    feed = Feed(spark, tmp_path, RECORDS)
    root, documents = str(tmp_path / "root"), str(tmp_path / "d")
    good = [record(i) for i in range(60) if i % 10 != 9]
    feed.add(good[:10])
    run(landing.land(feed.stream(), root, str(tmp_path / "c1"), documents=documents))
    other = tmp_path / "other"
    other.mkdir()
    feed = Feed(spark, other, RECORDS)
    feed.add(good[10:13])
    run(landing.land(feed.stream(), root, str(tmp_path / "c2"), documents=documents))
    landed = tables.landed_readings(spark, root)
    assert landed.count() == 13 and landed.select("stream").distinct().count() == 2
    assert snapshot.totals(landing.fleet(spark, root)).first() == snapshot.fleet_snapshot(landed).first()
    assert [r["offset"] for r in landing.newest_alerts(spark, root).collect()] == [
        r["offset"] for r in newest(alerts(landed), 10, ["offset"]).collect()
    ]
    shown = json.loads(snapshot.latest_document(spark, f"{documents}/metrics").first()["document"])
    assert shown["total_messages"] == 13


def test_updates_and_running_stats_of_a_new_checkpoint_add(spark, tmp_path):
    for k in range(2):
        (tmp_path / str(k)).mkdir()
        feed = Feed(spark, tmp_path / str(k), READINGS)
        feed.add([reading(i + 1000 * k, float(i), event_id=i) for i in range(12)])
        stream = feed.stream().withWatermark("timestamp", WATERMARK)
        run(updates.keep_updates(window_stats(stream), str(tmp_path / "u"), str(tmp_path / f"cu{k}")))
        run(keep_running_stats(feed.stream(), str(tmp_path / "r"), str(tmp_path / f"cr{k}")))
    found = updates.latest_stats(spark, str(tmp_path / "u")).collect()
    assert sum(r["message_count"] for r in found) == 24
    assert spark.read.parquet(str(tmp_path / "r" / "stats")).count() == 6


def test_the_fleet_is_folded_and_a_batch_writes_what_it_holds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FOLD_EVERY", 2)
    feed = Feed(spark, tmp_path, RECORDS)
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "c")
    for k in range(5):
        feed.add([record(i) for i in range(10 * k, 10 * k + 9)])
    run(landing.land(feed.stream(), root, checkpoint))
    landed = tables.landed_readings(spark, root)
    assert landed.count() == 45
    assert snapshot.totals(landing.fleet(spark, root)).first() == snapshot.fleet_snapshot(landed).first()
    assert list(landing._folds(spark, root).values()) == [3]
    parts = landing._parts(spark, root).select(F.input_file_name().alias("f")).distinct().collect()
    assert sorted(r["f"].split("/root/")[1].rsplit("/", 1)[0].split("/stream=")[0] for r in parts) == ["fleet", "fleet_folds"]
    # The last batch, a fold's too, runs again.
    for name in ("4", "3"):
        (tmp_path / "c" / "commits" / name).unlink()
        (tmp_path / "c" / "commits" / f".{name}.crc").unlink(missing_ok=True)
    run(landing.land(feed.stream(), root, checkpoint))
    assert snapshot.totals(landing.fleet(spark, root)).first()["total_messages"] == 45


def test_poison_does_not_stop_the_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, RECORDS)
    root, documents = str(tmp_path / "root"), str(tmp_path / "d")
    fine = json.loads(message(0, 25.0, 60))
    sent = [
        json.dumps(fine | {"sensor_type": None}),
        json.dumps(fine | {"sensor_type": "null"}),
        json.dumps(fine | {"location": None, "value": 31.0}),
        json.dumps(fine).replace("25.0", "1e400"),
        json.dumps(fine).replace("25.0", "-Infinity"),
        json.dumps(fine | {"timestamp": "12:30"}),
        json.dumps(fine) + " junk",
        "",
    ]
    feed.add([(text, "t", 0, i) for i, text in enumerate(sent)])
    feed.add([(f"{json.dumps(fine | {'sensor_type': f'kind {i}'})}", "t", 0, 100 + i) for i in range(30)])
    run(landing.land(feed.stream(), root, str(tmp_path / "c"), documents=documents))
    bad = {r["offset"]: r["reason"] for r in tables.landed_bad_records(spark, root).collect()}
    assert bad == {3: "bad_value", 4: "bad_value", 5: "bad_timestamp", 6: "bad_json", 7: "empty"}
    shown = json.loads(snapshot.latest_document(spark, f"{documents}/page").first()["document"])
    assert shown["total_messages"] == 33 and shown["sensor_stats"]["null"]["count"] == 2


def test_folded_batches_are_not_read(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    table, base = str(tmp_path / "t"), str(tmp_path / "base")
    feed.add([reading(1, 1.0)])
    stream = feed.stream().withWatermark("timestamp", WATERMARK)
    run(updates.keep_updates(window_stats(stream), table, str(tmp_path / "c")))
    updates.fold_updates(spark, table, base)
    covered = {p.parent for p in folders(tmp_path / "t")}
    feed.add([reading(2, 3.0)])
    stream = feed.stream().withWatermark("timestamp", WATERMARK)
    run(updates.keep_updates(window_stats(stream), table, str(tmp_path / "c")))
    latest = updates.latest_stats(spark, table, base)
    read = {r["f"] for r in updates._updates(spark, table, base).select(F.input_file_name().alias("f")).collect()}
    assert latest.first()["message_count"] == 2
    assert not any(str(folder) in name for folder in covered for name in read)


def partition_filters(spark, rows):
    """What each scan of Parquet tests its folders on, in full."""
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = rows._jdf.queryExecution().explainString(formatted)
    return [line for line in plan.splitlines() if line.startswith("PartitionFilters")]


def test_dates_of_landed_readings_prune_folders(spark, tmp_path):
    feed = Feed(spark, tmp_path, RECORDS)
    feed.add([record(i) for i in range(30)])
    root = str(tmp_path / "root")
    run(landing.land(feed.stream(), root, str(tmp_path / "c")))
    day = tables.landed_readings(spark, root).filter("event_date = '2024-01-02'")
    filters = partition_filters(spark, day.select("value"))
    assert len(filters) == 1 and "isnotnull(event_date" in filters[0] and "= 2024-01-02)" in filters[0]
    assert day.count() == len([i for i in range(12, 24) if i % 10 != 9])


def test_append_to_parquet_restarts_without_loss_or_repeat(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    table, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    for count in (1, 2, 2, 3):
        if feed.files < count:
            feed.add([reading(feed.files, 99.0)])
        rows = alerts(feed.stream())
        run(queries.append_parquet(rows, table, checkpoint, name="live_alerts", by="sensor_type"))
        assert spark.read.parquet(table).count() == count


def test_range_alerts_on_a_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    feed.add([reading(1, 10.0), reading(2, 20.0)])
    feed.add([reading(3, 40.0), reading(4, 1031.0, "pressure")])
    found = violations(feed.stream(), rule_table(spark, RANGE))
    table = str(tmp_path / "t")
    run(queries.append_parquet(found, table, str(tmp_path / "c")))
    assert {(r["value"], r["side"]) for r in spark.read.parquet(table).collect()} == {
        (10.0, "low"), (40.0, "high"), (1031.0, "high"),
    }


RUNNING = "event_id bigint, sensor_type string, timestamp timestamp, value double"


@pytest.mark.parametrize("slices", [None, 5])
def test_running_stats_over_batches_and_a_restart(spark, tmp_path, slices):
    feed = Feed(spark, tmp_path, RUNNING)
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "c")
    rows = sorted(sample_rows(700, 4, ["a", "a", "a", "b", None]), key=lambda r: (r[2], r[0]))
    parts = [rows[:3], rows[3:12], rows[12:300], rows[300:310], rows[310:]]

    def step():
        run(keep_running_stats(feed.stream(), root, checkpoint, slices=slices))

    for part in parts[:3]:
        feed.add(part)
    step()
    # The last batch runs again, then two more.
    (tmp_path / "c" / "commits" / "2").unlink()
    (tmp_path / "c" / "commits" / ".2.crc").unlink(missing_ok=True)
    for part in parts[3:]:
        feed.add(part)
    step()
    found = spark.read.parquet(f"{root}/stats")
    assert found.count() == len(by_list(rows))
    assert collected(found) == by_list(rows)
    assert collected(found) == collected(running_stats(spark.createDataFrame(rows, RUNNING)))


def test_late_readings_count_when_they_arrive(spark, tmp_path):
    feed = Feed(spark, tmp_path, RUNNING)
    rows = [(i, "a", at(100 + i), float(i)) for i in range(10)]
    feed.add(rows)
    feed.add([(10, "a", at(0), 50.0)])
    root = str(tmp_path / "root")
    run(keep_running_stats(feed.stream(), root, str(tmp_path / "c")))
    found = collected(spark.read.parquet(f"{root}/stats"))
    assert found[10] == (11, round((45 + 50) / 11, 6), 0.0, 50.0)


def test_waiting_notices_any_query_that_fails(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    feed.add([reading(1, 1.0)])

    def fail(batch, batch_id):
        raise ValueError("sink is down")

    def swallow(batch, batch_id):
        pass

    spark.streams.resetTerminated()
    fine = feed.stream().writeStream.foreachBatch(swallow)
    fine = fine.option("checkpointLocation", str(tmp_path / "a")).queryName("fine").start()
    broken = feed.stream().writeStream.foreachBatch(fail)
    broken.option("checkpointLocation", str(tmp_path / "b")).queryName("broken").start()
    with pytest.raises(StreamingQueryException):
        queries.wait_for_any(spark)
    assert not fine.isActive and not spark.streams.active
    spark.streams.resetTerminated()


def test_finish_works_off_what_is_there(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    feed.add([reading(1, 99.0)])
    feed.add([reading(2, 98.0)])
    table = str(tmp_path / "t")
    writer = queries.append_parquet(alerts(feed.stream()), table, str(tmp_path / "c"))
    queries.finish(queries.triggered(writer, every=queries.REFRESH).start())
    assert spark.read.parquet(table).count() == 2
    queries.finish(queries.console(feed.stream(), str(tmp_path / "d"), name="shown").start())


def test_kafka_options(spark):
    assert kafka.read_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "iot-sensors",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "5000000",
    }
    assert "maxOffsetsPerTrigger" not in kafka.read_options("b:1", max_per_trigger=None)
    options = kafka.read_options(
        "b:1,c:2", "x,y", starting="earliest", max_per_trigger=100, group_id="g"
    )
    assert options["subscribe"] == "x,y" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "100" and options["kafka.group.id"] == "g"
    replay = kafka.replay_options("b:1", starting='{"t":{"0":5}}', ending='{"t":{"0":9}}')
    assert replay["startingOffsets"] == '{"t":{"0":5}}' and replay["endingOffsets"] == '{"t":{"0":9}}'
    sending = kafka.write_options("b:1", "t")
    assert sending["kafka.acks"] == "all" and sending["kafka.retries"] == "3"
    assert sending["kafka.compression.type"] == "gzip" and sending["topic"] == "t"


def test_working_folders_are_new_each_time(spark):
    assert working_folder(spark, "x") != working_folder(spark, "x")


def test_a_large_batch_of_one_date_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """All rows come once; a small batch of one date still makes one file."""
    monkeypatch.setattr(batches, "ROWS_PER_TASK", 50_000)
    rows = spark.range(0, 200_000, 1, 8).select(
        F.col("id").alias("offset"),
        F.sha2(F.col("id").cast("string"), 512).alias("sensor_id"),
        F.lit(START).cast("date").alias("event_date"),
    )
    for table, count in (("large", 200_000), ("small", 50_000)):
        batches.write_batch(rows.limit(count), f"{tmp_path}/{table}", "a", 0, "event_date", count)
    large, small = (spark.read.parquet(f"{tmp_path}/{table}") for table in ("large", "small"))
    assert large.columns == small.columns == ["offset", "sensor_id", "event_date", "stream", "batch_id"]
    assert large.count() == large.select("offset").distinct().count() == 200_000
    assert small.count() == 50_000
    assert len(large.inputFiles()) > 1 and len(small.inputFiles()) == 1
