"""Late readings set aside, windows in two steps, reports on what is running."""

import pytest
from pyspark.sql import functions as F

from pulsegauge.operators.delivery import delivery_progress
from pulsegauge.operators.lag import consumer_lag, offset_rows
from pulsegauge.operators.window_stats import WATERMARK, window_stats
from pulsegauge.streaming import commits, lag, progress, queries, windows

from .test_commits import replay
from .test_streams import LATE, READINGS, Feed, at, reading, run


def rows(found):
    return sorted(map(str, found.withColumn("avg_value", F.round("avg_value", 6)).collect()))


def test_landed_and_late_are_all(spark, tmp_path):
    feed, root = Feed(spark, tmp_path, READINGS), str(tmp_path / "root")
    for batch in LATE:
        feed.add(batch)

    def step():
        run(windows.keep_window_partials(feed.stream(), root, str(tmp_path / "c")))

    step()
    aside = windows.set_aside(spark, root, feed.stream())
    assert sorted((r["value"], r["reason"], r["batch_id"]) for r in aside.collect()) == [
        (39.0, "late", 2), (50.0, "no_time", 2),
    ]
    kept = windows.window_stats_so_far(spark, root)
    # The windows are those that the stateful form keeps too.
    assert {r["window_start"]: r["message_count"] for r in kept.collect()} == {at(0): 1, at(600): 1, at(540): 1}
    everything = sum(len(batch) for batch in LATE)
    assert kept.agg(F.sum("message_count")).first()[0] + aside.count() == everything
    counts = commits.batch_counts(spark, root).orderBy("batch_id").collect()
    assert [(r["messages"], r["good"], r["bad"]) for r in counts] == [
        (1, 1, {}), (1, 1, {}), (3, 1, {"late": 1, "no_time": 1}),
    ]
    replay(tmp_path / "c", 2)
    feed.add([reading(601, 40.0)])
    step()
    assert windows.set_aside(spark, root, feed.stream()).count() == 2
    assert windows.window_stats_so_far(spark, root).agg(F.sum("message_count")).first()[0] == 4


@pytest.mark.parametrize("slide", [None, 30])
def test_partials_give_wider_windows(spark, tmp_path, slide):
    feed, root = Feed(spark, tmp_path, READINGS), str(tmp_path / "root")
    sent = [reading(s, float(s % 7), kind) for s in range(0, 300, 7) for kind in ("a", None)]
    feed.add(sent[:20])
    feed.add(sent[20:])
    run(windows.keep_window_partials(feed.stream(), root, str(tmp_path / "c")))
    found = windows.window_stats_so_far(spark, root, 90, slide)
    assert rows(found) == rows(window_stats(spark.createDataFrame(sent, READINGS), 90, slide))


def test_sliding_windows_in_two_stateful_steps(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    sent = [reading(s, float(s % 7)) for s in range(0, 600, 3)]
    for k in range(4):
        feed.add(sent[50 * k : 50 * k + 50])
    table = str(tmp_path / "t")

    def step():
        stream = feed.stream().withWatermark("timestamp", WATERMARK)
        run(queries.append_parquet(window_stats(stream, 30, 10, chained=True), table, str(tmp_path / "c")))

    step()
    feed.add([reading(s, float(s % 7)) for s in range(600, 700, 3)])
    step()
    sent += [reading(s, float(s % 7)) for s in range(600, 700, 3)]
    batch = window_stats(spark.createDataFrame(sent, READINGS), 30, 10)
    assert rows(spark.read.parquet(table)) == rows(batch.filter(F.col("window_end") <= F.lit(at(699 - 120))))


LOG = "seq bigint, thread int, start_ts timestamp, end_ts timestamp, ok boolean, latency_ms double, error string"


def test_progress_over_batches_and_a_restart(spark, tmp_path):
    feed, root = Feed(spark, tmp_path, LOG), str(tmp_path / "root")
    sent = [(i, i % 4, at(2_678_000 + 3 * i), at(2_678_001 + 3 * i), i % 5 > 0, 1.0, None) for i in range(300)]

    def step():
        log = feed.stream().withWatermark("start_ts", "30 seconds")
        run(progress.keep_delivery_progress(log, root, str(tmp_path / "c")))

    for k in range(3):
        feed.add(sent[60 * k : 60 * k + 60])
    step()
    last = max(int(p.name) for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit())
    replay(tmp_path / "c", last)
    for k in range(3, 5):
        feed.add(sent[60 * k : 60 * k + 60])
    step()
    shown = progress.progress_so_far(spark, root).drop("stream")
    wanted = delivery_progress(spark.createDataFrame(sent, LOG))
    closed = wanted.filter(F.col("report_ts") <= F.lit(at(2_678_000 + 3 * 299 - 30)))
    assert sorted(map(str, shown.collect())) == sorted(map(str, closed.collect())) and shown.count() > 70


def test_lag_of_a_stream_over_its_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path, READINGS)
    for k in range(3):
        feed.add([reading(k, 1.0)])
    listener = lag.LagLog(spark, str(tmp_path / "lag"))
    assert lag.offsets_over_batches(spark, str(tmp_path / "lag")).count() == 0
    spark.streams.addListener(listener)
    try:
        query = run(queries.append_parquet(feed.stream(), str(tmp_path / "t"), str(tmp_path / "c")))
        wanted = {(query.id, n) for n in range(3)}
        for _ in range(100):
            found = lag.offsets_over_batches(spark, str(tmp_path / "lag"))
            if {(r["stream"], r["batch_id"]) for r in found.collect()} >= wanted:
                break
            query.awaitTermination(1)
    finally:
        spark.streams.removeListener(listener)
    table = found.filter(F.col("stream") == query.id).orderBy("batch_id")
    assert [(r["committed"], r["position"]) for r in table.collect()] == [(None, 1), (1, 2), (2, 3)]
    assert [r["lag"] for r in consumer_lag(table).collect()] == [1, 1]


def test_rows_of_a_report():
    report = {
        "sources": [
            {"startOffset": '{"t":{"0":5}}', "endOffset": {"t": {"0": 9, "1": 2}}, "latestOffset": None},
            {"description": "Rate", "startOffset": None, "endOffset": 7, "latestOffset": 9},
        ]
    }
    assert offset_rows(report) == [("t", 0, 5, 9, None), ("t", 1, None, 2, None), ("Rate", 0, None, 8, 10)]
