"""Running statistics of readings that arrive out of order."""

import random

import pytest
from pyspark.errors import StreamingQueryException

from pulsegauge.functions.clock import interval_micros
from pulsegauge.operators.running import running_stats
from pulsegauge.streaming import commits
from pulsegauge.streaming import running as stream_running

from .test_commits import replay
from .test_running import by_list, collected
from .test_streams import RUNNING, Feed, at, run


def rows_of(count, seed=0):
    rng = random.Random(seed)
    kinds = ["a", "a", "a", "b", None]
    return [(i, rng.choice(kinds), at(i * 2 + (i % 3 == 0)), float(rng.randrange(90))) for i in range(count)]


def disordered(rows, seconds, seed=0):
    rng = random.Random(seed)
    return [r for _, r in sorted(((r[2].timestamp() + rng.uniform(0, seconds), r) for r in rows), key=lambda p: p[0])]


def everything(spark, root, stream):
    stats = stream_running.stats_table(spark, root, stream)
    return stats.unionByName(stream_running.provisional_stats(spark, root, stream))


@pytest.mark.parametrize("slices", [None, 4])
def test_disorder_within_the_delay_gives_the_table(spark, tmp_path, slices):
    feed = Feed(spark, tmp_path, RUNNING)
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "c")
    rows = rows_of(600)
    arriving = disordered(rows, 110)
    assert arriving != rows

    def step():
        run(stream_running.keep_running_stats(feed.stream(), root, checkpoint, delay="2 minutes", slices=slices))

    for a, b in ((0, 5), (5, 200), (200, 210)):
        feed.add(arriving[a:b])
    step()
    replay(tmp_path / "c", 2)
    feed.add(arriving[210:600])
    step()
    assert stream_running.late_readings(spark, root, feed.stream()).count() == 0
    found = everything(spark, root, feed.stream())
    assert found.count() == len(by_list(rows))
    assert collected(found) == by_list(rows)
    assert collected(found) == collected(running_stats(spark.createDataFrame(rows, RUNNING)))
    # What is held back is within the delay of the newest, and shows only as provisional.
    held = stream_running.provisional_stats(spark, root, feed.stream())
    assert 30 < held.count() < 90


def test_later_than_the_delay_is_set_aside(spark, tmp_path):
    feed = Feed(spark, tmp_path, RUNNING)
    root = str(tmp_path / "root")
    rows = [(i, "a", at(60 * i), float(i)) for i in range(40)]
    first, late = rows[:20], [(100, "a", at(30), 1.0), (101, "a", None, 2.0)]
    feed.add([(99, "a", None, 7.0), *first])
    feed.add([*late, *rows[20:]])
    run(stream_running.keep_running_stats(feed.stream(), root, str(tmp_path / "c"), delay="2 minutes"))
    aside = stream_running.late_readings(spark, root, feed.stream())
    assert sorted(r["event_id"] for r in aside.collect()) == [100, 101]
    wanted = spark.createDataFrame([(99, "a", None, 7.0), *rows], RUNNING)
    assert collected(everything(spark, root, feed.stream())) == collected(running_stats(wanted))
    counts = commits.batch_counts(spark, root).orderBy("batch_id").collect()
    assert [(r["messages"], r["good"], r["bad"]) for r in counts] == [(21, 21, {"late": 0}), (22, 20, {"late": 2})]


def test_only_rows_without_a_time_at_first(spark, tmp_path):
    feed = Feed(spark, tmp_path, RUNNING)
    root = str(tmp_path / "root")
    feed.add([(i, "a", None, 1.0) for i in range(12)])
    feed.add([(50, "a", None, 1.0), (51, "a", at(5), 3.0)])
    feed.add([(52, "a", at(500), 4.0)])
    run(stream_running.keep_running_stats(feed.stream(), root, str(tmp_path / "c"), delay="1 minute"))
    found = {r["event_id"] for r in everything(spark, root, feed.stream()).collect()}
    assert found == {9, 10, 11, 51, 52}
    assert [r["event_id"] for r in stream_running.late_readings(spark, root, feed.stream()).collect()] == [50]


def test_a_batch_stopped_halfway_shows_nothing(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path, RUNNING)
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "c")
    rows = rows_of(90)
    feed.add(rows[:60])

    def step():
        run(stream_running.keep_running_stats(feed.stream(), root, checkpoint, delay="20 seconds"))

    step()
    before = collected(stream_running.stats_table(spark, root, feed.stream()))
    whole_write = stream_running.write_turn

    def write(given, table, *more):
        if table.endswith("/pending"):
            raise OSError("disk is gone")
        whole_write(given, table, *more)

    monkeypatch.setattr(stream_running, "write_turn", write)
    feed.add(rows[60:])
    with pytest.raises(StreamingQueryException):
        step()
    spark.streams.resetTerminated()
    assert collected(stream_running.stats_table(spark, root, feed.stream())) == before
    monkeypatch.undo()
    step()
    assert collected(everything(spark, root, feed.stream())) == by_list(rows)


def test_intervals():
    assert interval_micros("2 minutes") == 120_000_000 and interval_micros("1 second") == 1_000_000
    assert interval_micros("6 hours") == 21_600_000_000
