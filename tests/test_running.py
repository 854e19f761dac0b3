"""Statistics over recent readings against the list rule, told as a loop."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulsegauge.operators import running
from pulsegauge.operators.running import recent_values, running_stats

SCHEMA = "event_id bigint, sensor_type string, timestamp timestamp_ntz, value double"
START = datetime(2024, 1, 1)


def by_list(rows, history=10, min_rows=10):
    """A list per type; statistics once it is long enough; then it is cut."""
    lists = defaultdict(list)
    out = {}
    for event_id, kind, _, value in sorted(rows, key=lambda r: (r[2], r[0])):
        if value is None:
            continue
        values = lists[kind]
        values.append(value)
        if len(values) >= min_rows:
            out[event_id] = (
                len(values), round(sum(values) / len(values), 6), min(values), max(values),
            )
            lists[kind] = values[-history:]
    return out


def collected(stats):
    return {
        r["event_id"]: (
            r["reading_count"], round(r["avg_value"], 6), r["min_value"], r["max_value"],
        )
        for r in stats.collect()
    }


def sample_rows(count, seed, types, same_time=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        when = START if rng.random() < same_time else START + timedelta(seconds=rng.randrange(5000))
        value = None if rng.random() < 0.02 else round(rng.uniform(0, 100), 2)
        rows.append((i, rng.choice(types), when, value))
    return rows


@pytest.mark.parametrize("slices", [1, 2, 7, 40])
def test_matches_the_list_rule(spark, slices):
    # One type holds most rows, one has none to speak of, one is null, and a
    # third of all rows share a time.
    types = ["hot"] * 12 + ["b", "c", None]
    rows = sample_rows(3000, slices, types, same_time=0.33)
    rows.append((3000, "rare", START, 1.0))
    stats = running_stats(spark.createDataFrame(rows, SCHEMA), slices=slices)
    found = collected(stats)
    assert found == by_list(rows)
    assert stats.count() == len(found)


def test_counts_around_the_threshold(spark):
    rows = []
    for count in (9, 10, 11, 12):
        rows += [
            (100 * count + i, f"of_{count}", START + timedelta(seconds=i), float(i))
            for i in range(count)
        ]
    found = collected(running_stats(spark.createDataFrame(rows, SCHEMA), slices=5))
    assert found == by_list(rows)
    assert len(found) == 0 + 1 + 2 + 3
    assert {v[0] for v in found.values()} == {10, 11}


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    count=st.integers(1, 400),
    seed=st.integers(0, 1000),
    kinds=st.integers(1, 4),
    slices=st.integers(1, 60),
    history=st.integers(1, 12),
)
def test_any_slicing_gives_the_same(spark, count, seed, kinds, slices, history):
    rows = sample_rows(count, seed, [f"t{i}" for i in range(kinds)], same_time=0.5)
    frame = spark.createDataFrame(rows, SCHEMA)
    stats = running_stats(frame, history=history, min_rows=history, slices=slices)
    assert collected(stats) == by_list(rows, history, history)


def test_sampled_cut_points_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(running, "SAMPLED_PER_SLICE", 20)
    rows = sample_rows(6000, 5, ["hot"] * 5 + ["b"], same_time=0.33)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert collected(running_stats(frame, slices=12)) == by_list(rows)


def test_slices_are_even_whatever_the_types(spark, monkeypatch):
    monkeypatch.setattr(running, "SAMPLED_PER_SLICE", 100)
    rows = sample_rows(9000, 6, ["hot"] * 9 + ["b"], same_time=0.33)
    frame = spark.createDataFrame(rows, SCHEMA).filter("value is not null")
    order = ["timestamp", "event_id"]
    sliced = running._sliced(frame, "sensor_type", order, 10, 16)
    own = sliced.filter("not borrowed").groupBy("sensor_type", "slice").count().collect()
    assert sum(r["count"] for r in own) == frame.count()
    assert max(r["count"] for r in own) < 2 * 9000 / 16
    assert 12 <= len(own) <= 20


def test_many_hours_of_few_readings_each(spark, monkeypatch):
    """Samples are put in order by stretches of hours, which makes no odds to the result."""
    monkeypatch.setattr(running, "SAMPLED_PER_SLICE", 40)
    monkeypatch.setattr(running, "SLICES_PER_STRETCH", 3)
    seen = []
    points = running._cut_points
    monkeypatch.setattr(running, "_cut_points", lambda *given: seen.append(points(*given)) or seen[-1])
    rows = [(i, "ab"[i % 5 == 0], START + timedelta(hours=i // 2, seconds=i % 2), float(i % 71)) for i in range(3000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert collected(running_stats(frame, slices=25)) == by_list(rows)
    windows = [line for line in str(seen[0]._jdf.queryExecution().optimizedPlan()).splitlines() if " Window [" in line]
    assert windows and all(line.rsplit("], [", 2)[1].count("#") == 2 for line in windows)
    sliced = running._sliced(frame, "sensor_type", ["timestamp", "event_id"], 10, 25)
    own = sliced.filter("not borrowed").groupBy("sensor_type", "slice").count().collect()
    assert 15 <= len(own) <= 30 and max(r["count"] for r in own) < 3 * 3000 / 25
    assert sliced.filter("borrowed").count() < 3000


def test_equal_readings_stay_whole(spark):
    # A third are copies of one reading: they cannot be told apart, yet each counts.
    rows = sample_rows(600, 9, ["a"]) + [(5000, "a", START + timedelta(seconds=2500), 7.0)] * 300
    frame = spark.createDataFrame(rows, SCHEMA)
    one = running_stats(frame, slices=1).drop("event_id").collect()
    many = running_stats(frame, slices=20).drop("event_id").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_recent_values(spark):
    rows = sample_rows(500, 3, ["a", "b"])
    found = {
        r["event_id"]: r["recent"]
        for r in recent_values(spark.createDataFrame(rows, SCHEMA), slices=6).collect()
    }
    lists = defaultdict(list)
    for event_id, kind, _, value in sorted(rows, key=lambda r: (r[2], r[0])):
        if value is not None:
            lists[kind] = [*lists[kind], value][-10:]
            assert found.pop(event_id) == lists[kind]
    assert not found


def test_nothing_to_do(spark):
    assert running_stats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert running_stats(spark.createDataFrame([], SCHEMA), slices=4).count() == 0


def test_one_last_scan_and_one_shuffle(spark, tmp_path):
    spark.createDataFrame(sample_rows(2000, 1, ["a", "b"]), SCHEMA).write.parquet(
        str(tmp_path / "r")
    )
    frame = spark.read.parquet(str(tmp_path / "r"))
    plan = running_stats(frame, slices=8)._jdf.queryExecution().executedPlan().toString()
    # Of the readings; the other scan is that of the cut points, which their size has broadcast.
    assert plan.count("ReadSchema: struct<event_id") == 1 and plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan
