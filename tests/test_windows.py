"""Window statistics: edges, sliding windows, uneven data."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest

from pulsegauge.operators.window_stats import health_by_window, window_stats

SCHEMA = "sensor_type string, timestamp timestamp_ntz, value double"
START = datetime(2024, 1, 1)


def by_loop(rows, width, slide=None):
    slide = slide or width
    groups = defaultdict(list)
    for kind, when, value in rows:
        seconds = when.replace(tzinfo=timezone.utc).timestamp()
        start = seconds // slide * slide
        while start > seconds - width:
            groups[start, kind].append(value)
            start -= slide
    out = {}
    for (start, kind), values in groups.items():
        known = [v for v in values if v is not None]
        begin = datetime.fromtimestamp(start, timezone.utc).replace(tzinfo=None)
        out[begin, begin + timedelta(seconds=width), kind] = (
            len(values),
            round(sum(known) / len(known), 6) if known else None,
            max(known, default=None),
            min(known, default=None),
        )
    return out


def collected(stats):
    return {
        (r["window_start"], r["window_end"], r["sensor_type"]): (
            r["message_count"],
            None if r["avg_value"] is None else round(r["avg_value"], 6),
            r["max_value"],
            r["min_value"],
        )
        for r in stats.collect()
    }


def uneven(count, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        hot = rng.random() < 0.4
        when = START if hot else START + timedelta(microseconds=rng.randrange(600_000_000))
        value = None if rng.random() < 0.05 else round(rng.uniform(-50, 50), 2)
        rows.append((rng.choice(["a", "a", "a", "b", None]), when, value))
    return rows


def test_a_window_holds_its_start_and_not_its_end(spark):
    rows = [("t", START + timedelta(seconds=s), float(s)) for s in (0, 29.999999, 30, 59)]
    found = collected(window_stats(spark.createDataFrame(rows, SCHEMA)))
    assert found[START, START + timedelta(seconds=30), "t"][0] == 2
    assert found[START + timedelta(seconds=30), START + timedelta(seconds=60), "t"][0] == 2
    assert len(found) == 2


@pytest.mark.parametrize("width", [1, 30, 3600])
def test_tumbling(spark, width):
    rows = uneven(2000, width)
    assert collected(window_stats(spark.createDataFrame(rows, SCHEMA), width)) == by_loop(
        rows, width
    )


@pytest.mark.parametrize("width, slide", [(30, 10), (30, 30), (45, 30), (60, 7), (10, 3)])
def test_sliding(spark, width, slide):
    rows = uneven(600, width * slide)
    found = collected(window_stats(spark.createDataFrame(rows, SCHEMA), width, slide))
    assert found == by_loop(rows, width, slide)


def test_only_partial_rows_are_shuffled(spark, tmp_path):
    spark.createDataFrame(uneven(100, 1), SCHEMA).write.parquet(str(tmp_path / "r"))
    stats = window_stats(spark.read.parquet(str(tmp_path / "r")))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "partial_count" in below and "partial_avg" in below
    assert plan.count("Exchange") == 1


def test_health_of_each_window(spark):
    rows = []
    for hour, alerts in enumerate((0, 5, 6, 10, 11)):
        at = START + timedelta(hours=hour)
        rows += [("temperature", at, 30.5)] * alerts + [("temperature", at, 30.0)]
    found = {
        r["window_start"].hour: (r["total_messages"], r["total_alerts"], r["system_health"])
        for r in health_by_window(spark.createDataFrame(rows, SCHEMA)).collect()
    }
    assert found == {
        0: (1, 0, "Good"),
        1: (6, 5, "Good"),
        2: (7, 6, "Warning"),
        3: (11, 10, "Warning"),
        4: (12, 11, "Critical"),
    }
