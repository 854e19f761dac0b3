"""Delivery reports and lag, with the edge cases of each."""

from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from pulsegauge.functions import labels
from pulsegauge.operators.delivery import (
    delivery_progress,
    delivery_report,
    delivery_summary,
    first_errors,
)
from pulsegauge.operators.lag import consumer_lag, high_lag, offsets_from_progress, positions
from pulsegauge.schema import DELIVERY_SCHEMA, ENVELOPE_SCHEMA, OFFSETS_SCHEMA

START = datetime(2024, 1, 31, 23, 59, 40)


def attempt(i, ok, seconds=None, latency=2.0):
    at = START + timedelta(seconds=i if seconds is None else seconds)
    return (
        i, i % 4, at, at + timedelta(milliseconds=latency), ok, latency if ok else None,
        None if ok else f"error {i}",
    )


def summary(spark, attempts):
    return delivery_summary(spark.createDataFrame(attempts, DELIVERY_SCHEMA)).first().asDict()


def test_summary_of_a_mixed_log(spark):
    attempts = [attempt(i, i % 4 != 3, latency=10.0 + i) for i in range(8)]
    found = summary(spark, attempts)
    assert found["messages_sent"] == 6 and found["messages_failed"] == found["error_count"] == 2
    assert found["success_rate"] == 75.0
    assert found["avg_latency_ms"] == pytest.approx((10 + 11 + 12 + 14 + 15 + 16) / 6)
    assert found["duration_s"] == pytest.approx(7.017)
    assert found["per_second"] == pytest.approx(6 / 7.017)
    assert found["per_minute"] == pytest.approx(60 * found["per_second"])
    assert found["per_hour"] == pytest.approx(3600 * found["per_second"])


def test_summary_when_all_went_well_or_none_did(spark):
    assert summary(spark, [attempt(i, True) for i in range(3)])["success_rate"] == 100.0
    failed = summary(spark, [attempt(i, False) for i in range(3)])
    assert failed["messages_failed"] == 3
    for name in ("success_rate", "avg_latency_ms", "per_second", "per_minute", "per_hour"):
        assert failed[name] == 0.0


def test_summary_of_nothing_is_zero(spark):
    assert set(summary(spark, []).values()) == {0}


def test_summary_without_duration(spark):
    found = summary(spark, [attempt(0, True, latency=0.0)])
    assert found["duration_s"] == 0.0 and found["per_second"] == 0.0


def test_report_is_text_for_people(spark):
    log = spark.createDataFrame([attempt(i, i % 3 != 0) for i in range(3000)], DELIVERY_SCHEMA)
    report = delivery_report(delivery_summary(log)).first().asDict()
    assert report["messages_sent"] == "2,000" and report["messages_failed"] == "1,000"
    assert report["success_rate"] == "66.67%" and report["latency"] == "2.00 ms"
    assert report["duration"] == "2999.00 seconds" and report["per_hour"] == "2401 msg/hr"


def test_labels(spark):
    row = spark.range(1).select(
        labels.numbered_sensor(F.lit(7)).alias("a"),
        labels.status_key(F.lit("Critical")).alias("b"),
        labels.or_missing(F.lit(None).cast("double")).alias("c"),
        labels.or_missing(F.lit(0.0)).alias("d"),
        labels.ratio(F.lit(1), F.lit(0)).alias("e"),
    ).first()
    assert tuple(row) == ("SENSOR-007", "critical", "N/A", "0.0", 0.0)


def test_first_errors(spark):
    log = spark.createDataFrame([attempt(i, i % 2 == 0) for i in range(20)], DELIVERY_SCHEMA)
    assert [tuple(r) for r in first_errors(log).collect()] == [
        (1, "error 1"), (3, "error 3"), (5, "error 5"),
    ]
    assert len(first_errors(log, 20).collect()) == 10


def test_progress_runs_on_from_month_to_month(spark):
    seconds = [0, 0.5, 3, 12, 31, 32, 3600 * 24 * 40]
    attempts = [attempt(i, i % 2 == 0, at) for i, at in enumerate(seconds)]
    log = spark.createDataFrame(attempts, DELIVERY_SCHEMA)
    found = delivery_progress(log).orderBy("report_ts").collect()
    assert [(r["elapsed_s"], r["messages"]) for r in found] == [
        (10.0, 3), (20.0, 4), (40.0, 6), (3600 * 24 * 40 + 10.0, 7),
    ]
    assert [r["rate"] for r in found] == [r["messages"] / r["elapsed_s"] for r in found]
    assert delivery_progress(log.limit(0)).count() == 0


def test_progress_groups_the_log_once(spark, tmp_path):
    attempts = [attempt(i, True) for i in range(50)]
    spark.createDataFrame(attempts, DELIVERY_SCHEMA).write.parquet(str(tmp_path / "log"))
    report = delivery_progress(spark.read.parquet(str(tmp_path / "log")))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final
    assert "NestedLoop" not in plan and "Cartesian" not in plan


OFFSETS = [
    ("t", 0, 100, 200, 300),
    ("t", 1, 100, 201, 500),
    ("t", 2, None, 900, 900),
    ("t", 3, 0, 101, None),
    ("t", 4, 0, 0, 0),
]


def test_lag(spark):
    offsets = spark.createDataFrame(OFFSETS, OFFSETS_SCHEMA)
    found = {r["partition"]: (r["lag"], r["total_lag"], r["high"]) for r in consumer_lag(offsets).collect()}
    assert found == {
        0: (100, 200, False),
        1: (101, 400, True),
        3: (101, None, True),
        4: (0, 0, False),
    }
    assert {r["partition"] for r in high_lag(offsets).collect()} == {1, 3}
    assert {r["partition"] for r in high_lag(offsets, 99).collect()} == {0, 1, 3}


def test_positions(spark):
    rows = [(None, b"x", "t", i % 2, i, datetime(2024, 1, 1), 0) for i in range(9)]
    records = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    assert {r["partition"]: r["position"] for r in positions(records).collect()} == {0: 9, 1: 8}


def test_offsets_of_a_running_stream(spark):
    progress = {
        "sources": [
            {
                "startOffset": '{"t":{"0":10,"1":20}}',
                "endOffset": {"t": {"0": 15, "1": 220, "2": 3}},
                "latestOffset": {"t": {"0": 15, "1": 400, "2": 3}},
            }
        ]
    }
    offsets = offsets_from_progress(spark, progress)
    assert sorted(tuple(r) for r in offsets.select("partition", "committed", "position", "latest").filter("committed is not null").collect()) == [
        (0, 10, 15, 15), (1, 20, 220, 400),
    ]
    assert [r["partition"] for r in high_lag(offsets).collect()] == [1]
    first = {"sources": [{"startOffset": None, "endOffset": {"t": {"0": 5}}, "latestOffset": None}]}
    assert consumer_lag(offsets_from_progress(spark, first)).count() == 0
