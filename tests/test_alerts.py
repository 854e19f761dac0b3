"""Rules: bounds are in range, open sides, types without a rule, plans."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsegauge.functions.rules import HOT, RANGE, UPPER, Rule, folded, rule_table
from pulsegauge.operators.alerts import alert_lines, alerts, hot_readings, newest, violations
from pulsegauge.operators.snapshot import partials
from pulsegauge.operators.window_stats import health_by_window
from pulsegauge.schema import RULE_SCHEMA

VALUES = [
    ("temperature", v) for v in (14.99, 15.0, 30.0, 30.01, 35.0, 35.01, None)
] + [("humidity", v) for v in (29.9, 30.0, 70.0, 70.1)] + [
    ("pressure", v) for v in (999.9, 1000.0, 1030.0, 1030.1)
] + [("motion", 1.0), ("light", 5000.0), (None, 99.0)]


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (i, f"s{i}", kind, "lab", value, "u", datetime(2024, 1, 1, 0, 0, i % 4, 500000 * (i % 2)))
        for i, (kind, value) in enumerate(VALUES)
    ]
    schema = (
        "event_id bigint, sensor_id string, sensor_type string, location string, value double, "
        "unit string, timestamp timestamp"
    )
    return spark.createDataFrame(data, schema)


def found(result, value="value"):
    return {(row["sensor_type"], row[value]) for row in result.collect()}


def test_upper_rules_leave_bounds_alone(rows):
    assert found(alerts(rows, UPPER)) == {
        ("temperature", 30.01),
        ("temperature", 35.0),
        ("temperature", 35.01),
        ("humidity", 70.1),
    }


def test_hot_rule_and_its_short_form(rows):
    hot = hot_readings(rows, HOT)
    assert hot.columns == [
        "timestamp", "sensor_id", "sensor_type", "temperature_value", "location",
    ]
    assert found(hot, "temperature_value") == {("temperature", 35.01)}


def test_range_rules_by_join_and_by_predicate_agree(spark, rows):
    joined = violations(rows, rule_table(spark, RANGE))
    expected = {
        ("temperature", 14.99): "low",
        ("temperature", 30.01): "high",
        ("temperature", 35.0): "high",
        ("temperature", 35.01): "high",
        ("humidity", 29.9): "low",
        ("humidity", 70.1): "high",
        ("pressure", 999.9): "low",
        ("pressure", 1030.1): "high",
    }
    assert {(r["sensor_type"], r["value"]): r["side"] for r in joined.collect()} == expected
    assert found(alerts(rows, RANGE)) == set(expected)
    bounds = joined.filter("sensor_type = 'pressure'").select("lo", "hi").distinct().collect()
    assert [tuple(b) for b in bounds] == [(1000.0, 1030.0)]


def test_open_sides_and_several_rules_for_a_type(spark, rows):
    rules = [
        Rule("a", "temperature", hi=35.0),
        Rule("b", "temperature", lo=15.0),
        Rule("c", "temperature"),
        Rule("d", "motion", lo=2.0),
    ]
    table = rule_table(spark, rules)
    assert table.schema == RULE_SCHEMA
    hits = violations(rows, table)
    assert {(r["rule_set"], r["value"]) for r in hits.collect()} == {
        ("a", 35.01), ("b", 14.99), ("d", 1.0),
    }
    assert found(alerts(rows, rules)) == {
        ("temperature", 35.01), ("temperature", 14.99), ("motion", 1.0),
    }
    assert alerts(rows, []).count() == 0
    assert alerts(rows, [Rule("c", "temperature")]).count() == 0


def test_a_thousand_rules(spark, rows):
    many = [Rule("many", f"type_{i}", lo=-5.0, hi=1.0) for i in range(1000)] + list(RANGE)
    assert alerts(rows, many).count() == alerts(rows, RANGE).count() > 0
    more = rows.withColumn("sensor_type", F.lit("type_999"))
    outside = more.filter("value < -5 or value > 1").count()
    assert alerts(more, many).count() == outside > 0
    assert partials(more, many).agg(F.sum("alerts")).first()[0] == outside
    found = health_by_window(more, many).agg(F.sum("total_alerts")).first()[0]
    assert found == more.filter("timestamp is not null and (value < -5 or value > 1)").count()


def test_rules_of_a_type_fold_to_one_range():
    rules = [Rule("a", "x", lo=1.0, hi=9.0), Rule("b", "x", hi=7.0), Rule("c", "x", lo=2.0), Rule("d", "y")]
    assert folded(rules) == {"x": (2.0, 7.0)}


def test_small_rule_table_is_broadcast_by_its_size(spark, rows):
    readings = rows.withColumn("sensor_type", F.col("sensor_type"))
    plan = violations(readings, rule_table(spark, RANGE))._jdf.queryExecution()
    assert "BroadcastHashJoin" in plan.executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        many = [Rule("many", f"type_{i}", hi=1.0) for i in range(2000)]
        plan = violations(readings, rule_table(spark, many))._jdf.queryExecution()
        assert "BroadcastHashJoin" not in plan.executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rules_reach_the_parquet_scan(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    plan = alerts(landed).select("sensor_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,30.0)" in plan
    assert "ReadSchema: struct<sensor_id:string,sensor_type:string,value:double>" in plan


def test_newest_breaks_ties_and_never_sorts_the_whole(rows):
    top = newest(rows.filter("sensor_type is not null"), 4)
    assert [r["event_id"] for r in top.collect()] == [3, 7, 11, 15]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_alert_lines(rows):
    lines = {r["type"]: r for r in alert_lines(rows.filter("event_id in (2, 9)")).collect()}
    assert lines["HIGH_TEMPERATURE"]["timestamp"] == "2024-01-01 00:00:02"
    assert lines["HIGH_HUMIDITY"]["timestamp"] == "2024-01-01 00:00:01.500000"
