"""What the plans of the registered queries must and must not hold."""

import pytest

from __spark_entry__ import entry
from pulsegauge.operators.running import last_rows
from pulsegauge.plans.catalog import REGISTERED
from pulsegauge.sources import events

BATCH = sorted(name for name in REGISTERED if not name.startswith("land_") and "stream" not in name)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, tables, name):
    plan = plan_of(REGISTERED[name](spark, tables))
    for bad in ("NestedLoop", "Cartesian", "Python", "InPandas", "InArrow", "MapPartitions"):
        assert bad not in plan
    assert "FileScan parquet" in plan


def test_scans_read_only_what_is_used(spark, tables):
    def read(name):
        plan = plan_of(REGISTERED[name](spark, tables))
        return plan[plan.index("ReadSchema: ") :].split("\n")[0]

    assert read("window_stats_30s") == (
        "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>"
    )
    assert read("fleet_snapshot") == (
        "ReadSchema: struct<user_id:bigint,event_type:string,value:double>"
    )
    assert read("delivery_errors") == "ReadSchema: struct<event_id:bigint,event_type:string,props:string>"
    assert "props" not in read("running_stats") and "user_id" not in read("running_stats")


def test_last_rows_are_cut_before_the_shuffle(spark, tables):
    rows = events.as_readings(events.events(spark, tables))
    plan = plan_of(last_rows(rows, "sensor_type", ["timestamp", "event_id"], 10))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == [
        "window_start", "window_end", "sensor_type", "message_count", "avg_value", "max_value",
        "min_value",
    ]
    assert frame.count() > 0
