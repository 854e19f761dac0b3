"""Fleet figures and the documents made of them."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsegauge.operators import snapshot
from pulsegauge.operators.alerts import alerts, newest
from pulsegauge.sources.tables import stored

SCHEMA = (
    "event_id bigint, sensor_id string, sensor_type string, location string, value double, "
    "unit string, timestamp timestamp"
)


def row(i, sensor, kind, value):
    return (i, sensor, kind, "lab", value, "u", datetime(2024, 1, 1, 0, 0, i % 60))


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        row(0, "s1", "temperature", 31.0),
        row(1, "s1", "temperature", 29.0),
        row(2, "s2", "humidity", 0.0),
        row(3, "s2", "humidity", 0.0),
        row(4, "s3", "motion", None),
        row(5, None, "temperature", 33.333),
        row(6, "s1", None, 5.0),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_totals_skip_missing_names_but_count_their_messages(rows):
    assert snapshot.fleet_snapshot(rows).first().asDict() == {
        "total_messages": 7,
        "total_alerts": 2,
        "active_sensors": 3,
        "active_types": 3,
        "system_health": "Good",
    }


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert snapshot.fleet_snapshot(empty).first().asDict() == {
        "total_messages": 0,
        "total_alerts": 0,
        "active_sensors": 0,
        "active_types": 0,
        "system_health": "Good",
    }
    document = snapshot.metrics_document(snapshot.partials(empty), newest(alerts(empty)))
    assert json.loads(document.first()["document"])["sensor_stats"] == []
    page = snapshot.page_document(snapshot.partials(empty), newest(alerts(empty)))
    assert json.loads(page.first()["document"])["sensor_stats"] == {}
    assert snapshot.alerts_document(newest(alerts(empty))).first()["document"] == "[]"


@pytest.mark.parametrize("count, label", [(5, "Good"), (6, "Warning"), (10, "Warning"), (11, "Critical")])
def test_health(spark, count, label):
    data = [row(i, "s", "humidity", 70.5) for i in range(count)]
    found = snapshot.fleet_snapshot(spark.createDataFrame(data, SCHEMA)).first()
    assert (found["total_alerts"], found["system_health"]) == (count, label)


def test_stats_by_type_two_ways(rows):
    direct = {r["sensor_type"]: r.asDict() for r in snapshot.sensor_type_stats(rows).collect()}
    combined = {
        r["sensor_type"]: r.asDict()
        for r in snapshot.type_stats(snapshot.partials(rows)).collect()
    }
    assert direct == combined
    assert direct["temperature"]["avg_temp"] == direct["temperature"]["avg_value"] == 31.11
    assert direct["temperature"]["avg_humidity"] is None
    assert direct["motion"] == {
        "sensor_type": "motion", "count": 1, "avg_temp": None, "avg_humidity": None,
        "avg_value": None,
    }


def test_partials_of_batches_add_up(rows):
    halves = snapshot.partials(rows.filter("event_id < 3")).unionByName(
        snapshot.partials(rows.filter("event_id >= 3"))
    )
    merged = snapshot.merge_partials(halves)
    whole = snapshot.partials(rows)
    assert merged.schema.names == whole.schema.names
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def test_documents(rows):
    parts, latest = snapshot.partials(rows), newest(alerts(rows))
    document = json.loads(snapshot.metrics_document(parts, latest).first()["document"])
    assert document["total_messages"] == 7 and document["system_health"] == "Good"
    stats = {entry.get("sensor_type"): entry for entry in document["sensor_stats"]}
    assert stats["temperature"]["avg_temp"] == 31.11
    assert stats["temperature"]["avg_humidity"] == "N/A"
    # Zero is an average like any other.
    assert stats["humidity"]["avg_humidity"] == 0.0
    assert [a["timestamp"] for a in document["recent_alerts"]] == [
        "2024-01-01 00:00:05", "2024-01-01 00:00:00",
    ]

    page = json.loads(snapshot.page_document(parts, latest).first()["document"])
    assert page["displayed_alerts"] == len(page["alerts"]) == 2
    assert page["sensor_stats"]["temperature"] == {
        "avg": 31.11, "min": 29.0, "max": 33.33, "count": 3,
    }
    listed = json.loads(snapshot.alerts_document(latest).first()["document"])
    assert listed == page["alerts"]
    assert listed[1] == {
        "sensor_id": "s1", "sensor_type": "temperature", "value": 31.0, "unit": "u",
        "timestamp": "2024-01-01T00:00:00.000000",
    }


def test_every_type_is_on_a_page(spark):
    data = [row(i, "s", f"type_{i}", 1.0) for i in range(25_000)]
    parts = snapshot.partials(spark.createDataFrame(data, SCHEMA))
    for made, names in (
        (snapshot.metrics_document, lambda d: [e["sensor_type"] for e in d["sensor_stats"]]),
        (snapshot.page_document, lambda d: list(d["sensor_stats"])),
    ):
        pages = made(parts, newest(spark.createDataFrame([], SCHEMA))).collect()
        assert sorted(p["page"] for p in pages) == [0, 1, 2]
        documents = [json.loads(p["document"]) for p in pages]
        assert all(d["total_messages"] == 25_000 for d in documents)
        listed = [name for d in documents for name in names(d)]
        assert len(listed) == len(set(listed)) == 25_000


def test_alerts_in_pages(spark):
    data = [row(i, f"s{i}", "temperature", 31.0 + i) for i in range(50)]
    pages = snapshot.alerts_document(spark.createDataFrame(data, SCHEMA), page_size=20).collect()
    assert len(pages) == 3
    found = [json.loads(p["document"]) for p in pages]
    assert sorted(e["value"] for page in found for e in page) == [31.0 + i for i in range(50)]
    assert all([e["timestamp"] for e in p] == sorted((e["timestamp"] for e in p), reverse=True) for p in found)


def test_missing_fields_are_null_and_the_type_null_is_no_clash(spark):
    data = [row(1, "s", None, 1.0), row(2, "s", "null", 3.0), row(3, "t", "temperature", 99.0)]
    rows = spark.createDataFrame(data, SCHEMA).withColumn("location", F.lit(None).cast("string"))
    parts, latest = snapshot.partials(rows), newest(alerts(rows))
    document = json.loads(snapshot.metrics_document(parts, latest).first()["document"])
    assert document["sensor_stats"][0]["sensor_type"] is None
    assert document["recent_alerts"][0]["location"] is None
    page = json.loads(snapshot.page_document(parts, latest).first()["document"])
    assert page["sensor_stats"]["null"] == {"avg": 2.0, "min": 1.0, "max": 3.0, "count": 2}


def test_approximate_sensors(spark):
    data = [row(i % 60, f"s{i % 50}", "light", 1.0) for i in range(300)]
    found = snapshot.approximate_sensors(spark.createDataFrame(data, SCHEMA)).first()[0]
    assert 45 <= found <= 55


def test_document_as_a_file(spark, rows, tmp_path):
    parts = stored(snapshot.partials(rows), str(tmp_path / "parts"))
    target = str(tmp_path / "document")
    snapshot.write_document(snapshot.metrics_document(parts, newest(alerts(rows))), target)
    found = snapshot.latest_document(spark, target).collect()
    assert len(found) == 1 and json.loads(found[0]["document"])["total_messages"] == 7
    for as_of in (1, 2, 17):
        document = snapshot.alerts_document(newest(alerts(rows), as_of % 3))
        snapshot.write_document(document, target, as_of)
        found = snapshot.latest_document(spark, target).collect()
        assert len(json.loads(found[0]["document"])) == min(2, as_of % 3)
