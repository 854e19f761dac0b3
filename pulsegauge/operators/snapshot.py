"""The state of the whole fleet: totals, figures per type, JSON documents.

Everything here follows from one small table, the partials: a row per sensor and
type with counts, sums and extremes. Partials of different batches add up, so the
same functions serve a whole table and a stream that keeps partials per batch.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import display_time, wire_time
from ..functions.labels import MISSING, alert_label, health
from ..functions.rules import UPPER, Rule, breaks_rule

# Entries a page of a document lists, about.
PAGE_SIZE = 10_000
# The logarithm of a sketch's buckets; its error is about 1.04 / sqrt(2**12).
SKETCH_BITS = 12
# Documents are replaced in turn, so that a reader finds the newest while one is written.
TURNS = 16


def partials(readings: DataFrame, rules: Sequence[Rule] = UPPER) -> DataFrame:
    """One row per sensor and type. The only pass over the readings."""
    return readings.groupBy("sensor_id", "sensor_type").agg(
        F.count("*").alias("messages"),
        F.count_if(breaks_rule(rules)).alias("alerts"),
        F.count("value").alias("values"),
        F.sum("value").alias("total"),
        F.max("value").alias("top"),
        F.min("value").alias("bottom"),
    )


def merge_partials(parts: DataFrame) -> DataFrame:
    """Partials of several batches as partials of all of them."""
    return parts.groupBy("sensor_id", "sensor_type").agg(
        F.sum("messages").alias("messages"),
        F.sum("alerts").alias("alerts"),
        F.sum("values").alias("values"),
        F.sum("total").alias("total"),
        F.max("top").alias("top"),
        F.min("bottom").alias("bottom"),
    )


def type_partials(readings: DataFrame, rules: Sequence[Rule] = UPPER) -> DataFrame:
    """One row per type, with a sketch of its sensors instead of a row for each.

    Wherever figures of the fleet are made from partials, these will do, of one size
    however many sensors there are; sensors are then counted to about 1.6%.
    """
    return readings.groupBy("sensor_type").agg(
        F.count("*").alias("messages"),
        F.count_if(breaks_rule(rules)).alias("alerts"),
        F.count("value").alias("values"),
        F.sum("value").alias("total"),
        F.max("value").alias("top"),
        F.min("value").alias("bottom"),
        F.hll_sketch_agg("sensor_id", SKETCH_BITS).alias("sensors"),
    )


def merge_type_partials(parts: DataFrame) -> DataFrame:
    """Type partials of several batches as those of all of them."""
    return parts.groupBy("sensor_type").agg(
        F.sum("messages").alias("messages"),
        F.sum("alerts").alias("alerts"),
        F.sum("values").alias("values"),
        F.sum("total").alias("total"),
        F.max("top").alias("top"),
        F.min("bottom").alias("bottom"),
        F.hll_union_agg("sensors").alias("sensors"),
    )


def totals(parts: DataFrame) -> DataFrame:
    """One row: messages, alerts, sensors, types and health; of type partials, about how many sensors."""
    if "sensors" in parts.columns:
        sensors = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sensors")), F.lit(0))
    else:
        sensors = F.countDistinct("sensor_id")
    alerts = F.coalesce(F.sum("alerts"), F.lit(0))
    return parts.agg(
        F.coalesce(F.sum("messages"), F.lit(0)).alias("total_messages"),
        alerts.alias("total_alerts"),
        sensors.alias("active_sensors"),
        F.countDistinct("sensor_type").alias("active_types"),
    ).withColumn("system_health", health(F.col("total_alerts")))


def fleet_snapshot(readings: DataFrame, rules: Sequence[Rule] = UPPER) -> DataFrame:
    """``totals`` of a table of readings."""
    return totals(partials(readings, rules))


def approximate_sensors(readings: DataFrame, error: float = 0.02) -> DataFrame:
    """One row: about how many sensors there are, in constant memory."""
    return readings.agg(F.approx_count_distinct("sensor_id", error).alias("active_sensors"))


def type_stats(parts: DataFrame) -> DataFrame:
    """Per type the count, the average, and the average once more under the
    type's own name for temperature and humidity."""

    def average_of(sensor_type: str) -> Column:
        return F.when(F.col("sensor_type") == sensor_type, F.col("avg_value"))

    return (
        parts.groupBy("sensor_type")
        .agg(F.sum("messages").alias("count"), _average().alias("avg_value"))
        .select(
            "sensor_type",
            "count",
            average_of("temperature").alias("avg_temp"),
            average_of("humidity").alias("avg_humidity"),
            "avg_value",
        )
    )


def sensor_type_stats(readings: DataFrame) -> DataFrame:
    """``type_stats`` straight from readings, in one grouping."""

    def average_of(sensor_type: str) -> Column:
        only = F.when(F.col("sensor_type") == sensor_type, F.col("value"))
        return F.round(F.avg(only), 2)

    return readings.groupBy("sensor_type").agg(
        F.count("*").alias("count"),
        average_of("temperature").alias("avg_temp"),
        average_of("humidity").alias("avg_humidity"),
        F.round(F.avg("value"), 2).alias("avg_value"),
    )


def type_cards(parts: DataFrame) -> DataFrame:
    """Per type average, minimum, maximum and count for display."""
    return parts.groupBy("sensor_type").agg(
        _average().alias("avg"),
        F.round(F.min("bottom"), 2).alias("min"),
        F.round(F.max("top"), 2).alias("max"),
        F.sum("messages").alias("count"),
    )


def _average() -> Column:
    return F.round(F.try_divide(F.sum("total"), F.sum("values")), 2)


def metrics_document(
    parts: DataFrame, newest_alerts: DataFrame, page_size: int = PAGE_SIZE
) -> DataFrame:
    """``page`` and ``document``: the backend's figures as JSON.

    Types are listed by name, alerts newest first; N/A stands for no average. There is
    one page unless there are more entries than ``page_size``; then each type and alert
    is on one of several, by hash, and the figures are on all.
    """
    stats = type_stats(parts).select(
        F.coalesce("sensor_type", F.lit("")).alias("key"),
        F.col("sensor_type").alias("place"),
        F.struct(
            "sensor_type",
            "count",
            _number_or_missing("avg_temp"),
            _number_or_missing("avg_humidity"),
            _number_or_missing("avg_value"),
        ).alias("entry"),
    )
    recent = newest_alerts.select(
        _alert_key(),
        _newest_first(),
        F.struct(
            "sensor_id",
            alert_label(F.col("sensor_type")).alias("type"),
            "location",
            display_time(F.col("timestamp")).alias("timestamp"),
        ).alias("entry"),
    )
    return _document(
        totals(parts).select(F.struct("*").alias("figures")),
        {"sensor_stats": stats, "recent_alerts": recent},
        page_size,
        [*_figures(), "sensor_stats", "recent_alerts"],
    )


def page_document(
    parts: DataFrame, newest_alerts: DataFrame, page_size: int = PAGE_SIZE
) -> DataFrame:
    """The same figures in the shape the dashboard page reads, in pages likewise.

    ``sensor_stats`` is an object with a key per type, and ``alerts`` holds the
    readings themselves; ``displayed_alerts`` is how many. Readings without a type
    count under the key ``null``, together with a type of that name.
    """
    named = parts.withColumn("sensor_type", F.coalesce("sensor_type", F.lit("null")))
    cards = type_cards(named).select(
        F.col("sensor_type").alias("key"),
        F.col("sensor_type").alias("place"),
        F.struct(
            F.col("sensor_type").alias("key"),
            F.struct("avg", "min", "max", "count").alias("card"),
        ).alias("entry"),
    )
    return _document(
        totals(parts).select(F.struct("*").alias("figures")),
        {"cards": cards, "alerts": _alert_entries(newest_alerts)},
        page_size,
        [
            *_figures(),
            F.size("alerts").alias("displayed_alerts"),
            F.map_from_entries("cards").alias("sensor_stats"),
            "alerts",
        ],
    )


def alerts_document(newest_alerts: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``page`` and ``document``: the newest alerts as a JSON array, in pages likewise."""
    one = newest_alerts.agg(F.count("*")).select(F.struct(F.lit(None).alias("none")).alias("figures"))
    return _document(one, {"alerts": _alert_entries(newest_alerts)}, page_size, "alerts")


def _number_or_missing(name: str) -> Column:
    """A JSON number, or the text that stands for none."""
    missing = F.parse_json(F.lit(f'"{MISSING}"'))
    return F.coalesce(F.parse_json(F.col(name).cast("string")), missing).alias(name)


def _alert_key() -> Column:
    return F.concat_ws(
        ":", "sensor_id", "sensor_type", F.col("value").cast("string"), F.col("timestamp").cast("string")
    ).alias("key")


def _alert_entries(newest_alerts: DataFrame) -> DataFrame:
    return newest_alerts.select(
        _alert_key(),
        _newest_first(),
        F.struct(
            "sensor_id",
            "sensor_type",
            "value",
            "unit",
            wire_time(F.col("timestamp")).alias("timestamp"),
        ).alias("entry"),
    )


def _newest_first() -> Column:
    return (-F.unix_micros(F.col("timestamp").cast("timestamp"))).alias("place")


def _figures() -> list[Column]:
    names = ["total_messages", "total_alerts", "active_sensors", "active_types", "system_health"]
    return [F.col(f"figures.{name}").alias(name) for name in names]


def _before(left: Column, right: Column) -> Column:
    """Order of two entries by place, nulls first."""
    a, b = left["place"], right["place"]
    smaller = (a.isNull() & b.isNotNull()) | (a < b)
    larger = (a.isNotNull() & b.isNull()) | (a > b)
    return F.when(smaller, -1).when(larger, 1).otherwise(0)


def _document(
    figures: DataFrame,
    lists: dict[str, DataFrame],
    page_size: int,
    fields: list[Column | str] | str,
) -> DataFrame:
    """A row of figures and lists of entries as JSON, a row to a page."""
    counted = [e.agg(F.ceil(F.count("*") / page_size).alias("n")) for e in lists.values()]
    pages = functools.reduce(DataFrame.unionByName, counted).agg(F.greatest(F.max("n"), F.lit(1)))
    count = pages.scalar().cast("int")
    found = figures.select("figures", F.explode(F.sequence(F.lit(0), count - 1)).alias("page"))
    for name, entries in lists.items():
        hashed = F.conv(F.substr(F.md5("key"), F.lit(1), F.lit(8)), 16, 10).cast("long")
        by_page = (
            entries.withColumn("page", F.pmod(hashed, count).cast("int"))
            .groupBy("page")
            .agg(F.array_sort(F.collect_list(F.struct("place", "entry")), _before).alias(name))
            .withColumn(name, F.transform(name, lambda item: item["entry"]))
        )
        nothing = F.filter(F.array(F.lit(None).cast(by_page.schema[name].dataType.elementType)), lambda x: F.lit(False))
        found = found.join(by_page, "page", "left").withColumn(name, F.coalesce(name, nothing))
    shown = F.col(fields) if isinstance(fields, str) else F.struct(*fields)
    return found.select("page", F.to_json(shown, {"ignoreNullFields": "false"}).alias("document"))


def write_document(document: DataFrame, path: str, as_of: int = 0) -> None:
    """Write the pages of a document beside those before it, as JSON lines.

    A newer document has a larger ``as_of``; ``latest_document`` finds it. The folder of
    the ``TURNS``-th before it is replaced.
    """
    marked = document.withColumn("as_of", F.lit(as_of).cast("long"))
    marked.write.mode("overwrite").json(f"{path}/turn={as_of % TURNS}")


def latest_document(spark: SparkSession, path: str) -> DataFrame:
    """``page`` and ``document`` as written last."""
    kept = (
        spark.read.schema("page int, document string, as_of long")
        .option("ignoreMissingFiles", "true")
        .json(path)
    )
    latest = kept.agg(F.max("as_of").alias("as_of"))
    return kept.join(latest, "as_of").select("page", "document")
