"""Every operator as a query over the test tables.

A query takes the session and the folder of the tables. Times are returned without
a zone, as the tables hold them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.clock import WIRE_PATTERN, display_time
from ..functions.labels import or_missing
from ..functions.rules import RANGE, UPPER, rule_table
from ..operators import alerts as alerting
from ..operators import delivery, encoding, lag, parsing, running, snapshot, window_stats
from ..session import pin_zone, working_folder
from ..sources import events as source
from ..sources import tables
from ..streaming import commits, landing, progress, queries, updates, windows
from ..streaming import running as running_stream

Query = Callable[[SparkSession, str], DataFrame]

REGISTERED: dict[str, Query] = {}

# Slices for the queries over recent readings. Test data is too small to be cut up
# by itself, and the cut-up form is the one to be checked.
SLICES = 16
# Hours a reading may arrive after its time, in streams out of order.
DISORDER_H = 6


def registered(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(pin_zone(spark), folder)

    REGISTERED[query.__name__] = run
    return run


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    return source.as_readings(source.events(spark, folder))


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    return source.as_readings(source.events_stream(spark, folder))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return source.as_records(source.events(spark, folder))


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return source.as_delivery_log(source.events(spark, folder))


def _zoneless(rows: DataFrame) -> DataFrame:
    return rows.select(
        *(
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in rows.dtypes
        )
    )


def _rounded(rows: DataFrame, *names: str, digits: int = 8) -> DataFrame:
    """Figures without their last digits, which depend on the order of addition."""
    return rows.withColumns({name: F.round(name, digits) for name in names})


def _run(writer: DataStreamWriter) -> None:
    queries.triggered(writer, once=True).start().awaitTermination()


# Parsing and encoding


@registered
def parse_readings(spark: SparkSession, folder: str) -> DataFrame:
    return _zoneless(parsing.readings(parsing.decode(_records(spark, folder))))


@registered
def parse_readings_pattern(spark: SparkSession, folder: str) -> DataFrame:
    decoded = parsing.decode(_records(spark, folder), time_pattern=WIRE_PATTERN)
    return _zoneless(parsing.readings(decoded))


@registered
def bad_records(spark: SparkSession, folder: str) -> DataFrame:
    bad = parsing.bad_records(parsing.decode(_records(spark, folder)))
    return bad.withColumn("payload", F.hex("payload"))


@registered
def encode_records(spark: SparkSession, folder: str) -> DataFrame:
    records = encoding.encode(_readings(spark, folder))
    return records.select(*(F.col(name).cast("string").alias(name) for name in ("key", "value")))


@registered
def encode_records_unkeyed(spark: SparkSession, folder: str) -> DataFrame:
    records = encoding.encode(_readings(spark, folder), keyed=False)
    return records.select(*(F.col(name).cast("string").alias(name) for name in ("key", "value")))


@registered
def encode_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    records = encoding.encode(_readings(spark, folder))
    return _zoneless(parsing.readings(parsing.decode(records)))


# Windows


@registered
def window_stats_30s(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(window_stats.window_stats(_readings(spark, folder)), "avg_value")


@registered
def window_stats_1h(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(window_stats.window_stats(_readings(spark, folder), 3600), "avg_value")


@registered
def window_stats_sliding(spark: SparkSession, folder: str) -> DataFrame:
    stats = window_stats.window_stats(_readings(spark, folder), 30, window_stats.SLIDE_S)
    return _rounded(stats, "avg_value")


@registered
def health_by_window(spark: SparkSession, folder: str) -> DataFrame:
    return window_stats.health_by_window(_readings(spark, folder))


# Alerts


@registered
def alerts_upper(spark: SparkSession, folder: str) -> DataFrame:
    return alerting.alerts(_readings(spark, folder), UPPER)


@registered
def alerts_temperature(spark: SparkSession, folder: str) -> DataFrame:
    return alerting.hot_readings(_readings(spark, folder))


@registered
def alerts_range(spark: SparkSession, folder: str) -> DataFrame:
    return alerting.violations(_readings(spark, folder), rule_table(spark, RANGE))


@registered
def recent_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return alerting.alert_lines(alerting.newest(alerting.alerts(_readings(spark, folder))))


@registered
def recent_alerts_top5(spark: SparkSession, folder: str) -> DataFrame:
    newest = alerting.newest(alerting.alerts(_readings(spark, folder)), 5)
    return newest.select(
        "sensor_id", "sensor_type", "value", "unit", display_time(F.col("timestamp")).alias("shown")
    )


# The fleet


@registered
def sensor_type_stats(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.sensor_type_stats(_readings(spark, folder))


@registered
def sensor_type_stats_labelled(spark: SparkSession, folder: str) -> DataFrame:
    stats = snapshot.type_stats(snapshot.partials(_readings(spark, folder)))
    return stats.withColumns(
        {name: or_missing(F.col(name)) for name in ("avg_temp", "avg_humidity", "avg_value")}
    )


@registered
def sensor_type_cards(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.type_cards(snapshot.partials(_readings(spark, folder)))


@registered
def fleet_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.fleet_snapshot(_readings(spark, folder))


def _stored_partials(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return tables.stored(snapshot.partials(rows), working_folder(spark, "partials"))


@registered
def snapshot_json(spark: SparkSession, folder: str) -> DataFrame:
    rows = _readings(spark, folder)
    newest = alerting.newest(alerting.alerts(rows))
    return snapshot.metrics_document(_stored_partials(spark, rows), newest).drop("page")


@registered
def page_json(spark: SparkSession, folder: str) -> DataFrame:
    rows = _readings(spark, folder)
    newest = alerting.newest(alerting.alerts(rows))
    return snapshot.page_document(_stored_partials(spark, rows), newest).drop("page")


@registered
def snapshot_json_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Two entries to a page, so that there are several."""
    rows = _readings(spark, folder)
    newest = alerting.newest(alerting.alerts(rows))
    return snapshot.metrics_document(_stored_partials(spark, rows), newest, page_size=2)


@registered
def alerts_json(spark: SparkSession, folder: str) -> DataFrame:
    newest = alerting.newest(alerting.alerts(_readings(spark, folder)))
    return snapshot.alerts_document(newest).drop("page")


# Recent readings


@registered
def running_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = running.running_stats(_readings(spark, folder), slices=SLICES)
    return _rounded(stats, "avg_value")


@registered
def running_stats_default(spark: SparkSession, folder: str) -> DataFrame:
    """As many slices as the readings ask for."""
    return _rounded(running.running_stats(_readings(spark, folder)), "avg_value")


@registered
def recent_values(spark: SparkSession, folder: str) -> DataFrame:
    recent = running.recent_values(_readings(spark, folder), slices=SLICES)
    text = F.array_join(F.col("recent").cast("array<string>"), ",")
    return recent.select("event_id", "sensor_type", text.alias("recent"))


# Delivery and lag


@registered
def delivery_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(
        delivery.delivery_summary(_log(spark, folder)),
        "success_rate",
        "avg_latency_ms",
        "duration_s",
        "per_second",
        "per_minute",
        "per_hour",
        digits=4,
    )


@registered
def delivery_report(spark: SparkSession, folder: str) -> DataFrame:
    return delivery.delivery_report(delivery.delivery_summary(_log(spark, folder)))


@registered
def delivery_errors(spark: SparkSession, folder: str) -> DataFrame:
    return delivery.first_errors(_log(spark, folder))


@registered
def delivery_progress(spark: SparkSession, folder: str) -> DataFrame:
    report = delivery.delivery_progress(_log(spark, folder))
    return _rounded(report, "elapsed_s", "rate", digits=6)


@registered
def consumer_lag(spark: SparkSession, folder: str) -> DataFrame:
    return lag.consumer_lag(source.as_offsets(source.events(spark, folder)))


@registered
def consumer_lag_high(spark: SparkSession, folder: str) -> DataFrame:
    return lag.high_lag(source.as_offsets(source.events(spark, folder)))


@registered
def partition_positions(spark: SparkSession, folder: str) -> DataFrame:
    return lag.positions(_records(spark, folder))


# Streams. Each reads the table as a stream to its end, then the tables it left.


def _landed(spark: SparkSession, folder: str) -> str:
    records = source.as_records(source.events_stream(spark, folder))
    root = working_folder(spark, "landed")
    _run(landing.land(records, root, working_folder(spark, "checkpoint")))
    return root


@registered
def land_readings(spark: SparkSession, folder: str) -> DataFrame:
    landed = tables.landed_readings(spark, _landed(spark, folder))
    return _zoneless(landed.drop("stream", "batch_id"))


@registered
def land_alerts(spark: SparkSession, folder: str) -> DataFrame:
    landed = tables.landed_alerts(spark, _landed(spark, folder))
    return _zoneless(landed.drop("stream", "batch_id"))


@registered
def land_bad_records(spark: SparkSession, folder: str) -> DataFrame:
    bad = tables.landed_bad_records(spark, _landed(spark, folder))
    return bad.withColumn("payload", F.hex("payload")).drop("stream", "batch_id")


@registered
def land_readings_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The landed readings after their batches were packed and the folders packed deleted."""
    root = _landed(spark, folder)
    commits.compact(spark, root, least=1)
    commits.vacuum(spark, root, keep_s=0)
    return _zoneless(tables.landed_readings(spark, root).drop("stream", "batch_id"))


@registered
def land_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What each batch held, as its commit says."""
    counts = commits.batch_counts(spark, _landed(spark, folder))
    bad = [F.coalesce(F.col("bad")[reason], F.lit(0)).alias(reason) for reason in parsing.REASONS]
    return _zoneless(counts.select("batch_id", "messages", "good", *bad, "oldest", "newest"))


@registered
def fleet_snapshot_stream(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot.totals(landing.fleet(spark, _landed(spark, folder)))


@registered
def fleet_sketched_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The fleet from sketches of its sensors, and whether their number is right to 5%."""
    found = snapshot.totals(landing.fleet_by_type(spark, _landed(spark, folder)))
    good = parsing.readings(parsing.decode(_records(spark, folder)))
    exact = good.agg(F.countDistinct("sensor_id").alias("exact"))
    close = F.abs(F.col("active_sensors") - F.col("exact")) <= 0.05 * F.col("exact")
    one = F.lit(1).alias("one")
    return found.select("*", one).join(exact.select("*", one), "one").select(
        "total_messages", "total_alerts", "active_types", "system_health", close.alias("sensors_close")
    )


@registered
def recent_alerts_stream(spark: SparkSession, folder: str) -> DataFrame:
    newest = landing.newest_alerts(spark, _landed(spark, folder))
    return alerting.alert_lines(newest)


@registered
def window_stats_stream_update(spark: SparkSession, folder: str) -> DataFrame:
    stream = _stream(spark, folder).withWatermark("timestamp", window_stats.WATERMARK)
    table = working_folder(spark, "updates")
    stats = window_stats.window_stats(stream)
    _run(updates.keep_updates(stats, table, working_folder(spark, "checkpoint")))
    return _rounded(_zoneless(updates.latest_stats(spark, table)), "avg_value")


@registered
def window_stats_stream_from_records(spark: SparkSession, folder: str) -> DataFrame:
    """From records to window statistics: decoded, bad ones set aside, late ones left out."""
    records = source.as_records(source.events_stream(spark, folder))
    good = parsing.readings(parsing.decode(records))
    stats = window_stats.window_stats(good.withWatermark("timestamp", window_stats.WATERMARK))
    table = working_folder(spark, "updates")
    _run(updates.keep_updates(stats, table, working_folder(spark, "checkpoint")))
    return _rounded(_zoneless(updates.latest_stats(spark, table)), "avg_value")


@registered
def live_tables_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Messages, alerts, sensors and average of each type, by SQL over the landed tables."""
    tables.register_views(spark, _landed(spark, folder))
    return spark.sql("""
        with found as (select sensor_type, count(*) as alerts from live_alerts group by sensor_type)
        select s.sensor_type, count(*) as messages, coalesce(any_value(f.alerts), 0) as alerts,
               count(distinct s.sensor_id) as sensors, round(avg(s.value), 2) as avg_value
        from live_sensors s left join found f on f.sensor_type = s.sensor_type
        group by s.sensor_type""")


@registered
def window_stats_stream_append(spark: SparkSession, folder: str) -> DataFrame:
    stream = _stream(spark, folder).withWatermark("timestamp", window_stats.WATERMARK)
    table = working_folder(spark, "closed")
    stats = window_stats.window_stats(stream)
    _run(queries.append_parquet(stats, table, working_folder(spark, "checkpoint")))
    return _rounded(_zoneless(spark.read.parquet(table)), "avg_value")


@registered
def window_stats_stream_sliding(spark: SparkSession, folder: str) -> DataFrame:
    stream = _stream(spark, folder).withWatermark("timestamp", window_stats.WATERMARK)
    table = working_folder(spark, "updates")
    stats = window_stats.window_stats(stream, 30, window_stats.SLIDE_S)
    _run(updates.keep_updates(stats, table, working_folder(spark, "checkpoint")))
    return _rounded(_zoneless(updates.latest_stats(spark, table)), "avg_value")


@registered
def window_stats_stream_sliding_append(spark: SparkSession, folder: str) -> DataFrame:
    """Closed sliding windows, by panes and then windows, each a stateful step."""
    stream = _stream(spark, folder).withWatermark("timestamp", window_stats.WATERMARK)
    table = working_folder(spark, "closed")
    stats = window_stats.window_stats(stream, 30, window_stats.SLIDE_S, chained=True)
    _run(queries.append_parquet(stats, table, working_folder(spark, "checkpoint")))
    return _rounded(_zoneless(spark.read.parquet(table)), "avg_value")


def _windows_with_late(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """Readings up to hours late in windows that wait for an hour."""
    root = working_folder(spark, "windows")
    readings = source.as_readings(source.events_stream(spark, folder, DISORDER_H * 3600))
    _run(windows.keep_window_partials(readings, root, working_folder(spark, "checkpoint"), delay="1 hour"))
    return root, readings


@registered
def window_stats_stream_on_time(spark: SparkSession, folder: str) -> DataFrame:
    root, _ = _windows_with_late(spark, folder)
    return _rounded(_zoneless(windows.window_stats_so_far(spark, root)), "avg_value")


@registered
def late_readings_stream(spark: SparkSession, folder: str) -> DataFrame:
    root, readings = _windows_with_late(spark, folder)
    return _zoneless(windows.set_aside(spark, root, readings).drop("stream"))


@registered
def delivery_progress_stream(spark: SparkSession, folder: str) -> DataFrame:
    log = source.as_delivery_log(source.events_stream(spark, folder))
    root = working_folder(spark, "progress")
    writer = progress.keep_delivery_progress(
        log.withWatermark("start_ts", window_stats.WATERMARK), root, working_folder(spark, "checkpoint")
    )
    _run(writer)
    report = progress.progress_so_far(spark, root).drop("stream")
    return _rounded(_zoneless(report), "elapsed_s", "rate", digits=6)


@registered
def alerts_range_stream(spark: SparkSession, folder: str) -> DataFrame:
    found = alerting.violations(_stream(spark, folder), rule_table(spark, RANGE))
    table = working_folder(spark, "violations")
    _run(queries.append_parquet(found, table, working_folder(spark, "checkpoint")))
    return _zoneless(spark.read.parquet(table))


@registered
def alerts_temperature_stream(spark: SparkSession, folder: str) -> DataFrame:
    stream = _stream(spark, folder).withWatermark("timestamp", window_stats.WATERMARK)
    table = working_folder(spark, "hot")
    hot = alerting.hot_readings(stream)
    _run(queries.append_parquet(hot, table, working_folder(spark, "checkpoint")))
    return _zoneless(spark.read.parquet(table))


@registered
def running_stats_stream(spark: SparkSession, folder: str) -> DataFrame:
    root = working_folder(spark, "running")
    checkpoint = working_folder(spark, "checkpoint")
    readings = _stream(spark, folder)
    _run(running_stream.keep_running_stats(readings, root, checkpoint, slices=SLICES))
    return _rounded(_zoneless(running_stream.stats_table(spark, root, readings)), "avg_value")


@registered
def running_stats_stream_reordered(spark: SparkSession, folder: str) -> DataFrame:
    """Readings that arrive hours after others, put in order by a buffer."""
    root = working_folder(spark, "running")
    checkpoint = working_folder(spark, "checkpoint")
    readings = source.as_readings(source.events_stream(spark, folder, DISORDER_H * 3600))
    delay = f"{DISORDER_H} hours"
    _run(running_stream.keep_running_stats(readings, root, checkpoint, delay=delay))
    stats = running_stream.stats_table(spark, root, readings)
    rest = running_stream.provisional_stats(spark, root, readings)
    return _rounded(_zoneless(stats.unionByName(rest)), "avg_value")
