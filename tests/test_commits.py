"""Batches that show as a whole, packs, what is deleted, and streams that keep every row."""

import functools
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pulsegauge.operators import snapshot
from pulsegauge.plans.catalog import REGISTERED
from pulsegauge.session import working_folder
from pulsegauge.sources import events as source
from pulsegauge.sources import tables
from pulsegauge.streaming import commits, landing, queries

from .test_streams import RECORDS, Feed, partition_filters, record, run


def replay(checkpoint, batch):
    """The batch's end was not recorded."""
    (checkpoint / "commits" / str(batch)).unlink()
    (checkpoint / "commits" / f".{batch}.crc").unlink(missing_ok=True)


class Landing:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.feed = Feed(spark, folder, RECORDS)
        self.root, self.checkpoint = str(folder / "root"), folder / "c"
        self.sent = 0

    def add(self, count=10):
        self.feed.add([record(i) for i in range(self.sent, self.sent + count)])
        self.sent += count

    def land(self):
        return run(landing.land(self.feed.stream(), self.root, str(self.checkpoint)))

    def offsets(self, name, at=None):
        return sorted(r["offset"] for r in commits.read(self.spark, self.root, name, at).collect())

    def whole(self, upto=None):
        """What is landed is all that was sent, once, in every table."""
        sent = range(self.sent if upto is None else upto)
        assert self.offsets("bad_records") == [i for i in sent if i % 10 == 9]
        assert self.offsets("readings") == [i for i in sent if i % 10 != 9]
        landed = tables.landed_readings(self.spark, self.root)
        assert snapshot.totals(landing.fleet(self.spark, self.root)).first() == snapshot.fleet_snapshot(landed).first()
        counts = commits.batch_counts(self.spark, self.root)
        assert counts.agg(F.sum("messages")).first()[0] == len(sent)

    def files(self, name):
        return [p for base in (name, f"packed/{name}") for p in (self.folder / "root" / base).rglob("*.parquet")]


@pytest.fixture
def landed(spark, tmp_path):
    return Landing(spark, tmp_path)


@pytest.mark.parametrize("broken", ["readings", "alerts", "fleet", "bad_records"])
def test_a_batch_stopped_between_two_writes_shows_nowhere(spark, landed, monkeypatch, broken):
    landed.add()
    landed.land()
    before = commits.snapshot(spark, landed.root)
    whole_write = landing.write_batch

    def write(rows, table, *more):
        if table.endswith(f"/{broken}"):
            raise OSError("disk is gone")
        whole_write(rows, table, *more)

    landed.add()
    monkeypatch.setattr(landing, "write_batch", write)
    with pytest.raises(StreamingQueryException):
        landed.land()
    spark.streams.resetTerminated()
    # The other tables have the batch's files by now.
    assert any("batch_id=1" in str(p) for p in landed.files("bad_records" if broken == "readings" else "readings"))
    landed.whole(upto=10)
    assert commits.snapshot(spark, landed.root) == before
    assert landing.newest_alerts(spark, landed.root).filter("offset >= 10").count() == 0
    tables.register_views(spark, landed.root)
    assert spark.sql("select count(*) from live_sensors").first()[0] == 9
    monkeypatch.undo()
    landed.land()
    landed.whole()


def test_tables_of_one_snapshot_agree(spark, landed):
    landed.add()
    landed.land()
    at = commits.snapshot(spark, landed.root)
    landed.add()
    landed.land()
    assert landed.offsets("readings", at) == list(range(9)) and landed.offsets("bad_records", at) == [9]
    landed.whole()


def test_packing_keeps_rows_and_files_stop_growing(spark, landed):
    counts = []
    for _ in range(3):
        for _ in range(4):
            landed.add(5)
        landed.land()
        commits.compact(spark, landed.root, least=2, fanout=3)
        landed.whole()
        commits.vacuum(spark, landed.root, keep_s=0)
        landed.whole()
        counts.append(len(landed.files("bad_records")))
    assert len(landed.files("bad_records")) <= 3 and counts[-1] <= counts[0] + 1
    assert [p.first for p in next(iter(commits.snapshot(spark, landed.root).packs.values()))] == [0]
    day = tables.landed_readings(spark, landed.root).filter("event_date = '2024-01-02'")
    filters = partition_filters(spark, day.select("value"))
    assert len(filters) >= 2 and all("= 2024-01-02)" in f for f in filters)
    # Only the last committed batch has folders of its own.
    assert {p.parent.name for p in (landed.folder / "root" / "bad_records").rglob("*.parquet")} <= {"batch_id=11"}


def test_a_batch_runs_again_while_others_are_packed(spark, landed, monkeypatch):
    for _ in range(4):
        landed.add()
    landed.land()
    replay(landed.checkpoint, 3)
    plain = commits._write

    def write(*given):
        # The last batch runs again just as the others are packed.
        monkeypatch.setattr(commits, "_write", plain)
        landed.land()
        return plain(*given)

    monkeypatch.setattr(commits, "_write", write)
    assert commits.compact(spark, landed.root, least=1)["readings"] == 1
    landed.whole()
    assert all(p[-1].last == 2 for p in commits.snapshot(spark, landed.root).packs.values())
    # And once more after that, with what was packed gone.
    commits.vacuum(spark, landed.root, keep_s=0)
    replay(landed.checkpoint, 3)
    landed.land()
    landed.whole()


def test_two_that_pack_at_a_time_and_one_that_was_stopped(spark, landed):
    for _ in range(4):
        landed.add()
    landed.land()
    at = commits.snapshot(spark, landed.root)
    stream = next(iter(at.upto))
    table = commits.BY_NAME["readings"]
    rows = lambda first, last: commits.read(spark, landed.root, "readings", at).filter(
        F.col("batch_id").between(first, last)
    )
    commits._write(spark, landed.root, table, rows(0, 1), stream, 0, 1)
    commits._write(spark, landed.root, table, rows(1, 2), stream, 1, 2)
    commits._write(spark, landed.root, table, rows(0, 1), stream, 0, 1)
    rows(0, 3).write.parquet(f"{landed.root}/packed/readings/run=unmarked")
    landed.whole()
    commits.vacuum(spark, landed.root, keep_s=0, abandoned_s=0)
    landed.whole()
    left = commits._marked(spark, landed.root)["readings", stream]
    assert sorted((p.first, p.last) for p in left) == [(0, 1), (1, 2)]
    assert not (landed.folder / "root" / "packed" / "readings" / "run=unmarked").exists()
    commits.compact(spark, landed.root, least=1)
    landed.whole()


def test_old_dates_are_deleted(spark, landed):
    landed.add(40)
    landed.land()
    landed.add(10)
    landed.land()
    commits.compact(spark, landed.root, least=1)
    assert commits.expire(spark, landed.root, "2024-01-03") > 0
    dates = {r["event_date"] for r in tables.landed_readings(spark, landed.root).select("event_date").collect()}
    assert min(map(str, dates)) == "2024-01-03" and landed.offsets("bad_records") == [9, 19, 29, 39, 49]


def test_of_many_streams_each_has_its_own_packs(spark, tmp_path):
    (tmp_path / "a").mkdir()
    one = Landing(spark, tmp_path / "a")
    for _ in range(3):
        one.add()
    one.land()
    other = Landing(spark, tmp_path)
    other.root, other.sent = one.root, one.sent
    for _ in range(3):
        other.add()
    other.land()
    commits.compact(spark, one.root, least=1)
    commits.vacuum(spark, one.root, keep_s=0)
    assert len(commits.snapshot(spark, one.root).upto) == 2
    assert sorted(one.offsets("readings")) == [i for i in range(60) if i % 10 != 9]


def test_folded_partials_are_deleted(spark, landed, monkeypatch):
    monkeypatch.setattr(landing, "FOLD_EVERY", 2)
    for _ in range(5):
        landed.add()
    landed.land()
    assert landing.tidy(spark, landed.root, keep_s=3600)["deleted"] == 0
    assert landing.tidy(spark, landed.root, keep_s=0)["deleted"] == 2 * 4 + 3
    landed.whole()
    # The last batch runs again, and two more come.
    replay(landed.checkpoint, 4)
    for _ in range(2):
        landed.add()
    landed.land()
    landed.whole()
    landing.tidy(spark, landed.root, keep_s=0)
    landed.whole()


def test_sketches_of_the_fleet_add_up(spark, landed, monkeypatch):
    monkeypatch.setattr(landing, "FOLD_EVERY", 2)
    documents = str(landed.folder / "documents")
    for k in range(5):
        landed.add()
    run(landing.land(landed.feed.stream(), landed.root, str(landed.checkpoint), documents=documents, exact=False))
    parts = landing.fleet_by_type(spark, landed.root)
    exact = snapshot.totals(landing.fleet(spark, landed.root)).first()
    # So few are counted exactly.
    assert snapshot.totals(parts).first() == exact and parts.count() == 3
    rows = lambda found: sorted(map(str, found.collect()))
    assert rows(snapshot.type_stats(parts)) == rows(snapshot.type_stats(landing.fleet(spark, landed.root)))
    assert rows(snapshot.type_cards(parts)) == rows(snapshot.type_cards(landing.fleet(spark, landed.root)))
    shown = snapshot.latest_document(spark, f"{documents}/metrics").first()["document"]
    assert f'"total_messages":{exact["total_messages"]}' in shown


def test_the_error_of_a_sketch_is_bounded(spark):
    readings = spark.range(120_000).select(
        F.concat(F.lit("s"), F.col("id") % 40_000).alias("sensor_id"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("sensor_type"), F.lit(1.0).alias("value"),
    )
    batches = [snapshot.type_partials(readings.filter(F.col("sensor_id").endswith(str(k)))) for k in range(10)]
    merged = snapshot.merge_type_partials(functools.reduce(lambda a, b: a.unionByName(b), batches))
    found = snapshot.totals(merged).first()["active_sensors"]
    assert abs(found - 40_000) < 3 * 0.017 * 40_000
    assert snapshot.totals(snapshot.type_partials(readings.limit(0))).first()["active_sensors"] == 0


def test_nothing_landed_yet(spark, tmp_path):
    assert commits.read(spark, str(tmp_path), "readings").count() == 0
    assert commits.compact(spark, str(tmp_path)) == {} and commits.vacuum(spark, str(tmp_path)) == 0


def test_counts_of_a_batch(spark, landed):
    landed.add(20)
    landed.land()
    found = commits.batch_counts(spark, landed.root).first()
    assert (found["messages"], found["good"], found["bad"]) == (20, 18, {"bad_json": 2})
    assert str(found["oldest"]) == "2024-01-01 00:00:00" and str(found["newest"]) == "2024-01-02 12:00:00"


def written(spark, rows):
    folder = working_folder(spark, "tables")
    spark.createDataFrame(rows, source.EVENTS_SCHEMA).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def events(times):
    return [(i, t, i % 7, ("view", "click")[i % 2], float(i % 90), "{}") for i, t in enumerate(times)]


@pytest.mark.parametrize("known", [True, False])
def test_events_without_a_time_are_streamed(spark, known):
    start = datetime(2024, 1, 1)
    times = [start.replace(minute=i % 60) if known and i % 10 else None for i in range(200)]
    folder = written(spark, events(times))
    table = working_folder(spark, "t")
    stream = source.events_stream(spark, folder)
    run(queries.append_parquet(stream, table, working_folder(spark, "c")))
    assert sorted(r["event_id"] for r in spark.read.parquet(table).collect()) == list(range(200))
    bad = REGISTERED["land_bad_records"](spark, folder).groupBy("reason").count().collect()
    wanted = REGISTERED["bad_records"](spark, folder).groupBy("reason").count().collect()
    assert sorted(map(str, bad)) == sorted(map(str, wanted))
    assert REGISTERED["alerts_range_stream"](spark, folder).count() == REGISTERED["alerts_range"](spark, folder).count()
    stats = REGISTERED["running_stats_stream"](spark, folder)
    assert sorted(map(str, stats.collect())) == sorted(map(str, REGISTERED["running_stats"](spark, folder).select(stats.columns).collect()))


def test_batches_of_a_stream_are_in_order(spark, monkeypatch):
    monkeypatch.setattr(source, "BATCHES", 12)
    start = datetime(2024, 1, 1).timestamp()
    folder = written(spark, events([datetime.fromtimestamp(start + 60 * (i * 37 % 240)) for i in range(240)]))
    seen = []
    stream = source.events_stream(spark, folder).writeStream.foreachBatch(
        lambda batch, _: seen.append(batch.agg(F.min("ts"), F.max("ts"), F.count("*")).first())
    )
    run(stream.option("checkpointLocation", working_folder(spark, "c")))
    assert len(seen) == 12 and sum(s[2] for s in seen) == 240
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
