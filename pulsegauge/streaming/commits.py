"""Batches that become visible as a whole, and batches packed into fewer files.

A batch of a stream writes several tables, each into a folder of its own. They count
from when the batch's commit is there, a small file written last. Readers take a
snapshot first, the last committed batch of each stream, and read no table beyond it; so
all tables show the same batches, and none of a batch that was stopped halfway.

``compact`` writes the folders of many batches anew as a pack, in files of a good size.
A pack counts from when its mark is there and stands for the batches it covers. Readers
go through the packs of a stream from its first batch on, a wider one before the ones it
was made from, and read the folders of later batches beside them. A pack that overlaps
what has been read is passed over, so two that pack at a time do no harm. The last
committed batch is never packed: it alone may run again after a failure.

``vacuum`` deletes what packs stand in for, and ``expire`` old dates.
"""

from __future__ import annotations

import functools
import json
import operator
import time
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BAD_RECORD_SCHEMA, COMMIT_SCHEMA, LANDED_SCHEMA
from ..sources import files
from .batches import gathered, together

COMMITS = "commits"
# Batches with folders of their own before they are packed, and packs of one tier
# before they become one.
LEAST = 16
FANOUT = 8
# A pack of so many bytes is left as it is.
LARGE = 64 << 30
# How long readers of an older snapshot find what they listed, and how long a pack may
# take to be written.
KEEP_S = 3600
ABANDONED_S = 24 * 3600


class Table(NamedTuple):
    name: str
    schema: T.StructType
    by: str | None = None
    format: str = "parquet"


TABLES = (
    Table("readings", LANDED_SCHEMA, "event_date"),
    Table("alerts", LANDED_SCHEMA, "event_date"),
    Table("bad_records", BAD_RECORD_SCHEMA),
    Table(COMMITS, COMMIT_SCHEMA, format="json"),
)
BY_NAME = {table.name: table for table in TABLES}


class Pack(NamedTuple):
    """Batches ``first`` to ``last`` of a stream in the folder ``run``."""

    first: int
    last: int
    run: str
    marked_ms: int


class Snapshot(NamedTuple):
    """The last committed batch of each stream, and the packs of each table and stream."""

    upto: Mapping[str, int]
    packs: Mapping[tuple[str, str], tuple[Pack, ...]]

    def packed(self, table: str, stream: str) -> int:
        """The last batch that is in a pack, -1 if none is."""
        packs = self.packs.get((table, stream), ())
        return packs[-1].last if packs else -1


def commit(spark: SparkSession, root: str, stream: str, batch_id: int, counts: Mapping[str, object]) -> None:
    """Make all that a batch wrote under ``root`` visible."""
    row = json.dumps({**counts, "committed_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())})
    files.create(spark, f"{root}/{COMMITS}/stream={stream}/batch_id={batch_id}/commit.json", row)


def committed_counts(spark: SparkSession, root: str, stream: str, batch_id: int) -> dict[str, object]:
    """What a batch's commit says. A batch that is worked off finds the one before it."""
    return json.loads(files.text(spark, f"{root}/{COMMITS}/stream={stream}/batch_id={batch_id}/commit.json"))


def _cover(packs: Sequence[Pack]) -> tuple[Pack, ...]:
    """Packs that follow each other without a gap; of those with one first batch the widest."""
    cover: list[Pack] = []
    for pack in sorted(packs, key=lambda p: (p.first, -p.last, p.run)):
        if pack.first == (cover[-1].last + 1 if cover else 0):
            cover.append(pack)
    return tuple(cover)


def _marked(spark: SparkSession, root: str) -> dict[tuple[str, str], list[Pack]]:
    found: dict[tuple[str, str], list[Pack]] = {}
    for mark in files.matching(spark, f"{root}/packs/*/*/*"):
        table, stream, name = mark.path.rsplit("/", 3)[1:]
        if not name.startswith("_"):
            first, last, run = name.split("-", 2)
            found.setdefault((table, stream), []).append(Pack(int(first), int(last), run, mark.modified_ms))
    return found


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """What is committed now. Tables read at one snapshot agree."""
    # Packs first: those made meanwhile may cover batches committed later.
    packs = {key: _cover(found) for key, found in _marked(spark, root).items()}
    upto: dict[str, int] = {}
    for entry in files.matching(spark, f"{root}/{COMMITS}/stream=*/batch_id=*/commit.json"):
        stream, batch = entry.path.rsplit("/", 3)[1:3]
        stream, batch_id = stream.removeprefix("stream="), int(batch.removeprefix("batch_id="))
        upto[stream] = max(batch_id, upto.get(stream, -1))
    return Snapshot(upto, packs)


def _any(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.or_, conditions, F.lit(False))


def committed(at: Snapshot, after: Mapping[str, int] | None = None) -> Column:
    """Whether a row's batch is committed, and later than ``after`` of its stream. On folder names."""
    after = after or {}
    return _any(
        [
            (F.col("stream") == s) & (F.col("batch_id") <= n) & (F.col("batch_id") > after.get(s, -1))
            for s, n in at.upto.items()
        ]
    )


def read(spark: SparkSession, root: str, name: str, at: Snapshot | None = None) -> DataFrame:
    """A landed table as of a snapshot, the current one by default."""
    table = BY_NAME[name]
    at = snapshot(spark, root) if at is None else at
    folder = f"{root}/{name}"
    packed = {s: at.packed(name, s) for s in at.upto}
    runs = [_folder(root, name, pack.run) for s in at.upto for pack in at.packs.get((name, s), ())]
    rows = folders(spark, folder, table.schema, table.format).filter(committed(at, packed))
    # A run's own columns say which stream and batch a row is of.
    for group in range(0, len(runs), 256):
        rows = rows.unionByName(_packed(spark, table, runs[group : group + 256]))
    return rows


def folders(spark: SparkSession, folder: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """All there is in the folders of a table, committed or not; nothing if there are none."""
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    with files.listing(spark):
        return spark.read.schema(schema).format(format).load(folder)


def _folder(root: str, name: str, run: str) -> str:
    return f"{root}/packed/{name}/run={run}"


def _packed(spark: SparkSession, table: Table, runs: list[str]) -> DataFrame:
    base = runs[0].rsplit("/", 1)[0]
    with files.listing(spark):
        held = spark.read.schema(table.schema).option("basePath", base).parquet(*runs)
    return held.select(table.schema.fieldNames())


def _write(spark: SparkSession, root: str, table: Table, rows: DataFrame, stream: str, first: int, last: int) -> Pack:
    run = uuid.uuid4().hex
    writer = gathered(rows, table.by).write
    if table.by:
        writer = writer.partitionBy(table.by)
    writer.parquet(_folder(root, table.name, run))
    files.create(spark, f"{root}/packs/{table.name}/{stream}/{first}-{last}-{run}")
    return Pack(first, last, run, 0)


def _tier(batches: int) -> int:
    tier = 0
    while batches >= FANOUT:
        batches //= FANOUT
        tier += 1
    return tier


def _mergeable(packs: Sequence[Pack], small: Mapping[str, bool], fanout: int) -> tuple[int, int] | None:
    """A range of neighbours of one tier, all of them small, that is long enough."""
    start = 0
    for i in range(len(packs) + 1):
        same = i < len(packs) and small[packs[i].run]
        if i > start and not (same and _tier(packs[i].last - packs[i].first + 1) == _tier(packs[start].last - packs[start].first + 1)):
            if i - start >= fanout:
                return start, i
            start = i
        if i == start and not same:
            start = i + 1
    return None


def compact(
    spark: SparkSession, root: str, least: int = LEAST, fanout: int = FANOUT, large: int = LARGE
) -> dict[str, int]:
    """Pack the batches of each table and stream; the number of packs written by table.

    Batches since the last pack become one if there are ``least``, and ``fanout``
    neighbouring packs of about as many batches become one unless they are ``large``.
    So a row is written again a logarithm of times at most, and the packs there are grow
    with the bytes and not with the batches. Streams may go on meanwhile.
    """
    at = snapshot(spark, root)
    written: dict[str, int] = {}

    def pack(table: Table) -> None:
        for stream, last in at.upto.items():
            packs = list(at.packs.get((table.name, stream), ()))
            first = at.packed(table.name, stream) + 1
            # All but the last committed batch, which may still run again.
            if last - first >= max(1, least):
                rows = folders(spark, f"{root}/{table.name}", table.schema, table.format)
                between = F.col("batch_id").between(first, last - 1)
                rows = rows.filter((F.col("stream") == stream) & between)
                packs.append(_write(spark, root, table, rows, stream, first, last - 1))
                written[table.name] = written.get(table.name, 0) + 1
            small = {p.run: files.size(spark, _folder(root, table.name, p.run)) < large for p in packs}
            while (found := _mergeable(packs, small, fanout)) is not None:
                a, b = found
                rows = _packed(spark, table, [_folder(root, table.name, p.run) for p in packs[a:b]])
                wide = _write(spark, root, table, rows, stream, packs[a].first, packs[b - 1].last)
                packs[a:b] = [wide]
                small[wide.run] = files.size(spark, _folder(root, table.name, wide.run)) < large
                written[table.name] = written.get(table.name, 0) + 1

    # A table by date is mostly files to open and to move, so tables don't wait for each other.
    together(spark, *(functools.partial(pack, table) for table in TABLES))
    return written


def vacuum(spark: SparkSession, root: str, keep_s: float = KEEP_S, abandoned_s: float = ABANDONED_S) -> int:
    """Delete folders that packs have stood in for since ``keep_s``; how many.

    Readers that took their snapshot longer ago than that may miss files. Packs that
    were never marked go after ``abandoned_s``.
    """
    now = time.time() * 1000
    gone = 0
    marked = _marked(spark, root)
    for table in TABLES:
        for (name, stream), packs in marked.items():
            if name != table.name:
                continue
            settled = [p for p in packs if now - p.marked_ms >= keep_s * 1000]
            cover = _cover(settled)
            end = cover[-1].last if cover else -1
            dates = f"/{table.by}=*" if table.by else ""
            found = files.matching(spark, f"{root}/{name}{dates}/stream={stream}/batch_id=*")
            packed = [e.path for e in found if int(e.path.rsplit("batch_id=", 1)[1]) <= end]
            files.delete_all(spark, packed)
            gone += len(packed)
            for pack in settled:
                if pack not in cover and pack.last <= end:
                    files.delete(spark, f"{root}/packs/{name}/{stream}/{pack.first}-{pack.last}-{pack.run}")
                    files.delete(spark, _folder(root, name, pack.run))
                    gone += 1
        known = {p.run for (name, _), packs in marked.items() if name == table.name for p in packs}
        for entry in files.matching(spark, f"{root}/packed/{table.name}/run=*"):
            if entry.path.rsplit("run=", 1)[1] not in known and now - entry.modified_ms >= abandoned_s * 1000:
                files.delete(spark, entry.path)
                gone += 1
    return gone


def expire(spark: SparkSession, root: str, before: str) -> int:
    """Delete the readings and alerts of dates before one, given as ``2024-01-31``; how many folders."""
    gone = 0
    for table in TABLES:
        if table.by:
            for base in (f"{root}/{table.name}", f"{root}/packed/{table.name}/run=*"):
                found = files.matching(spark, f"{base}/{table.by}=*")
                past = [e.path for e in found if e.path.rsplit("=", 1)[1] < before]
                files.delete_all(spark, past)
                gone += len(past)
    return gone


def batch_counts(spark: SparkSession, root: str, at: Snapshot | None = None) -> DataFrame:
    """A row for each committed batch: its messages, good readings and bad records by reason."""
    return read(spark, root, COMMITS, at)
