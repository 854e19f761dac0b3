"""Names of files and folders, through whatever file system the session reads from."""

from __future__ import annotations

import contextlib
import threading
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    path: str
    modified_ms: int


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def matching(spark: SparkSession, pattern: str) -> list[Entry]:
    """What there is by a glob pattern, in the order of the names."""
    found = _system(spark, pattern).globStatus(_path(spark, pattern)) or []
    return sorted(Entry(s.getPath().toString(), s.getModificationTime()) for s in found)


# Folders deleted at a time.
DELETERS = 8
# Tasks for each core that list the folders of a table.
LISTING_TASKS = 4
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_one_lists = threading.Lock()


@contextlib.contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Tables loaded meanwhile have their folders listed by a few tasks for each core.

    Otherwise Spark has a task for each folder, up to 10,000, and a table by date has
    thousands of folders.
    """
    with _one_lists:
        kept = spark.conf.get(_LISTING)
        spark.conf.set(_LISTING, str(min(int(kept), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
        try:
            yield
        finally:
            spark.conf.set(_LISTING, kept)


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def create(spark: SparkSession, path: str, text: str = "") -> None:
    """Write a small file that is there as a whole or not at all; an earlier one goes."""
    system, target = _system(spark, path), _path(spark, path)
    # Names with an underscore in front are not read as data.
    part = _path(spark, f"{target.getParent().toString()}/_{uuid.uuid4().hex}")
    out = system.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not system.rename(part, target):
        system.delete(target, False)
        if not system.rename(part, target):
            raise OSError(f"cannot write {path}")


def text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def delete_all(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete files and folders of one file system, several at a time, in no order."""
    if not paths:
        return
    system = _system(spark, paths[0])
    with ThreadPoolExecutor(DELETERS) as pool:
        for _ in pool.map(lambda path: system.delete(_path(spark, path), True), paths):
            pass


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    return _system(spark, path).getContentSummary(_path(spark, path)).getLength()


def set_modified(spark: SparkSession, path: str, milliseconds: int) -> None:
    _system(spark, path).setTimes(_path(spark, path), milliseconds, -1)
