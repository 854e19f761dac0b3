"""Session settings the operators rely on, and the folder for written tables."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from pyspark.sql import SparkSession

# Writers emit local time without a zone, so readers and writers must agree on one.
SESSION_ZONE = "UTC"


def builder(app_name: str = "pulsegauge") -> SparkSession.Builder:
    """A session builder with the settings that matter for results and scale.

    Cluster sizes (executors, memory, shuffle partitions) stay the caller's.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", SESSION_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )


def pin_zone(spark: SparkSession) -> SparkSession:
    """Set the session zone on a session somebody else created."""
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    return spark


def working_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder for tables and stream checkpoints.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    Only where that is unset and all runs in one process, as in tests, is a local
    folder made; executors of a cluster would not see each other's files there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder all of {master} share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
