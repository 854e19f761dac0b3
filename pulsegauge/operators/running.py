"""Statistics over the last few readings of each type.

The rule: a type's readings are taken in order. From the tenth on, each gives the
average, minimum and maximum of the last eleven, itself included; the tenth has
only ten to look at. So a result comes with every reading from the tenth on, over
``rowsBetween(-10, 0)``.

There are few types and one may hold most of the readings, so a plain window per
type would leave all the work to a handful of tasks. ``running_stats`` therefore
cuts each type's order into slices of about equal size, hands each slice the few
readings before it, and runs the same window per type and slice. The result does
not depend on where the cuts are.

The readings are scanned three times: counted by type and hour, sampled for the cut
points, and worked off. Hours in a row are brought together until they hold a few
slices, and samples are put in order within such a stretch, so no task sees all of a
type's. A sampled reading is a real one, which makes what a slice borrows exact; a
quantile sketch would only tell about where it is. The cut points are a table of their
own in the working folder, a row for each type and hour, and readings are joined to the
row of theirs; no more than an hour's are in one row or meet under one key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import sequence_of
from ..session import working_folder
from ..sources.tables import stored

HISTORY = 10
MIN_ROWS = 10

ROWS_PER_SLICE = 2_000_000
# Sampled readings per slice when looking for the cut points. A slice borrows about
# HISTORY / SAMPLED_PER_SLICE of its own size.
SAMPLED_PER_SLICE = 200
# Slices, about, whose samples are put in order together.
SLICES_PER_STRETCH = 8


def running_stats(
    readings: DataFrame,
    *,
    key: str = "sensor_type",
    order_by: Sequence[str] | None = None,
    history: int = HISTORY,
    min_rows: int = MIN_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Average, minimum and maximum at each reading, over the last few.

    ``order_by`` must tell any two readings of a type apart, as a timestamp with a
    sequence number does: equal ones cannot be cut apart, nor have they an order of
    their own. By default that is the timestamp with the position of landed readings,
    or with the event_id of others. Readings without a value are left out first. With
    ``slices=None`` their number follows from that of the readings; this and the
    cut points take a job each before the result is returned.
    """
    return _over_recent(
        readings, key, order_by, history, min_rows, slices,
        lambda frame: [
            F.count("*").over(frame).alias("reading_count"),
            F.avg("value").over(frame).alias("avg_value"),
            F.min("value").over(frame).alias("min_value"),
            F.max("value").over(frame).alias("max_value"),
        ],
    )


def recent_values(
    readings: DataFrame,
    *,
    key: str = "sensor_type",
    order_by: Sequence[str] | None = None,
    history: int = HISTORY,
    slices: int | None = None,
) -> DataFrame:
    """The last ``history`` values at each reading, oldest first."""
    return _over_recent(
        readings, key, order_by, history - 1, 1, slices,
        lambda frame: [F.collect_list("value").over(frame).alias("recent")],
    )


def _over_recent(readings, key, order_by, history, min_rows, slices, measures) -> DataFrame:
    order_by = ["timestamp", *sequence_of(readings)] if order_by is None else list(order_by)
    rows = readings.filter(F.col("value").isNotNull()).select(key, *order_by, "value")
    if slices is not None and slices <= 1:
        # Nothing to cut, so nothing is counted or sampled first.
        frame = Window.partitionBy(key).orderBy(*order_by).rowsBetween(-history, 0)
        seen = rows.select("*", F.count("*").over(frame).alias("_seen"), *measures(frame))
        return seen.filter(F.col("_seen") >= min_rows).drop("_seen")
    window = Window.partitionBy(key, "slice").orderBy(*order_by)
    frame = window.rowsBetween(-history, 0)
    return (
        _sliced(rows, key, order_by, history, slices)
        .select("*", F.count("*").over(frame).alias("_seen"), *measures(frame))
        .filter(~F.col("borrowed") & (F.col("_seen") >= min_rows))
        .drop("slice", "borrowed", "_seen")
    )


def _hour(rows: DataFrame, order_by: list[str]) -> Column:
    """The hour a row is in the order of, null where the order is not one of times."""
    kind = dict(rows.dtypes)[order_by[0]]
    timed = kind.startswith(("timestamp", "date"))
    return F.date_trunc("hour", F.col(order_by[0]).cast("timestamp")) if timed else F.lit(None).cast("timestamp")


def _sliced(
    rows: DataFrame, key: str, order_by: list[str], history: int, slices: int | None
) -> DataFrame:
    """Rows with their slice, and again with the next one where that borrows them.

    Borrowed rows come right before their slice and are ``history`` at least, more
    if so many lie between two sampled rows; the frame takes what it needs.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("_hour", _hour(rows, order_by))
    counts = rows.groupBy(key, "_hour").agg(F.count("*").alias("_rows"))
    # Of hours there is one row each; they are numbered by what lies before them.
    earlier = Window.partitionBy(key).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_earlier", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    hours = stored(counts, working_folder(spark, "hours"))
    total = hours.agg(F.sum("_rows")).first()[0] or 0
    slices = max(1, math.ceil(total / ROWS_PER_SLICE)) if slices is None else slices
    if slices == 1:
        # So few readings need no cut points.
        return rows.select(key, *order_by, "value", F.lit(0).alias("slice"), F.lit(False).alias("borrowed"))
    share = min(1.0, SAMPLED_PER_SLICE * slices / max(1, total))
    step = max(history + 1, round(share * total / slices))
    stretch = F.floor(F.col("_earlier") * slices / (SLICES_PER_STRETCH * max(1, total)))
    stretches = hours.withColumn("_stretch", stretch)
    points = stored(
        _by_hour(hours, _cut_points(rows, stretches, key, order_by, history, share, step), key),
        working_folder(spark, "cut-points"),
    )
    placed = _placed(rows, points, key, order_by)
    here = F.struct(*order_by)
    slice = F.col("_base") + F.col("_local")
    own = F.struct(slice.alias("slice"), F.lit(False).alias("borrowed"))
    next_too = F.struct((slice + 1).alias("slice"), F.lit(True).alias("borrowed"))
    lent = F.get("_since", F.col("_local")) <= here
    return placed.select(
        key,
        *order_by,
        "value",
        F.inline(F.when(lent, F.array(own, next_too)).otherwise(F.array(own))),
    )


def _cut_points(
    rows: DataFrame, hours: DataFrame, key: str, order_by: list[str], history: int, share: float, step: int
) -> DataFrame:
    """Where slices begin, and since where each borrows.

    Of the samples of a stretch, every ``step``-th row is a cut point, and the slice there
    borrows since the sampled row ``history`` before. So at least that many rows
    are borrowed, and, as ``step`` is larger, from one slice only.
    """
    sampled = rows.select(key, "_hour", *order_by)
    if share < 1.0:
        sampled = sampled.sample(share, seed=0)
    stretches = hours.select(F.col(key).alias("_key"), F.col("_hour").alias("_at"), "_stretch")
    sampled = sampled.distinct().join(
        stretches, F.col(key).eqNullSafe(F.col("_key")) & F.col("_hour").eqNullSafe(F.col("_at"))
    )
    along = Window.partitionBy(key, "_stretch").orderBy(*order_by)
    point = F.struct(*order_by)
    return sampled.select(
        key,
        "_hour",
        point.alias("cut"),
        F.lag(point, history).over(along).alias("since"),
        F.row_number().over(along).alias("place"),
    ).filter(F.col("place") % step == 0)


def _by_hour(hours: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """For each key and hour its cuts in order, how many came before, and since where
    each slice that follows one of its rows borrows."""
    grouped = points.groupBy(F.col(key).alias("_key"), F.col("_hour").alias("_at")).agg(
        F.array_sort(F.collect_list("cut")).alias("_cuts"),
        F.array_sort(F.collect_list("since")).alias("_own"),
    )
    along = Window.partitionBy(key).orderBy("_hour")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    after = along.rowsBetween(1, Window.unboundedFollowing)
    cuts = F.coalesce(F.size("_cuts"), F.lit(0))
    following = F.first(F.get("_own", F.lit(0)), ignorenulls=True).over(after)
    return (
        hours.join(
            grouped,
            F.col(key).eqNullSafe(F.col("_key")) & F.col("_hour").eqNullSafe(F.col("_at")),
            "left",
        )
        .select(key, "_hour", "_cuts", "_own", F.when(F.col("_cuts").isNotNull(), cuts).otherwise(0).alias("_n"))
        .select(
            F.col(key).alias("_key"),
            F.col("_hour").alias("_at"),
            "_cuts",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("int").alias("_base"),
            F.when(F.col("_cuts").isNull(), F.array(following))
            .otherwise(F.concat("_own", F.array(following)))
            .alias("_since"),
        )
    )


def _placed(rows: DataFrame, points: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Each row with its hour's points and ``_local``, the number of cuts of that hour not after it.

    A binary search, one step per column: ``_local`` moves on by a power of two
    whenever the cut reached that way is not after the row.
    """
    longest = points.agg(F.max(F.coalesce(F.size("_cuts"), F.lit(0)))).first()[0] or 0
    here = F.struct(*order_by)
    # eqNullSafe, so that rows without a type are cut up like any other. Its size
    # decides how the table of points is joined.
    placed = rows.join(
        points,
        F.col(key).eqNullSafe(F.col("_key")) & F.col("_hour").eqNullSafe(F.col("_at")),
        "left",
    ).withColumn("_local", F.lit(0))
    for power in reversed(range(max(0, longest).bit_length())):
        step = 1 << power
        reached = F.get("_cuts", F.col("_local") + (step - 1))
        placed = placed.withColumn(
            "_local", F.col("_local") + F.when(reached <= here, step).otherwise(0)
        )
    return placed


def last_rows(rows: DataFrame, key: str, order_by: Sequence[str], count: int) -> DataFrame:
    """The last ``count`` rows of each key."""
    from_end = Window.partitionBy(key).orderBy(*(F.desc(name) for name in order_by))
    return (
        rows.withColumn("_back", F.row_number().over(from_end))
        .filter(F.col("_back") <= count)
        .drop("_back")
    )
