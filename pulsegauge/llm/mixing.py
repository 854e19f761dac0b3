"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected the same number of times, its source's target
over its source's size. Laid end to end, these expectations form a line; a comb with
teeth one apart and one random offset picks a document once for every tooth that falls
on it. In order of size the line has the documents of any size evenly under the comb,
so that the words taken come near the target and not just the number of documents.

A source's line is summed in slices, so no source has to fit in a task: a slice is a
band of sizes and one of ``SALTS`` shares, and its place on the line comes from counts.
A band with more than ``SLICE`` documents to a share is cut further by its own counts:
between sizes, and within a size that is too frequent by the hash its documents are
ordered by. Cuts follow the order of the line, so they change no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, row_hash, settled, unwrapped, wrapped

WEIGHTS = (1.0, 2.0, 3.0)
# No source is taken more often than this.
MOST = 3.0
# Shares of a band of sizes, and the documents of a share from which on it is cut further.
SALTS = 16
SLICE = 65_536
SEED = 1
SPAN = 1 << 32


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def band(size: str) -> Column:
    """Sizes within a sixteenth of an octave share a band; bands rise with sizes."""
    bits = f"length(bin({size}))"
    return F.expr(
        f"case when {size} < 16 then {size}"
        f" else ({bits} - 1) * 16 + (shiftright({size}, {bits} - 5) & 15) end"
    )


def _share(text: Column) -> Column:
    """A number below 2**32 from a text, the same in every engine that knows MD5."""
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(8)), 16, 10).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST
) -> DataFrame:
    """``target`` and ``offset`` for a table of one row per source with its ``source_size``.

    Weights go to the sources by code point, null last, in turn. The targets share the
    sum of all sizes; none exceeds ``most`` times its source's size, and what is cut off
    is shared by weight among the others until none is above. That end is a level:
    every source gets ``least(weight * level, cap)``, and sources reach their cap in the
    order of cap over weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    table = F.array(*[F.lit(float(w)) for w in weights])
    # One row per source, so these windows over all of them are small.
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    levelled = (
        sizes.withColumn("weight", F.get(table, turn))
        .withColumn("cap", most * F.col("source_size").cast("double"))
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(after),
        )
        # Cutting a source off raises the level as long as the level is above its cap.
        .withColumn("settled", F.max("level").over(everything))
    )
    target = F.coalesce(F.least(F.col("weight") * F.col("settled"), F.col("cap")), F.col("cap"))
    return levelled.select("source", "source_size", target.alias("target"))


def _key(source: Column) -> Column:
    """A source as text that is never null, so that rows are joined by plain equality."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _cuts(counts: DataFrame) -> DataFrame:
    """For each source and band with too many documents, ``cuts``: where its parts begin.

    A part begins at ``start`` and holds sizes until the next. A size that is too frequent
    by itself is a part of its own, cut by so many ``digits`` of the hash. There is at most
    a part for every ``SLICE`` documents of each share, twice.
    """
    most = SALTS * SLICE
    in_band = Window.partitionBy("_source", "_band")
    before = in_band.orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
    # Of the first four digits the last is the share, so that it cuts nothing.
    needed = F.ceil(F.log(16.0, F.col("n") / most)).cast("int")
    needed = F.greatest(F.lit(1), F.least(needed, F.lit(11)))
    digits = F.when(F.col("n") > most, needed + F.when(needed > 3, 1).otherwise(0)).otherwise(0)
    parts = (
        counts.groupBy("_source", "_band", "_size")
        .agg(F.sum("n").alias("n"))
        .withColumn("all", F.sum("n").over(in_band))
        .withColumn("part", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / most))
        .filter(F.col("all") > most)
        .withColumn("digits", digits)
        .groupBy("_source", "_band", "part", (F.col("digits") > 0).alias("frequent"))
        .agg(F.min("_size").alias("start"), F.max("digits").alias("digits"))
    )
    return parts.groupBy("_source", "_band").agg(
        F.array_sort(F.collect_list(F.struct("start", "digits"))).alias("cuts")
    )


def _cut(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``_part`` of a band, and ``_fine``, the share of a size by hash, both in the line's order.

    Rows without a doc_id have no hash; they come first, in the order of ``_tie``.
    """
    begun = F.coalesce(F.size(F.filter("cuts", lambda c: c["start"] <= F.col("_size"))), F.lit(0))
    # The cuts are a row for at least a million documents, so they are small beside them.
    found = (
        rows.join(F.broadcast(cuts), ["_source", "_band"], "left")
        .withColumn("_part", F.when(F.col("cuts").isNull(), 0).otherwise(begun))
        .withColumn("_digits", F.coalesce(F.get("cuts", F.col("_part") - 1)["digits"], F.lit(0)))
        .drop("cuts")
    )
    if "_tie" not in found.columns:
        return found.withColumn("_fine", F.lit(0).cast("long"))
    hashed = F.conv(F.substr(F.col("_md5"), F.lit(1), F.col("_digits")), 16, 10).cast("long")
    unhashed = F.expr("shiftright(_tie, 64 - 4 * _digits) - shiftleft(1L, 4 * _digits)")
    fine = F.when(F.col("_md5") == "", unhashed).otherwise(hashed)
    return found.withColumn("_fine", F.when(F.col("_digits") > 0, fine).otherwise(0).cast("long"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST,
    size: str | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The documents with ``mix``: size, source_size, target and copies to take of each.

    ``size`` names a column of sizes; without it, the words of ``text`` count. Documents
    of size 0 (a null or blank text) are expected as often as any of their source and
    take no words. A null source is a source of its own. Rows that tie in size are
    ordered by a hash of doc_id and of all of the row; equal rows are interchangeable,
    so reruns agree. An empty table gives none. A column called ``mix`` is replaced.
    """
    kept = docs.drop("mix")
    counted = n_words(F.col("row.text")) if size is None else F.coalesce(F.col(f"row.`{size}`"), F.lit(0))
    placed = (
        wrapped(kept, _tie=row_hash(kept))
        .withColumn("_size", counted.cast("long"))
        .withColumn("_source", _key(F.col("row.source")))
        .withColumn("_md5", F.coalesce(F.md5(F.col("row.doc_id").cast("string")), F.lit("")))
        .withColumn("_band", band("_size"))
        .withColumn("_salt", F.conv(F.substr("_md5", F.lit(1), F.lit(4)), 16, 10).cast("long") % SALTS)
        .withColumn("_salt", F.coalesce("_salt", F.pmod("_tie", F.lit(SALTS))))
    )
    counts = settled(
        placed.groupBy("_source", "_band", "_salt", "_size").agg(
            F.first("row.source").alias("source"), F.count("*").alias("n")
        ),
        "sizes",
    )
    cuts = settled(_cuts(counts), "cuts")
    cutting = not cuts.isEmpty()
    if cutting:
        placed, counts = _cut(placed, cuts), _cut(counts.withColumn("_md5", F.lit("")), cuts)
    else:
        uncut = {"_part": F.lit(0), "_digits": F.lit(0), "_fine": F.lit(0).cast("long")}
        placed, counts = placed.withColumns(uncut), counts.withColumns(uncut)
    slice_of = ["_source", "_band", "_salt", "_part", "_fine"]
    slices = counts.filter("_digits = 0").groupBy(slice_of).agg(F.sum("n").alias("n"))
    if cutting:
        frequent = placed.filter("_digits > 0").groupBy(slice_of).agg(F.count("*").alias("n"))
        slices = slices.unionByName(frequent)
    sources = (
        targets(
            counts.groupBy("_source")
            .agg(F.first("source").alias("source"), F.sum(F.col("n") * F.col("_size")).alias("source_size"))
            .drop("_source"),
            weights,
            most,
        )
        .withColumn(
            "offset",
            _share(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))) / F.lit(float(SPAN)),
        )
        .select(_key(F.col("source")).alias("_source"), "source_size", "target", "offset")
    )
    line = Window.partitionBy("_source").orderBy(slice_of[1:])
    known = slices.withColumn("start", F.sum("n").over(line) - F.col("n")).join(sources, "_source").drop("n")
    within = Window.partitionBy(slice_of).orderBy(
        "_size", "_md5", F.col("row.doc_id").asc_nulls_last(), "_tie"
    )
    # Slices are joined by what the rows are partitioned by already.
    ranked = placed.withColumn("_rank", F.row_number().over(within)).join(known, slice_of)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("start") + F.col("_rank")
    copies = F.floor(place * expected + F.col("offset")) - F.floor(
        (place - 1) * expected + F.col("offset")
    )
    return unwrapped(
        ranked.withColumn(
            "mix",
            F.struct(
                F.col("_size").alias("size"),
                "source_size",
                "target",
                copies.cast("int").alias("copies"),
            ),
        ),
        "mix",
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every document as often as the mix takes it."""
    taken = mix(docs, **options)
    times = F.explode(F.sequence(F.lit(1), F.col("mix.copies")))
    return (
        taken.filter("mix.copies > 0")
        .select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), times.alias("_n"))
        .select("row.*")
    )
