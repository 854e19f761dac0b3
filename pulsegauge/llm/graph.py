"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows: a row per edge."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = settled(least, "least")
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = settled(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    others = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.filter(F.col("u") != F.col("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    ).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    known = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return known.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node, for every node of an edge ``u``, ``v``.

    Stars are built in turn from larger and smaller neighbours until there is nothing else,
    which takes about the logarithm of the longest path; a graph of stars takes no turn.
    Smallest neighbours come from an aggregate that is written and joined back, so that a
    node with very many edges is summed in parts, and the join can split its edges: adaptive
    execution does so only where both sides come straight from a shuffle. Loops and edges
    with a null are left out.
    """
    now = settled(
        edges.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    while not _are_stars(now):
        now = settled(_small_star(_large_star(now)), "stars")
    linked = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return linked.unionByName(
        linked.select(F.col("component").alias("node"), "component").distinct()
    )
