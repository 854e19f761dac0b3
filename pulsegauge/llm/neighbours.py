"""Approximate nearest neighbours by a permutation index.

A vector is described by the order of its nearest pivots. It is posted, with that order,
in the inverted files of the ``POSTED`` nearest; a query visits the files of its own
nearest. In a file candidates are ranked by the footrule distance between their order of
pivots and the query's, and those within a distance are reranked by inner product, each
in the first file of the query's order that holds it. There is no limit on their number.

Pivots grow with the root of the vectors, so files do too. How many files are visited and
up to which distance candidates are reranked is fitted: for a bounded sample of queries
the true neighbours are found in one pass over all vectors, and the settings are the
least that would have met them. Vectors with little structure need many files, clustered
ones few. A query that finds too few goes on to further files, in the end to all.

Equal vectors are posted once, with their smallest ids; that is enough for any query.
Files are cut into blocks of about ``BLOCK`` vectors by the count of each, and queries
meet a file block by block, so a file that holds a third of all vectors is many tasks.
A task keeps the best few of each query, so what leaves it grows with the queries and
not with the files.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

NEAREST = 20
# Pivots for each root of the number of vectors of one length, and at most: the bound of
# what tasks carry along.
DENSITY = 2.0
MOST_PIVOTS = 8192
POSTED = 8
# Queries of one length whose true neighbours are found, to fit the settings below, and
# the share of those neighbours that the settings have to meet.
SAMPLE = 64
TARGET = 0.97
# A query that found too few visits so many times the files.
FURTHER = 4
BLOCK = 8192
# Queries of a file that meet a block in one task, about.
ASKING = 4096
RESULT = "query_id long, rank int, vec_id long, score double"

# The pivots for vectors of each length, of length one, in rows.
Pivots = dict[int, np.ndarray]


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def pivot_order(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """For each vector its nearest pivots, nearest first, by cosine; ties to the first pivot."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
    return np.argsort(-(scaled @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int32)


def footrule(query: np.ndarray, orders: np.ndarray, pivots: int) -> np.ndarray:
    """The footrule distance of an order of pivots to each of ``orders``.

    Both are the front of a full order; a pivot that is missing in one counts as if it
    came right after the last.
    """
    length = orders.shape[1]
    place = np.full(pivots, length, dtype=np.int32)
    place[query[:length]] = np.arange(length)
    # Pivots of the candidate: how far they moved. Those it lacks: how far from the end.
    moved = np.abs(place[orders] - np.arange(length)).sum(axis=1)
    shared = np.where(place[orders] < length, length - place[orders], 0).sum(axis=1)
    return moved + length * (length + 1) // 2 - shared


def _places(order: np.ndarray) -> np.ndarray:
    """Where each pivot stands in a full order."""
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return place


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order whatever rows it is computed with."""
    total = np.zeros(len(vectors))
    for k in range(vectors.shape[1]):
        total += vectors[:, k] * query[k]
    return total


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, as rows."""
    return np.stack([np.frombuffer(v) for v in column.to_pylist()])


def _orders(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length, as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _in_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, by which equal ones are brought together; a zero has no sign."""
    for batch in batches:
        vectors = [(np.array(v, dtype=np.float64) + 0.0).tobytes() for v in batch.column("embedding").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("asks"), pa.array(vectors, pa.binary())],
            names=["id", "asks", "vector"],
        )


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.array([len(v) // 8 for v in batch.column("vector").to_pylist()], dtype=np.int64)
    for n in np.unique(lengths).tolist():
        yield n, batch.take(pa.array(np.flatnonzero(lengths == n)))


def _describing(
    pivots: Pivots, taken: dict[int, int]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``n``, the length, and ``order``, the nearest pivots, as many as are ``taken``."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, part in _by_length(batch):
                orders = pivot_order(_vectors(part.column("vector")), pivots[n], taken[n])
                offsets = np.arange(len(orders) + 1, dtype=np.int32) * orders.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(orders.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([n] * len(orders), pa.int32()), lists],
                    names=[*part.schema.names, "n", "order"],
                )

    return describe


def _best(score: np.ndarray, first: np.ndarray, ids: np.ndarray, most: int) -> list[tuple[float, int]]:
    """The best ``most`` ids of vectors with these scores and ids, each id once.

    ``first`` is the smallest id of each vector.
    """
    taken = most
    while True:
        # A vector beyond so many with different first ids has no id among the best.
        if taken < len(score):
            some = np.flatnonzero(score >= np.partition(score, len(score) - taken)[len(score) - taken])
        else:
            some = np.arange(len(score))
        ranked = some[np.lexsort((first[some], -score[some]))][:taken]
        if taken >= len(score) or len(set(first[ranked].tolist())) >= most:
            break
        taken *= 2
    out: dict[int, float] = {}
    for s, x in sorted((-float(score[i]), x) for i in ranked.tolist() for x in ids[i]):
        if x not in out:
            out[x] = -s
            if len(out) == most:
                break
    return [(s, x) for x, s in out.items()]


def _meeting(
    pivots: Pivots, most: int, far: dict[int, float]
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best of a block of a file for each query that visits it."""

    def met(block: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if block.num_rows and queries.num_rows:
            n, pivot = block.column("n")[0].as_py(), block.column("pivot")[0].as_py()
            count = len(pivots[n])
            vectors, orders = _vectors(block.column("vector")), _orders(block.column("order"))
            ids = np.empty(block.num_rows, dtype=object)
            ids[:] = block.column("ids").to_pylist()
            first = np.array([of[0] for of in ids], dtype=np.int64)
            asked = _vectors(queries.column("vector"))
            for start in range(0, len(asked), 256):
                some = asked[start : start + 256]
                for key, vector, order in zip(
                    queries.column("key")[start : start + 256].to_pylist(), some, pivot_order(some, pivots[n], count)
                ):
                    place = _places(order)
                    # Others are met in a file that comes earlier in the query's order.
                    here = np.flatnonzero(place[orders].min(axis=1) == place[pivot])
                    if far[n] < math.inf:
                        here = here[footrule(order, orders[here], count) <= far[n]]
                    best = _best(exact(vectors[here], vector), first[here], ids[here], most)
                    out[0].extend([key] * len(best))
                    out[1].extend(x for _, x in best)
                    out[2].extend(s for s, _ in best)
        return pa.Table.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
            names=["key", "vec_id", "score"],
        )

    return met


def _visit(
    files: DataFrame, askers: DataFrame, pivots: Pivots, reach: dict[int, int], far: dict[int, float], most: int
) -> DataFrame:
    """key, vec_id, score: the best ``most`` of each asker in the files it reaches."""
    asking = askers.mapInArrow(
        _describing(pivots, reach), "key binary, vector binary, n int, order array<int>"
    ).select("n", F.explode("order").alias("pivot"), "key", "vector")
    held_parts, asking_parts = _parts(files, BLOCK, "blocks"), _parts(asking, ASKING, "parts")
    # One row per pivot each, so both are as small as the pivots are.
    sizes = F.broadcast(held_parts.join(asking_parts, ["n", "pivot"]))

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def own(count: str) -> Column:
        return F.pmod(F.xxhash64("key"), F.col(count)).cast("int")

    key = ["n", "pivot", "block", "part"]
    held = files.join(sizes, ["n", "pivot"]).select(
        "n", "pivot", "vector", "ids", "order", own("blocks").alias("block"), every("parts").alias("part")
    )
    asked = asking.join(sizes, ["n", "pivot"]).select(
        "n", "pivot", "key", "vector", own("parts").alias("part"), every("blocks").alias("block")
    )
    found = (
        held.groupBy(*key)
        .cogroup(asked.groupBy(*key))
        .applyInArrow(_meeting(pivots, most, far), "key binary, vec_id long, score double")
    )
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("key", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("r", F.row_number().over(best))
        .filter(F.col("r") <= most)
        .drop("r")
    )


def _parts(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Into how many parts of about ``size`` rows the rows of each pivot go."""
    return rows.groupBy("n", "pivot").agg(F.ceil(F.count("*") / size).cast("int").alias(name))


def _chosen(held: DataFrame, pivots: int | None) -> Pivots:
    """Pivots for each length: the distinct vectors with the smallest hashes."""
    counts = held.groupBy("n").count().collect()
    wanted = {r["n"]: pivots or min(MOST_PIVOTS, math.ceil(DENSITY * math.sqrt(r["count"]))) for r in counts}
    if not wanted:
        return {}
    first = Window.partitionBy("n").orderBy("key")
    out: dict[int, list] = {}
    for r in (
        held.select("n", "key", "vector")
        .withColumn("r", F.row_number().over(first))
        .filter(F.col("r") <= max(wanted.values()))
        .orderBy("n", "r")
        .collect()
    ):
        if r["r"] <= wanted[r["n"]]:
            out.setdefault(r["n"], []).append(np.frombuffer(r["vector"]))
    scaled = {n: np.stack(v) / np.abs(v).max(axis=1, keepdims=True) for n, v in out.items()}
    return {n: v / np.linalg.norm(v, axis=1, keepdims=True) for n, v in scaled.items()}


def _fitted(
    held: DataFrame, askers: DataFrame, pivots: Pivots, posted: dict[int, int], nearest: int, target: float
) -> tuple[dict[int, int], dict[int, float]]:
    """How many files to visit and up to which distance to rerank, for each length."""
    # Pivots have the smallest hashes and would find their neighbours too easily.
    first = Window.partitionBy("n").orderBy(F.desc("key"))
    sample: dict[int, list] = {}
    for r in (
        askers.withColumn("n", F.expr("cast(octet_length(vector) / 8 as int)"))
        .withColumn("r", F.row_number().over(first))
        .filter(F.col("r") <= SAMPLE)
        .orderBy("n", "r")
        .collect()
    ):
        sample.setdefault(r["n"], []).append((bytes(r["key"]), np.frombuffer(r["vector"])))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = {n: pivot_order(np.stack([v for _, v in s]), pivots[n], len(pivots[n])) for n, s in sample.items()}
        for batch in batches:
            for n, part in _by_length(batch):
                if n not in sample:
                    continue
                vectors = _vectors(part.column("vector"))
                described = pivot_order(vectors, pivots[n], posted[n])
                keys = part.column("key").to_pylist()
                rows = []
                for q, ((key, vector), order) in enumerate(zip(sample[n], orders[n])):
                    score = vectors @ vector
                    best = np.argsort(-score, kind="stable")[: nearest + 1]
                    needed = _places(order)[described[best]].min(axis=1)
                    distance = footrule(order, described[best], len(order))
                    rows += [
                        (n, q, float(score[i]), int(v), int(d))
                        for i, v, d in zip(best.tolist(), needed, distance)
                        if keys[i] != key
                    ]
                columns = list(zip(*rows)) or [[]] * 5
                kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["n", "q", "score", "needed", "distance"]
                )

    best = Window.partitionBy("n", "q").orderBy(F.desc("score"), "needed", "distance")
    true = (
        held.select("key", "vector")
        .mapInArrow(compare, "n int, q int, score double, needed int, distance int")
        .withColumn("r", F.row_number().over(best))
        .filter(F.col("r") <= nearest)
        .collect()
    )
    reach, far = {}, {}
    for n, table in pivots.items():
        pairs = [(r["needed"], r["distance"]) for r in true if r["n"] == n]
        # Between what the target leaves open, half is lost to files and half to distance.
        reach[n] = 1 + _least([v for v, _ in pairs], (1 + target) / 2 * len(pairs))
        met = [d for v, d in pairs if v < reach[n]]
        far[n] = _least(met, target * len(pairs)) if pairs else math.inf
        reach[n] = min(max(reach[n], 1), len(table))
    return reach, far


def _least(values: list[int], count: float) -> int:
    """The least value that ``count`` of the values do not exceed."""
    ranked = sorted(values)
    return ranked[min(len(ranked), max(1, math.ceil(count))) - 1] if ranked else 0


def search(
    vectors: DataFrame,
    is_query: Column,
    nearest: int = NEAREST,
    pivots: int | None = None,
    posted: int = POSTED,
    visited: int | None = None,
    target: float = TARGET,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of each row that ``is_query``.

    Nearest is the largest inner product, ties to the smaller vec_id, the query's own
    vec_id left out. Vectors that are null, zero or hold a null or non-finite component
    take no part, nor does a null vec_id. Vectors of different lengths have no product,
    so each length has an index of its own. A query finds ``nearest``, or all there are.
    Repeated rows of a vec_id count once; where their vectors differ, the best counts.
    A table without vectors gives no rows. Other columns play no part.

    ``pivots`` and ``visited`` set by hand replace what is derived and fitted; all
    candidates of the files visited are then reranked.
    """
    spark = vectors.sparkSession
    rows = (
        vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
        .mapInArrow(_in_bytes, "id long, asks boolean, vector binary")
        .withColumn("key", F.unhex(F.md5("vector")))
    )
    # One more than are returned, as a query may be one of them itself.
    most = nearest + 1
    smallest = Window.partitionBy("key").orderBy("id")
    held = settled(
        rows.groupBy("key", "id")
        .agg(F.first("vector").alias("vector"))
        .withColumn("r", F.row_number().over(smallest))
        .filter(F.col("r") <= most)
        .groupBy("key")
        .agg(
            F.first("vector").alias("vector"),
            F.array_sort(F.collect_list("id")).alias("ids"),
        )
        .withColumn("n", F.expr("cast(octet_length(vector) / 8 as int)")),
        "vectors",
    )
    asks = rows.filter("asks")
    askers = settled(asks.groupBy("key").agg(F.first("vector").alias("vector")), "askers")
    tables = _chosen(held, pivots)
    if not tables:
        return spark.createDataFrame([], RESULT)
    taken = {n: min(posted, len(t)) for n, t in tables.items()}
    if visited is None:
        reach, far = _fitted(held, askers, tables, taken, nearest, target)
    else:
        reach, far = {n: min(visited, len(t)) for n, t in tables.items()}, dict.fromkeys(tables, math.inf)
    files = settled(
        held.select("key", "vector", "ids").mapInArrow(
            _describing(tables, taken), "key binary, vector binary, ids array<long>, n int, order array<int>"
        ),
        "described",
    ).select("n", F.explode("order").alias("pivot"), "key", "vector", "ids", "order")
    found = settled(_visit(files, askers, tables, reach, far, most), "found")
    rounds, short = [found], askers
    while any(reach[n] < len(t) or far[n] < math.inf for n, t in tables.items()):
        enough = rounds[-1].groupBy("key").count().filter(F.col("count") >= most)
        short = settled(short.join(enough, "key", "left_anti"), "short")
        if short.isEmpty():
            break
        reach = {n: min(FURTHER * v, len(tables[n])) for n, v in reach.items()}
        far = dict.fromkeys(tables, math.inf)
        rounds.append(settled(_visit(files, short, tables, reach, far, most), "found"))
    for more in rounds[1:]:
        found = found.unionByName(more)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asks.select("key", F.col("id").alias("query_id"))
        .distinct()
        .join(found, "key")
        .filter(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )
