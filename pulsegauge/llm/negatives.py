"""Hard negatives of anchors, by bounds along a spanning tree of the anchors.

Anchors are brought together by the nearest of a few pivots, and each group gets a
minimum spanning tree of Euclidean distances. The scores of a block of candidates are
worked out at the root. From there on, a candidate ``x`` whose score at the parent lies
between two bounds has at the child a score at most ``edge * |x|`` away from them. Only
candidates whose bounds meet what is looked for are scored again; the others keep bounds.
What is looked for are, in a first pass, the best of the anchor's own label, and in a
second one other labels within the windows that the positives found set.

Groups meet blocks of candidates; a task holds one of each and gives the best few of each
anchor, or of each window. Vectors of different lengths have no inner product and never
meet.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

POSITIVES = 5
NEGATIVES = 3
SCALE = 256
# A negative scores between these hundredths of the positive's score.
LEAST, MOST = 50, 95
# Anchors of a tree, and candidates of a block, about.
GROUP = 2048
BLOCK = 8192
# Anchors that others gather around: the bound of the sample the driver holds.
PIVOTS = 64
# Below this, sums of products of whole numbers are exact in a double.
EXACT = 2.0**53
ROWS = "size int, id long, label long, vector binary"
TREES = "size int, grp int, place int, parent int, edge double, id long, label long, vector binary"
SCORED = "anchor_id long, vec_id long, score long"
FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def whole(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null for a vector that takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return F.when(usable, scaled)


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=np.float64).reshape(-1, size) if size else np.zeros((len(column), 0))


def scores(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Inner products, exact; in whole numbers without bounds where doubles are not."""
    most = np.abs(vectors).max(initial=0) * np.abs(one).max(initial=0) * max(1, len(one))
    if most < EXACT:
        return (vectors @ one).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(v, one)) for v in vectors.tolist()]
    if any(abs(x) >= 1 << 63 for x in exact):
        raise OverflowError("an inner product does not fit a long")
    return np.array(exact, dtype=np.int64)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order to visit vectors in, each one's parent, and the distance to it.

    Prim's algorithm from the first vector, so a parent comes before its children.
    """
    n = len(vectors)
    near, parent = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
    order, edge = np.zeros(n, dtype=np.int64), np.zeros(n)
    inside = np.zeros(n, dtype=bool)
    now = 0
    for k in range(n):
        order[k], inside[now] = now, True
        edge[now] = near[now] if k else 0.0
        far = np.linalg.norm(vectors - vectors[now], axis=1)
        closer = ~inside & (far < near)
        near[closer], parent[closer] = far[closer], now
        now = int(np.argmin(np.where(inside, np.inf, near)))
    return order, parent, edge


def _tree(key: tuple, rows: pa.Table) -> pa.Table:
    """The anchors of a group in the order of their tree; equal ids are one anchor."""
    rows = _distinct(rows)
    size = key[0].as_py()
    vectors = _matrix(rows.column("vector"), size)
    order, parent, edge = spanning_tree(vectors)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return pa.Table.from_arrays(
        [
            pa.array([size] * len(order), pa.int32()),
            pa.array([key[1].as_py()] * len(order), pa.int32()),
            pa.array(np.arange(len(order)), pa.int32()),
            pa.array(place[parent[order]], pa.int32()),
            pa.array(edge[order]),
            *(rows.column(name).take(pa.array(order)) for name in ("id", "label", "vector")),
        ],
        names=[part.split()[0] for part in TREES.split(", ")],
    )


def _distinct(rows: pa.Table) -> pa.Table:
    """One row of each id, that with the smallest label and then vector."""
    ids, labels, vectors = (rows.column(name).to_pylist() for name in ("id", "label", "vector"))
    first = {}
    for i in range(len(ids)):
        j = first.setdefault(ids[i], i)
        if (labels[i], vectors[i]) < (labels[j], vectors[j]):
            first[ids[i]] = i
    return rows.take(pa.array(sorted(first.values(), key=ids.__getitem__), pa.int64()))


class Bounds:
    """Bounds of the scores of a block's candidates at each anchor, kept while needed."""

    def __init__(self, candidates: np.ndarray, tree: pa.Table, size: int) -> None:
        self.candidates, self.anchors = candidates, _matrix(tree.column("vector"), size)
        self.norms = np.linalg.norm(candidates, axis=1)
        self.parent = tree.column("parent").to_numpy()
        self.edge = tree.column("edge").to_numpy()
        self.children = np.bincount(self.parent[1:], minlength=len(self.parent)) if len(self.parent) else []
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def walk(self, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each anchor with the candidates ``wanted`` by their bounds, and their scores."""
        for k in range(len(self.parent)):
            if k == 0:
                low = scores(self.candidates, self.anchors[0]).astype(np.float64)
                high = low.copy()
            else:
                p = int(self.parent[k])
                above = self.held[p]
                # A little wider, as distances, norms and large scores are rounded.
                size = np.maximum(np.abs(above[0]), np.abs(above[1]))
                room = self.edge[k] * self.norms * (1 + 1e-9) + size * 1e-12 + 1e-6
                low, high = above[0] - room, above[1] + room
                self.children[p] -= 1
                if not self.children[p]:
                    del self.held[p]
            chosen = wanted(k, low, high)
            exact = scores(self.candidates[chosen], self.anchors[k])
            low[chosen] = high[chosen] = exact
            if self.children[k]:
                self.held[k] = low, high
            yield k, chosen, exact


def _best(block: pa.Table, tree: pa.Table, size: int, count: int) -> Iterator[tuple]:
    """The best ``count`` candidates of an anchor's label, for each anchor."""
    block = _distinct(block)
    ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
    anchors, own = tree.column("id").to_numpy(), tree.column("label").to_numpy()
    bounds = Bounds(_matrix(block.column("vector"), size), tree, size)
    by_label = {label: np.flatnonzero(labels == label) for label in np.unique(own).tolist()}

    def wanted(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        same = by_label[int(own[k])]
        same = same[ids[same] != anchors[k]]
        if len(same) <= count:
            return same
        least = np.partition(low[same], len(same) - count)[len(same) - count]
        return same[high[same] >= least]

    for k, chosen, exact in bounds.walk(wanted):
        top = np.lexsort((ids[chosen], -exact))[:count]
        for i in top:
            yield int(anchors[k]), int(ids[chosen[i]]), int(exact[i])


def window(positive: int) -> tuple[int, int]:
    """The whole scores a negative of this positive may have, both included."""
    return -(-LEAST * positive // 100), MOST * positive // 100


def _hard(block: pa.Table, tree: pa.Table, size: int, count: int) -> Iterator[tuple]:
    """The best ``count`` candidates of other labels within the window of each positive."""
    block = _distinct(block)
    ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
    anchors, own = tree.column("id").to_numpy(), tree.column("label").to_numpy()
    positives = tree.column("positives").to_pylist()
    windows = [
        [(p["vec_id"], p["score"], *window(p["score"])) for p in listed or []] for listed in positives
    ]
    bounds = Bounds(_matrix(block.column("vector"), size), tree, size)

    def wanted(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        meets = np.zeros(len(ids), dtype=bool)
        for _, _, least, most in windows[k]:
            if least <= most:
                meets |= (high >= least) & (low <= most)
        return np.flatnonzero(meets & (labels != own[k]))

    for k, chosen, exact in bounds.walk(wanted):
        order = np.lexsort((ids[chosen], -exact))
        chosen, exact = chosen[order], exact[order]
        for positive, score, least, most in windows[k]:
            within = np.flatnonzero((exact >= least) & (exact <= most))[:count]
            for i in within:
                yield int(anchors[k]), positive, score, int(ids[chosen[i]]), int(exact[i])


def _task(work: Callable, count: int, schema: str) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(key: tuple, block: pa.Table, tree: pa.Table) -> pa.Table:
        rows = list(work(block, tree.sort_by("place"), key[0].as_py(), count)) if block.num_rows and tree.num_rows else []
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.Table.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    return run


def _grouped(anchors: DataFrame, group: int, pivots: int) -> DataFrame:
    """Anchors with their group: the nearest pivot's, cut by hash into parts of about ``group``."""
    counts = {r["size"]: r["count"] for r in anchors.groupBy("size").count().collect()}
    total = sum(counts.values())
    wanted = min(pivots, math.ceil(total / group))
    chosen = anchors.orderBy(F.xxhash64("id"), "id").limit(wanted if wanted > 1 else 0).collect()
    by_size: dict[int, np.ndarray] = {}
    for size in {r["size"] for r in chosen}:
        by_size[size] = np.stack([np.frombuffer(r["vector"]) for r in chosen if r["size"] == size])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, dtype=np.int32)
            sizes = batch.column("size").to_numpy()
            for size, table in by_size.items():
                rows = np.flatnonzero(sizes == size)
                if len(rows):
                    vectors = _matrix(batch.column("vector").take(pa.array(rows)), size)
                    near = ((table**2).sum(axis=1) - 2 * vectors @ table.T).argmin(axis=1)
                    found[rows] = near
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "pivot"])

    placed = anchors.mapInArrow(nearest, ROWS + ", pivot int")
    parts = placed.groupBy("size", "pivot").agg(F.ceil(F.count("*") / group).cast("int").alias("parts"))
    # Numbered by size and pivot: a row per pivot and length.
    before = Window.partitionBy("size").orderBy("pivot").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("first", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    return placed.join(parts, ["size", "pivot"]).select(
        "size", (F.col("first") + own).alias("grp"), "id", "label", "vector"
    )


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
    group: int = GROUP,
    block: int = BLOCK,
    pivots: int = PIVOTS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Of each row that ``is_anchor``, its ``positives`` best other rows of the same label,
    and for each of them the ``negatives`` best rows of other labels that score between
    ``LEAST`` and ``MOST`` hundredths of it. A score is the inner product of the
    components as whole numbers ``floor(scale * x)``; ties go to the smaller vec_id.

    Rows with a null vec_id, label or vector, or a null or non-finite component take no
    part. Of rows with one vec_id, that with the smallest label, and then vector, counts.
    A vector has no score with one of another length. Results are exact whatever their size:
    a score beyond 64 bits raises. An empty table, and anchors without others of
    their label, give no rows. Other columns play no part.
    """
    label = F.col("label") if label is None else label
    usable = rows.select(
        F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"),
        whole(F.col("embedding"), scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).filter("id is not null and label is not null and v is not null")
    packed = settled(
        usable.mapInArrow(_packing, ROWS + ", asks boolean"), "vectors"
    )
    # One row of each id, before anchors are told apart by length.
    first = packed.filter("asks").groupBy("id").agg(F.min(F.struct("label", "vector", "size")).alias("r"))
    anchors = settled(first.select("r.size", "id", "r.label", "r.vector"), "anchors")
    trees = settled(
        _grouped(anchors, group, pivots).groupBy("size", "grp").applyInArrow(_tree, TREES), "trees"
    )
    # A row per length and group: as many as a task's anchors fit into all anchors.
    groups = trees.groupBy("size").agg((F.max("grp") + 1).alias("groups"))
    count = packed.count()
    blocks = max(1, math.ceil(count / block))
    held = packed.join(groups, "size").select(
        "size",
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("grp"),
        "id", "label", "vector",
    )
    key = ["size", "grp", "block"]
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")

    def met(asking: DataFrame, work: Callable, best: int, schema: str) -> DataFrame:
        sent = asking.select("*", every)
        return held.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(_task(work, best, schema), schema)

    def first_of(found: DataFrame, by: list[str], best: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)

    own = first_of(met(trees, _best, positives, SCORED), ["anchor_id"], positives)
    listed = own.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct("vec_id", "score")).alias("positives")
    )
    asking = settled(trees.join(listed, "id", "left"), "windows")
    found = met(asking, _hard, negatives, FOUND)
    return first_of(found, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; a negative nought is a nought."""
    for batch in batches:
        lists = batch.column("v")
        sizes = lists.value_lengths()
        data = (lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0).tobytes()
        ends = np.cumsum(np.r_[0, sizes.to_numpy()]) * 8
        vectors = [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [sizes.cast(pa.int32()), batch.column("id"), batch.column("label"), pa.array(vectors, pa.binary()), batch.column("asks")],
            names=["size", "id", "label", "vector", "asks"],
        )
