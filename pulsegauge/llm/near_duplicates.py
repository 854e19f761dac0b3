"""Near duplicates among documents, by an inverted join over signature coordinates.

A document's distinct five-word shingles have ``COORDINATES`` minhashes. Each pair of a
coordinate and its value is a token, and two documents collide as often as they have
tokens in common. Sets similar enough collide ``threshold`` times at least, but for one
pair in 1 / (1 - ``RECALL``). Then:

1. Prefix: a document is posted under its rarest tokens only, so many that two documents
   with enough collisions meet under one of them. Tokens nobody else has come first and
   need no posting, so most documents are not posted at all.
2. Lists: under each token collisions are counted on whole signatures. A list is cut into
   blocks that meet two by two. A document that has been joined is skipped from then on:
   a list gives the edges of a forest and not its pairs.
3. The edges of the forest are confirmed on the full sets. Where that joins all documents
   which hang together, all is known. Elsewhere, those outside of the largest part meet
   all others, and pairs that collide often enough and aren't joined yet are confirmed.

Documents with one set of shingles are one all the way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import settled
from .graph import components
from .similar import shingles, signatures

SHINGLE = 5
SIMILAR = (85, 100)
COORDINATES = 64
RECALL = 0.99999
# Documents of a list, and of what hangs together, that meet in one task, at most about twice.
LIST_BLOCK = 1024
SET_BLOCK = 512
# Edges of one document that are confirmed together.
EDGE_BLOCK = 256
BATCH_BYTES = 2 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DESCRIBED = "doc_id long, text_key string, key string, n long, tokens array<long>, sketch binary"


def threshold(similarity: float, coordinates: int = COORDINATES, target: float = RECALL) -> int:
    """The collisions that sets so similar have with the target probability at least."""
    missed = 0.0
    for k in range(coordinates + 1):
        missed += math.comb(coordinates, k) * similarity**k * (1 - similarity) ** (coordinates - k)
        if missed > 1 - target:
            return k
    return coordinates


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_BYTES``."""
    ends = np.cumsum(np.array([len(t) for t in texts.to_pylist()], dtype=np.int64))
    start = 0
    while start < len(texts):
        held = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, held + BATCH_BYTES, side="right")))
        yield start, end
        start = end


def distinct_sets(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted for each text, and where each text's begin."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.searchsorted(owner[new], np.arange(n + 1))


def _described(width: int, coordinates: int) -> Callable:
    """The name of each document's set of shingles, its size, tokens and sketch."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _chunks(batch.column("text")):
                part = batch.slice(low, high - low)
                n = part.num_rows
                values, owner = shingles(W.split(part.column("text")), width)
                values, first = distinct_sets(values, owner, n)
                size = np.diff(first)
                owner = np.repeat(np.arange(n), size)
                names = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
                for k, name in enumerate(names):
                    np.add.at(name, owner, W.mixed(values * W.U64(2 * k + 3) + W.U64(k)))
                who, minima = signatures(values, owner, coordinates)
                place = np.arange(coordinates, dtype=np.uint64)
                tokens = W.mixed(minima * W.ROLL + place).view(np.int64)
                sketch = (minima & W.U64(0xFFFF)).astype(np.uint16)
                keys, listed, sketches = [None] * n, [None] * n, [None] * n
                for row, i in enumerate(who.tolist()):
                    keys[i] = f"{names[0][i]:016x}{names[1][i]:016x}{size[i]:x}"
                    listed[i] = tokens[row]
                    sketches[i] = sketch[row].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text_key"), pa.array(keys, pa.string()),
                        pa.array(size.astype(np.int64)), pa.array(listed, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "text_key", "key", "n", "tokens", "sketch"],
                )

    return describe


def _lists(sets: DataFrame, prefix: int, coordinates: int) -> DataFrame:
    """``token`` and ``key``: each set under the rarest of its tokens that others have."""
    posted = sets.select("key", F.explode("tokens").alias("token"))
    several = posted.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1")
    common = (
        posted.join(several, "token")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("times", "token"))).alias("common"))
    )
    # A set's own tokens are the rarest and take the first places of its prefix.
    left = F.lit(prefix) - (F.lit(coordinates) - F.size("common"))
    rarest = common.withColumn("left", left).filter("left > 0")
    return rarest.select("key", F.explode(F.slice("common", F.lit(1), F.col("left"))).alias("c")).select(
        "key", "c.token"
    )


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("key"), parts).cast("int")


def _parts(count: str, block: int) -> Column:
    return F.greatest(F.ceil(F.col(count) / block), F.lit(1)).cast("int")


def forest(collide: Callable[[int, np.ndarray], np.ndarray], n: int) -> Iterator[tuple[int, int]]:
    """Pairs of rows that collide, as a forest; what has been joined is skipped.

    ``collide(i, others)`` says with which of the others row ``i`` collides often enough.
    """
    left = np.arange(n)
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            row = todo.pop()
            joined = collide(row, left)
            for other in left[joined].tolist():
                yield other, row
                todo.append(other)
            left = left[~joined]


def _collisions(least: int) -> Callable:
    """Edges between the sets of each list, in two blocks of it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, str]] = []
        now = None

        def edges() -> list[tuple[str, str]]:
            if len(held) < 2:
                return []
            sketch = np.frombuffer(b"".join(s for s, _ in held), np.uint16).reshape(len(held), -1)
            met = lambda i, others: (sketch[others] == sketch[i]).sum(axis=1) >= least
            return [(held[i][1], held[j][1]) for i, j in forest(met, len(held))]

        def packed(found: list[tuple[str, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([e[k] for e in found], pa.string()) for k in range(2)], names=["u", "v"]
            )

        for batch in batches:
            found = []
            columns = (batch.column(name).to_pylist() for name in ("token", "low", "high", "key", "sketch"))
            for *place, key, sketch in zip(*columns):
                if place != now:
                    found += edges()
                    held.clear()
                    now = place
                held.append((sketch, key))
            yield packed(found)
        yield packed(edges())

    return count


def _edges(sets: DataFrame, lists: DataFrame, least: int) -> DataFrame:
    """``u`` and ``v``: a forest over the sets of each list that collide often enough."""
    counts = lists.groupBy("token").agg(F.count("*").alias("members")).filter("members > 1")
    members = lists.join(counts, "token").join(sets.select("key", "sketch"), "key")
    met = (
        members.withColumn("parts", _parts("members", LIST_BLOCK))
        .withColumn("own", _part(F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("token", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "key", "sketch")
        .repartition("token", "low", "high")
        .sortWithinPartitions("token", "low", "high", "key")
        .mapInArrow(_collisions(least), "u string, v string")
    )
    return settled(met.distinct(), "edges")


def linked(a: np.ndarray, b: np.ndarray, similar: tuple[int, int]) -> bool:
    """Whether two sorted sets have the similarity."""
    up, down = similar
    if down * min(len(a), len(b)) < up * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    shared = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
    return shared > 0 and down * shared >= up * (len(a) + len(b) - shared)


def _confirming(similar: tuple[int, int]) -> Callable:
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, other = batch.column("set_u"), batch.column("set_v")
            fits = [
                linked(np.frombuffer(mine[i].as_py(), np.uint64), np.frombuffer(other[i].as_py(), np.uint64), similar)
                for i in range(batch.num_rows)
            ]
            yield batch.select(["u", "v"]).filter(pa.array(fits, pa.bool_()))

    return confirm


def _confirmed(edges: DataFrame, shingled: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The edges whose sets are similar. One document's edges are dealt out in parts."""
    counts = edges.groupBy("v").agg(F.count("*").alias("degree"))
    parts = counts.select("v", _parts("degree", EDGE_BLOCK).alias("parts"))
    dealt = edges.join(parts, "v").withColumn("part", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int"))
    mine = dealt.join(shingled.select(F.col("key").alias("u"), F.col("shingles").alias("set_u")), "u")
    centres = parts.join(shingled.select(F.col("key").alias("v"), F.col("shingles").alias("set_v")), "v").select(
        "v", "set_v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    both = mine.join(centres, ["v", "part"]).select("u", "v", "set_u", "set_v")
    return settled(both.mapInArrow(_confirming(similar), "u string, v string"), "confirmed")


def _others(similar: tuple[int, int], least: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """Links between a block of documents outside of the largest part, and a block of all."""

    def confirm(key: tuple, outside: pa.Table, all_: pa.Table) -> pa.Table:
        found = []
        if outside.num_rows and all_.num_rows:
            keys = all_.column("key").to_pylist()
            part = dict(zip(keys, all_.column("label").to_pylist()))
            part.update(zip(outside.column("key").to_pylist(), outside.column("label").to_pylist()))
            root: dict[str, str] = {}

            def top(label: str) -> str:
                while label in root:
                    label = root[label]
                return label

            sketch = np.frombuffer(b"".join(all_.column("sketch").to_pylist()), np.uint16).reshape(len(keys), -1)
            sets = all_.column("shingles")
            for own, mine, held in zip(
                outside.column("key").to_pylist(), outside.column("sketch").to_pylist(), outside.column("shingles").to_pylist()
            ):
                a = np.frombuffer(held, np.uint64)
                often = np.flatnonzero((sketch == np.frombuffer(mine, np.uint16)).sum(axis=1) >= least)
                for i in often.tolist():
                    u, v = top(part[own]), top(part[keys[i]])
                    if u != v and linked(a, np.frombuffer(sets[i].as_py(), np.uint64), similar):
                        root[u] = v
                        found.append((own, keys[i]))
        return pa.Table.from_arrays([pa.array([e[k] for e in found], pa.string()) for k in range(2)], names=["u", "v"])

    return confirm


def _remaining(
    hanging: DataFrame, links: DataFrame, shingled: DataFrame, similar: tuple[int, int], least: int
) -> tuple[DataFrame, DataFrame]:
    """Links between parts of what hangs together, and ``key`` and ``label`` of all in these parts."""
    labels = components(links).withColumnRenamed("component", "label")
    placed = hanging.join(labels, "node", "left").select(
        "component", F.col("node").alias("key"), F.coalesce("label", "node").alias("label")
    )
    placed = settled(placed, "parts")
    sizes = placed.groupBy("component", "label").agg(F.count("*").alias("n"))
    largest = (
        sizes.groupBy("component")
        .agg(F.max_by("label", "n").alias("largest"), F.sum("n").alias("all"), (F.sum("n") - F.max("n")).alias("rest"))
        .filter("rest > 0")
        .select(
            "component", "largest",
            _parts("all", SET_BLOCK).alias("all_parts"), _parts("rest", SET_BLOCK).alias("rest_parts"),
        )
    )
    held = placed.join(largest, "component").join(shingled, "key")
    # Under new names, as both sides come from one table.
    own = [F.col(name).alias(name) for name in ("component", "key", "label", "sketch", "shingles")]
    outside = held.filter(F.col("label") != F.col("largest")).select(
        *own, _part(F.col("rest_parts")).alias("a"),
        F.explode(F.sequence(F.lit(0), F.col("all_parts") - 1)).alias("b"),
    )
    everyone = held.select(
        *own, _part(F.col("all_parts")).alias("b"),
        F.explode(F.sequence(F.lit(0), F.col("rest_parts") - 1)).alias("a"),
    )
    by = ["component", "a", "b"]
    found = outside.groupBy(*by).cogroup(everyone.groupBy(*by))
    more = settled(found.applyInArrow(_others(similar, least), "u string, v string"), "more-links")
    return more, placed.select("key", "label")


def _joined(parts: DataFrame, more: DataFrame) -> DataFrame:
    """``key`` and ``component`` once the parts have been joined by the links found later."""
    ends = [parts.select(F.col("key").alias(end), F.col("label").alias(f"label_{end}")) for end in "uv"]
    between = more.join(ends[0], "u").join(ends[1], "v")
    between = between.select(F.col("label_u").alias("u"), F.col("label_v").alias("v"))
    wider = components(between).withColumnRenamed("node", "label")
    return parts.join(wider, "label", "left").select("key", F.coalesce("component", "label").alias("component"))


def _shingled(width: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _chunks(batch.column("text")):
                part = batch.slice(low, high - low)
                values, first = distinct_sets(*shingles(W.split(part.column("text")), width), part.num_rows)
                sets = [values[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("sketch"), pa.array(sets, pa.binary())],
                    names=["key", "sketch", "shingles"],
                )

    return cut


def near_duplicates(
    docs: DataFrame,
    width: int = SHINGLE,
    similar: tuple[int, int] = SIMILAR,
    coordinates: int = COORDINATES,
    target: float = RECALL,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``.

    Words are runs of anything but the six ASCII blanks, A-Z in lower case. Two documents
    are linked if their sets of shingles have the similarity, and a component is named
    after its smallest doc_id. A text of fewer words than a shingle has one, all of them;
    one without words, null ones too, has none and is linked with nothing. Sets are
    compared by 64-bit hashes of their shingles, and are the same if 128 bits of sums and
    the size are. Of a component without any doc_id the id is null. ``kept`` rows are those
    with the component's id, so repeated rows are kept together, as are rows of such a
    component. An empty table gives none. Other columns play no part.
    """
    least = threshold(similar[0] / similar[1], coordinates, target)
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_key"), text.alias("text")
    )
    described = settled(plain.mapInArrow(_described(width, coordinates), DESCRIBED), "signatures")
    worded = described.filter("n > 0")
    firsts = worded.groupBy("key").agg(F.min("doc_id").alias("first_id"))
    # The set's tokens once, with a text to find it in.
    one = (
        worded.alias("d")
        .join(
            firsts.alias("f"),
            (F.col("d.key") == F.col("f.key")) & F.col("d.doc_id").eqNullSafe(F.col("f.first_id")),
        )
        .select("d.key", "f.first_id", "d.text_key", "d.tokens", "d.sketch")
        .dropDuplicates(["key"])
    )
    sets = settled(one, "sets")
    lists = settled(_lists(sets, coordinates - least + 1, coordinates), "lists")
    edges = _edges(sets, lists, least)
    hanging = components(edges)
    wanted = sets.join(hanging.select(F.col("node").alias("key")), "key", "left_semi")
    found = plain.alias("d").join(
        wanted.alias("w"),
        (F.col("d.text_key") == F.col("w.text_key")) & F.col("d.doc_id").eqNullSafe(F.col("w.first_id")),
    )
    shingled = settled(
        found.select("w.key", "w.sketch", "d.text")
        .mapInArrow(_shingled(width), "key string, sketch binary, shingles binary")
        .dropDuplicates(["key"]),
        "shingles",
    )
    links = _confirmed(edges, shingled, similar)
    more, parts = _remaining(hanging, links, shingled, similar, least)
    joined = _joined(parts, more)
    owned = firsts.join(joined, "key", "left").select(
        "key", "first_id", F.coalesce("component", "key").alias("component")
    )
    ids = owned.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = settled(owned.join(ids, "component").select("key", "component_id"), "components")
    rows = described.select("doc_id", "n", F.coalesce("key", F.lit("")).alias("key"))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(named, "key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
