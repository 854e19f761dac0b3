"""Documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from a MinHash LSH forest. Each of ``TREES`` tries is keyed by its own
sequence of ``DEPTH`` minhashes; texts that share a prefix are candidates. The keys of
each trie are sorted, which lays texts with the longest common prefixes next to each
other, and one pass over them counts the pairs that share a prefix of each length. All
tries begin at full depth. While a pair just similar enough would be found with less than
the target recall, that trie is shortened by one whose shorter prefix adds the fewest
pairs for what it adds to the recall. So tries end at different depths: those with common
prefixes stay deep, the others make up for it. Then:

1. Texts that share a prefix are compared by one-byte sketches of all their minhashes,
   and joined where they look similar. A bucket sends out a spanning star and not its
   pairs; a large one is cut into blocks that meet two by two.
2. Within each component of these joins, all pairs are verified exactly on the hashed
   shingles, again in blocks of bounded size. So a link is found too if its ends never
   shared a prefix but hang together through others. Only the number of links of each
   text and a spanning forest leave the task.
3. Components of the verified forest are the classes.

Equal texts are one text all the way, so copies cost nothing but their row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import settled
from .graph import components

SHINGLE = 5
SIMILAR = (4, 5)
TREES = 24
DEPTH = 8
RECALL = 0.99999
# Sketches that agree this much are joined; texts 0.8 similar do, but for one in 10**8.
LOOKS_SIMILAR = 0.56
# Texts of a bucket, and of a component, that meet in one task, at most about twice.
BUCKET_BLOCK = 1024
VERIFY_BLOCK = 384
# Texts whose minhashes are worked out at once, in bytes.
BATCH_BYTES = 2 << 20
COLUMNS = 4096
SEEDS = 0x2545F4914F6CDD1D


def recall(similarity: float, depths: Sequence[int]) -> float:
    """How surely a pair shares a prefix of the trie's depth in one of the tries at least."""
    return 1 - math.prod(1 - similarity**depth for depth in depths)


def shortened(similarity: float, pairs: dict[tuple[int, int], int], trees: int, depth: int, target: float) -> list[int]:
    """The depth of each trie that reaches the target recall, or 1.

    ``pairs`` has how many pairs of texts share a prefix of a trie and length; the trie
    shortened next is that with the fewest new ones for what is gained, of equal ones
    the deepest.
    """

    def price(t: int) -> tuple[float, int, int]:
        new = pairs.get((t, depths[t] - 1), 0) - pairs.get((t, depths[t]), 0)
        gain = math.log1p(-(similarity ** depths[t])) - math.log1p(-(similarity ** (depths[t] - 1)))
        return new / gain, -depths[t], t

    depths = [depth] * trees
    while recall(similarity, depths) < target and max(depths) > 1:
        t = min((t for t in range(trees) if depths[t] > 1), key=price)
        depths[t] -= 1
    return depths


def shingles(words: W.Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shingles and the text of each. A text of fewer words has one, all its words."""
    hashed = W.hashes(words)
    n = len(hashed)
    rolled = W.windows(hashed, width)
    at = np.arange(len(rolled))
    whole = at + width <= words.first[words.text[: len(rolled)] + 1]
    values, owner = rolled[whole], words.text[: len(rolled)][whole]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        few = []
        for i in short:
            h = W.U64(0)
            for x in hashed[words.first[i] : words.first[i + 1]]:
                h = W.mixed(np.array([h ^ x]))[0]
            few.append(h)
        values, owner = np.append(values, np.array(few, np.uint64)), np.append(owner, short)
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    return values, owner


def signatures(values: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a shingle, and ``count`` minhashes of each."""
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    out = np.empty((count, len(first)), dtype=np.uint64)
    seeds = W.mixed(np.arange(1, count + 1, dtype=np.uint64) * W.U64(SEEDS)) | W.U64(1)
    for k in range(count if len(first) else 0):
        out[k] = np.minimum.reduceat((values ^ seeds[k] >> W.U64(7)) * seeds[k], first)
    return owner[first], W.mixed(out.T)


def _sub_batches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        held += size
        if held >= BATCH_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _described(trees: int, depth: int, width: int) -> Callable:
    """The key of each text in each trie, and its sketch."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("key")
            for low, high in _sub_batches(texts):
                values, owner = shingles(W.split(texts[low:high]), width)
                who, minima = signatures(values, owner, trees * depth)
                if not len(who):
                    continue
                sketch = (minima & W.U64(255)).astype(np.uint8)
                # Numbers of four bytes, the first one foremost, so that they sort as bytes.
                levels = (minima >> W.U64(32)).astype(">u4").tobytes()
                size = 4 * depth
                places = pa.array(np.arange(len(who) + 1, dtype=np.int32) * trees)
                tries = pa.array([levels[at : at + size] for at in range(0, len(levels), size)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        keys[low:high].take(pa.array(who)),
                        pa.ListArray.from_arrays(places, tries),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                    ],
                    names=["key", "tries", "sketch"],
                )

    return describe


def _shared(depth: int) -> Callable:
    """How many pairs share a prefix of each length, from the sorted keys of the tries.

    Runs are counted as they pass; one that goes on in another partition counts twice as
    two shorter ones, which makes no odds to what is found.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[tuple[int, int], int] = {}
        before, runs = None, [0] * (depth + 1)

        def add(trie: int, k: int, length: int) -> None:
            pairs[trie, k] = pairs.get((trie, k), 0) + length * (length - 1) // 2

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            trie = batch.column("trie").to_numpy()
            keys = np.frombuffer(b"".join(batch.column("sig").to_pylist()), ">u4").reshape(n, depth)
            new = np.ones(n, dtype=bool)
            new[1:] = trie[1:] != trie[:-1]
            new[0] = before is None or before[0] != trie[0]
            for k in range(1, depth + 1):
                new[1:] |= keys[1:, k - 1] != keys[:-1, k - 1]
                new[0] |= before is None or before[1][k - 1] != keys[0, k - 1]
                first = np.flatnonzero(new)
                if not len(first):
                    runs[k] += n
                    continue
                if before is not None:
                    add(before[0], k, runs[k] + int(first[0]))
                length = np.diff(first)
                for t in np.unique(trie[first[:-1]][length > 1]).tolist():
                    own = length[trie[first[:-1]] == t]
                    pairs[t, k] = pairs.get((t, k), 0) + int((own * (own - 1) // 2).sum())
                runs[k] = n - int(first[-1])
            before = int(trie[-1]), keys[-1].copy()
        if before is not None:
            for k in range(1, depth + 1):
                add(before[0], k, runs[k])
        rows = [(t, k, n) for (t, k), n in pairs.items() if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.int64()))],
            names=["trie", "depth", "pairs"],
        )

    return count


def forest_depths(
    described: DataFrame, similarity: float, trees: int, depth: int, target: float
) -> list[int]:
    """The depth of each trie for these texts. A number per trie and depth comes to the driver."""
    keys = described.select(F.posexplode("tries").alias("trie", "sig"))
    counted = (
        keys.repartitionByRange("trie", "sig")
        .sortWithinPartitions("trie", "sig")
        .mapInArrow(_shared(depth), "trie int, depth int, pairs long")
        .groupBy("trie", "depth")
        .agg(F.sum("pairs").alias("pairs"))
    )
    pairs = {(r["trie"], r["depth"]): r["pairs"] for r in counted.collect()}
    return shortened(similarity, pairs, trees, depth, target)


def _in_blocks(members: DataFrame, group: str, count: Column, block: int) -> DataFrame:
    """``low`` and ``high``: for each row the pairs of blocks of its group it takes part in."""
    parts = F.greatest(F.ceil(count / block), F.lit(1)).cast("int")
    return (
        members.withColumn("_parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("key"), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.expr("sequence(0, _parts - 1)")))
        .withColumn("low", F.least("own", "_other"))
        .withColumn("high", F.greatest("own", "_other"))
        .drop("_parts", "_other")
    )


def _whole_groups(
    batches: Iterator[pa.RecordBatch], by: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables that hold whole groups, with where each group begins."""
    held: pa.Table | None = None

    def cuts(rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, dtype=bool)
        new[:1] = True
        for name in by:
            values = rows.column(name).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        first = cuts(held)
        if len(first) > 1:
            yield held.slice(0, first[-1]), first[:-1]
            held = held.slice(first[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield held, cuts(held)


def _stars(alike: Callable[[int, np.ndarray], np.ndarray], n: int) -> Iterator[tuple[int, int]]:
    """A spanning star for each component of ``n`` rows: pairs of a row and its centre.

    ``alike(i, others)`` says which of the others row ``i`` is joined to.
    """
    left = np.arange(n)
    while len(left):
        centre, left = int(left[0]), left[1:]
        todo = [centre]
        while todo and len(left):
            row = todo.pop()
            joined = alike(row, left)
            for other in left[joined].tolist():
                yield other, centre
                todo.append(other)
            left = left[~joined]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between texts of a bucket whose sketches look similar."""
    for rows, first in _whole_groups(batches, ["bucket", "low", "high"]):
        keys = rows.column("key").to_pylist()
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8)
        sketch = sketch.reshape(len(keys), -1)
        least = LOOKS_SIMILAR * sketch.shape[1]
        edges = []
        ends = np.append(first[1:], len(keys))
        pairs = first[ends - first == 2]
        fits = (sketch[pairs] == sketch[pairs + 1]).sum(axis=1) >= least
        edges += [(keys[i], keys[i + 1]) for i in pairs[fits].tolist()]
        for a, b in zip(first.tolist(), ends.tolist()):
            if b - a > 2:
                own = sketch[a:b]
                near = lambda i, others: (own[others] == own[i]).sum(axis=1) >= least  # noqa: B023, E731
                edges += [(keys[a + i], keys[a + j]) for i, j in _stars(near, b - a)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([e[0] for e in edges], pa.string()), pa.array([e[1] for e in edges], pa.string())],
            names=["u", "v"],
        )


def common_shingles(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, and for each two texts how many they share."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    sizes = np.bincount(owner, minlength=n)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    several = times[column] > 1
    column = (np.cumsum(times > 1) - 1)[column[several]]
    row = owner[several]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    shared = np.zeros((n, n), dtype=np.float32)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(column, column[at] + COLUMNS))
        held = np.zeros((n, min(COLUMNS, int(column[end - 1] - column[at]) + 1)), dtype=np.float32)
        held[row[at:end], column[at:end] - column[at]] = 1
        shared += held @ held.T
        at = end
    return sizes, shared.astype(np.int64)


def _verified(width: int, similar: tuple[int, int]) -> Callable[[tuple, pa.Table], pa.Table]:
    """Links of each text in two blocks of a component, and the centre of its star."""
    up, down = similar

    def verify(key: tuple, rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_pylist()
        once = np.array(sorted({k: i for i, k in enumerate(keys)}.values()), dtype=np.int64)
        rows = rows.take(pa.array(once))
        keys = rows.column("key").to_pylist()
        own = rows.column("own").to_numpy()
        n = len(keys)
        values, owner = shingles(W.split(rows.column("text")), width)
        sizes, shared = common_shingles(values, owner, n)
        union = sizes[:, None] + sizes[None, :] - shared
        link = (down * shared >= up * union) & (shared > 0)
        np.fill_diagonal(link, False)
        low, high = key[1].as_py(), key[2].as_py()
        if low != high:
            # Pairs within a block are for the task that has the block alone.
            link &= own[:, None] != own[None, :]
        centres = dict(_stars(lambda i, others: link[i, others], n))
        return pa.Table.from_arrays(
            [
                pa.array(keys, pa.string()),
                pa.array(link.sum(axis=1), pa.int64()),
                pa.array([keys[centres[i]] if i in centres else None for i in range(n)], pa.string()),
            ],
            names=["key", "links", "centre"],
        )

    return verify


def _key(text: str | Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def similarity_classes(
    docs: DataFrame,
    width: int = SHINGLE,
    similar: tuple[int, int] = SIMILAR,
    trees: int = TREES,
    target: float = RECALL,
) -> DataFrame:
    """``key``, ``class_id``, ``class_key``, ``first_id``, ``copies``, ``n_links`` for every distinct text.

    ``key`` is the MD5 of the text; ``copies`` documents have it, the smallest doc_id of
    which is ``first_id``. ``n_links`` counts the other texts at least ``similar`` to
    it, and a class is a component of these links; its id is its smallest doc_id. A text
    of fewer than ``width`` words has one shingle, all of them; one without words, null
    ones too, is linked to none. A class of null doc_ids only has a null id, and
    ``class_key`` tells it apart. An empty table gives none.
    """
    depth = DEPTH
    keyed = docs.select(_key("text").alias("key"), "text", F.col("doc_id").cast("long").alias("doc_id"))
    texts = keyed.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    described = settled(
        keyed.select("key", "text")
        .mapInArrow(_described(trees, depth, width), "key string, tries array<binary>, sketch binary")
        .dropDuplicates(["key"]),
        "sketches",
    )
    depths = forest_depths(described, similar[0] / similar[1], trees, depth, target)
    sizes = F.array(*[F.lit(4 * d) for d in depths])
    prefix = F.substring(F.col("sig"), F.lit(1), F.get(sizes, F.col("trie")))
    posted = described.select("key", F.posexplode("tries").alias("trie", "sig")).select(
        "key", F.xxhash64("trie", prefix).alias("bucket")
    )
    several = posted.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = posted.join(several, "bucket").join(described.select("key", "sketch"), "key")
    joined = (
        _in_blocks(members, "bucket", F.col("n"), BUCKET_BLOCK)
        .select("bucket", "low", "high", "key", "sketch")
        .repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high", "key")
        .mapInArrow(_joined, "u string, v string")
    )
    candidates = components(joined)
    sizes = candidates.groupBy("component").agg(F.count("*").alias("n"))
    placed = _in_blocks(
        candidates.join(sizes, "component").withColumnRenamed("node", "key"),
        "component", F.col("n"), VERIFY_BLOCK,
    ).join(texts.select("key", "first_id"), "key")
    verified = settled(
        keyed.alias("d")
        .join(
            placed.alias("p"),
            (F.col("d.key") == F.col("p.key")) & F.col("d.doc_id").eqNullSafe(F.col("p.first_id")),
        )
        .select("p.component", "p.low", "p.high", "p.key", "p.own", "d.text")
        .groupBy("component", "low", "high")
        .applyInArrow(_verified(width, similar), "key string, links long, centre string"),
        "verified",
    )
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    linked = components(verified.select(F.col("key").alias("u"), F.col("centre").alias("v")))
    owned = (
        texts.join(links, "key", "left")
        .join(linked.withColumnRenamed("node", "key"), "key", "left")
        .select(
            "key",
            "first_id",
            "copies",
            F.coalesce("component", "key").alias("class_key"),
            F.coalesce("links", F.lit(0)).alias("n_links"),
        )
    )
    ids = owned.groupBy("class_key").agg(F.min("first_id").alias("class_id"))
    return owned.join(ids, "class_key")


def join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_copies and n_links of every document, repeated rows too.

    ``n_copies`` counts the other documents with the very same text, ``n_links`` the
    other texts that are similar to it. See ``similarity_classes``.
    """
    classes = settled(similarity_classes(docs, **options), "classes")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key("text").alias("key"))
    return keyed.join(classes, "key").select(
        "doc_id", "class_id", (F.col("copies") - 1).alias("n_copies"), "n_links"
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, with its columns: that with the smallest doc_id.

    Of rows that share that doc_id and class one stays. A text without words is a class
    of its own with its copies.
    """
    classes = settled(similarity_classes(docs, **options), "classes")
    first = classes.filter(F.col("first_id").eqNullSafe(F.col("class_id"))).select(
        "key", "class_key", "first_id"
    )
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = plain.withColumn("_key", _key("row.text")).join(
        first,
        (F.col("_key") == F.col("key")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("first_id")),
    )
    return kept.dropDuplicates(["class_key"]).select("row.*")
