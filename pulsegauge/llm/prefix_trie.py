"""A prefix trie of conversations that begin with the turns of others.

A conversation is rebuilt as the head of a base conversation and the rest of its own
turns. The texts are never put together. Turns have fingerprints that compose: a run of
turns is its length and a sum of ``turn * BASE ** place`` modulo a prime, and two runs
join to one by shifting the second. So the fingerprint of every rebuilt prefix follows
from the sums over the base's head and over the conversation's own turns, and equal
prefixes meet by their fingerprints.

A fingerprint is no proof. Each turn of a rebuilt conversation refers to a stored one,
and with it to the SHA-256 of its role and text; a node is one only if all its members
refer to equal turns and come from one parent. If any does not, the whole is done again
with other bases.

Sums over subtrees need no walk. A node is represented by its smallest member, and the
nodes one conversation represents are the end of its path. So each conversation adds
what it represents to the nodes above, once, and everything is grouped sums. A very long
conversation is in several range partitions, whose sums are joined in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

PRIME = (1 << 31) - 1
# Bases of the four sums of a fingerprint, and others in case they fail.
BASES = (
    (1_103_515_245, 747_796_405, 1_664_525, 134_775_813),
    (22_695_477, 214_013, 69_069, 1_140_671_485),
)
BITS = 40
# Depths of a conversation that meet what it represents in one task.
SLICE = 1 << 16
NODE = ["depth", "f1", "f2"]
DIGEST = ["d1", "d2", "d3", "d4"]
STEPS = (
    "conv_id long, seg int, at long, s1 long, s2 long, i1 long, i2 long, size long, upto long, "
    "d1 long, d2 long, d3 long, d4 long"
)


class Collision(Exception):
    """Different turns with one fingerprint."""


def head_turns(conv_id: Column) -> Column:
    """How many turns of its base a conversation begins with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % 5


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base ** exponents`` modulo the prime."""
    out = np.ones(len(exponents), dtype=np.int64)
    for bit in range(int(exponents.max(initial=0)).bit_length()):
        out = np.where(exponents >> bit & 1, out * pow(base, 1 << bit, PRIME) % PRIME, out)
    return out


def _steps(bases: tuple[int, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the turns so far of each conversation in a sorted partition."""
    conv, count, sums, bytes_ = None, 0, [0] * len(bases), 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids = batch.column("conv_id").to_numpy()
        size = batch.column("size").to_numpy()
        digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), ">i8").reshape(n, 4).astype(np.int64)
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        run = np.repeat(np.arange(len(first)), np.diff(np.r_[first, n]))
        goes_on = ids[0] == conv

        def so_far(values: np.ndarray, held: int) -> np.ndarray:
            total = np.cumsum(values)
            before = np.where(first > 0, total[first - 1], 0)  # noqa: B023
            before[0] = -held if goes_on else 0  # noqa: B023
            return total - before[run]  # noqa: B023

        at = so_far(np.ones(n, dtype=np.int64), count)
        upto = so_far(size, bytes_)
        added, reached = [], []
        for k, base in enumerate(bases):
            own = digest[:, k].astype(np.uint64) % np.uint64(PRIME - 1)
            inc = (own.astype(np.int64) + 1) * powers(base, at) % PRIME
            added.append(inc)
            reached.append(so_far(inc, sums[k]) % PRIME)
        conv, count, bytes_ = ids[-1], int(at[-1]), int(upto[-1])
        sums = [int(s[-1]) for s in reached]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids),
                batch.column("seg"),
                pa.array(at),
                *(pa.array(x[0] << 31 | x[1]) for x in (reached[:2], reached[2:], added[:2], added[2:])),
                pa.array(size),
                pa.array(upto),
                *(pa.array(digest[:, k]) for k in range(4)),
            ],
            names=[part.split()[0] for part in STEPS.split(", ")],
        )


def _halves(*packed: str) -> list[Column]:
    return [half for name in packed for half in (F.shiftright(name, 31), F.col(name).bitwiseAND(PRIME))]


def _packed(sums: list[Column]) -> tuple[Column, Column]:
    """Four sums as two numbers."""
    own = [F.pmod(s, F.lit(PRIME)) for s in sums]
    return tuple(F.shiftleft(own[k], 31).bitwiseOR(own[k + 1]) for k in (0, 2))


def _power(base: int, exponent: Column) -> Column:
    """``base ** exponent`` for exponents of up to ``BITS`` bits."""
    squares = F.array(*[F.lit(pow(base, 1 << bit, PRIME)).cast("long") for bit in range(BITS)])
    return F.aggregate(
        squares,
        F.struct(F.lit(1).cast("long").alias("x"), exponent.cast("long").alias("e")),
        lambda a, square: F.struct(
            F.when(a["e"] % 2 == 1, a["x"] * square % PRIME).otherwise(a["x"]).alias("x"),
            F.shiftright(a["e"], 1).alias("e"),
        ),
        lambda a: a["x"],
    )


def _placed(turns: DataFrame, bases: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """Every turn with its place and sums, and the pieces of each conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.octet_length(text).cast("long").alias("size"),
        # The length of the role keeps role and text apart.
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
    )
    sorted_ = rows.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "digest").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "digest"
    )
    steps = sorted_.select("conv_id", "size", "digest", F.spark_partition_id().alias("seg"))
    steps = settled(steps.mapInArrow(partial(_steps, bases), STEPS), "steps")
    # Numbers of partitions follow the order of the keys, so pieces lie in order.
    pieces = steps.groupBy("conv_id", "seg").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("bytes"),
        *(F.sum(half).alias(f"t{k}") for k, half in enumerate(_halves("i1", "i2"))),
    )
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    for k, base in enumerate(bases):
        pieces = pieces.withColumn(f"w{k}", _power(base, F.col("before")))
        term = F.col(f"t{k}") % PRIME * F.col(f"w{k}") % PRIME
        pieces = pieces.withColumn(f"t{k}", F.coalesce(F.sum(term).over(earlier), F.lit(0)) % PRIME)
    pieces = pieces.withColumn("bytes_before", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)))
    pieces = settled(pieces, "pieces")
    # Only the first conversation of a range partition goes on from another one.
    carried = pieces.filter("before > 0").drop("n", "bytes")
    joined = steps.join(carried, ["conv_id", "seg"], "left")

    def shifted(names: tuple[str, str], add: bool) -> tuple[Column, Column]:
        moved = [
            half * F.coalesce(f"w{k}", F.lit(1)) % PRIME + (F.coalesce(f"t{k}", F.lit(0)) if add else 0)
            for k, half in enumerate(_halves(*names))
        ]
        return _packed(moved)

    s1, s2 = shifted(("s1", "s2"), True)
    i1, i2 = shifted(("i1", "i2"), False)
    placed = joined.select(
        "conv_id", "seg",
        (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"),
        s1.alias("s1"), s2.alias("s2"), i1.alias("i1"), i2.alias("i2"), "size",
        (F.col("upto") + F.coalesce("bytes_before", F.lit(0))).alias("upto"),
        *DIGEST,
    )
    return placed, pieces


def _rebuilt(
    turns: DataFrame,
    bases: tuple[int, ...],
    base: Callable[[Column], Column],
    head: Callable[[Column], Column],
) -> DataFrame:
    """Every prefix of every rebuilt conversation ``c``: its fingerprint ``f1``, ``f2``,
    that of its parent, the digest and size of its last turn, ``rest`` bytes from there on."""
    placed, pieces = _placed(turns, bases)
    convs = pieces.groupBy("conv_id").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    convs = convs.select(
        F.col("conv_id").alias("c"), base(F.col("conv_id")).alias("base"),
        head(F.col("conv_id")).cast("long").alias("h"), "n", "bytes",
    )
    heads = placed.join(
        convs.select("c", "base", "h"), (F.col("conv_id") == F.col("base")) & (F.col("pos") <= F.col("h"))
    )
    taken = heads.groupBy("c").agg(
        F.max("pos").alias("b"),
        F.max("upto").alias("head_bytes"),
        F.max_by("s1", "pos").alias("b1"),
        F.max_by("s2", "pos").alias("b2"),
    )
    left = placed.join(
        convs.select("c", "h"), (F.col("conv_id") == F.col("c")) & (F.col("pos") == F.col("h"))
    ).select("c", F.col("s1").alias("l1"), F.col("s2").alias("l2"), F.col("upto").alias("left_bytes"))
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    plan = (
        convs.join(taken, "c", "left")
        .join(left, "c", "left")
        .select("c", "h", "n", "bytes", *map(zero, ("b", "head_bytes", "b1", "b2", "l1", "l2", "left_bytes")))
        .select(
            "*",
            (F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"),
            (
                F.col("head_bytes") + F.when(F.col("n") > F.col("h"), F.col("bytes") - F.col("left_bytes")).otherwise(0)
            ).alias("total"),
        )
    )
    plan = settled(plan, "rebuilt")
    rest = (F.col("total") - F.col("upto") + F.col("size")).alias("rest")
    lengths = plan.select("c", "len", "total")

    def occurrence(sums: tuple[str, str], added: tuple[str, str]) -> list[Column]:
        parent = _packed([s - i for s, i in zip(_halves(*sums), _halves(*added))])
        own = _packed(_halves(*sums))
        return [own[0].alias("f1"), own[1].alias("f2"), parent[0].alias("p1"), parent[1].alias("p2")]

    fronts = heads.drop("h", "base").join(lengths, "c").select(
        "c", F.col("pos").alias("depth"), *occurrence(("s1", "s2"), ("i1", "i2")), *DIGEST, "size", rest, "len"
    )
    # A conversation's plan goes to each of its pieces, so that a long one stays spread.
    spread = pieces.select(F.col("conv_id").alias("c"), "seg").join(plan, "c")
    own = placed.withColumnRenamed("conv_id", "c").join(spread, ["c", "seg"]).filter("pos > h")
    # The own turns move from after ``h`` to after ``b`` turns.
    shift = [
        _power(pow(k, -1, PRIME), F.col("h") - F.col("b")) for k in bases
    ]
    moved = [
        F.pmod(s - left, F.lit(PRIME)) * w % PRIME + b
        for s, left, w, b in zip(_halves("s1", "s2"), _halves("l1", "l2"), shift, _halves("b1", "b2"))
    ]
    step = [i * w % PRIME for i, w in zip(_halves("i1", "i2"), shift)]
    m1, m2 = _packed(moved)
    n1, n2 = _packed(step)
    tails = own.select(
        "c", (F.col("pos") - F.col("h") + F.col("b")).alias("depth"),
        m1.alias("s1"), m2.alias("s2"), n1.alias("i1"), n2.alias("i2"), *DIGEST, "size",
        (F.col("head_bytes") + F.col("upto") - F.col("left_bytes")).alias("upto"), "total", "len",
    ).select("c", "depth", *occurrence(("s1", "s2"), ("i1", "i2")), *DIGEST, "size", rest, "len")
    nothing = [F.lit(0).cast("long").alias(name) for name in ("f1", "f2", "p1", "p2", *DIGEST, "size")]
    roots = lengths.select("c", F.lit(0).cast("long").alias("depth"), *nothing, F.col("total").alias("rest"), "len")
    return settled(roots.unionByName(fronts).unionByName(tails), "prefixes")


def _nodes(prefixes: DataFrame) -> DataFrame:
    """A row for each fingerprint; raises ``Collision`` if the turns behind one differ."""
    exact = ["p1", "p2", *DIGEST]
    nodes = prefixes.groupBy(*NODE).agg(
        F.count("*").alias("n"),
        F.min("c").alias("rep"),
        *(F.min(name).alias(name) for name in exact),
        *(F.max(name).alias(f"other_{name}") for name in exact),
        F.max("size").alias("size"),
        F.sum("rest").alias("rest"),
        F.min_by("rest", "c").alias("rep_rest"),
        F.min_by("len", "c").alias("rep_len"),
        F.max("len").alias("longest"),
    )
    nodes = settled(nodes, "nodes")
    differs = F.lit(False)
    for name in exact:
        differs = differs | (F.col(name) != F.col(f"other_{name}"))
    if not nodes.filter(differs).isEmpty():
        raise Collision
    return nodes


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations that end at a node, in order, as texts of ids."""
    for batch in batches:
        columns = [batch.column(name).to_numpy() for name in (*NODE, "c")]
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = True
        for column in columns[:3]:
            new[1:] |= column[1:] != column[:-1]
        first = np.flatnonzero(new)
        ends = np.append(first[1:], batch.num_rows)
        texts = [",".join(map(str, columns[3][a:b].tolist())) for a, b in zip(first.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(column[first]) for column in columns), pa.array(texts)], names=[*NODE, "c", "ids"]
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which lie in order; one piece is held at a time."""
    node, state = None, None

    def done(nodes: list, hashes: list) -> pa.RecordBatch:
        columns = [pa.array([n[k] for n in nodes], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(hashes, pa.string())], names=[*NODE, "ends_sha256"])

    for batch in batches:
        nodes, hashes = [], []
        for *key, ids in zip(*(batch.column(name).to_pylist() for name in (*NODE, "ids"))):
            if key != node:
                if node is not None:
                    nodes.append(node)
                    hashes.append(state.hexdigest())
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield done(nodes, hashes)
    if node is not None:
        yield done([node], [state.hexdigest()])


def _ends(prefixes: DataFrame) -> DataFrame:
    """The digest of the conversations that end at each node.

    Texts of ids are made wherever the ids lie. A digest takes its text in order, so a
    node's pieces pass through one task, of which it holds one at a time.
    """
    ending = prefixes.filter("depth = len").select(*NODE, "c")
    pieces = (
        ending.repartitionByRange(*NODE, "c")
        .sortWithinPartitions(*NODE, "c")
        .mapInArrow(_pieces, "depth long, f1 long, f2 long, c long, ids string")
    )
    return (
        pieces.repartition(*NODE)
        .sortWithinPartitions(*NODE, "c")
        .mapInArrow(_hashed, "depth long, f1 long, f2 long, ends_sha256 string")
    )


def _summed(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """What the conversations below each node of several add to it.

    A conversation represents the nodes from ``first`` on: ``tail`` bytes, and a leaf
    where nothing follows its end.
    """
    owners = (
        nodes.groupBy(F.col("rep").alias("c"))
        .agg(
            F.min("depth").alias("first"),
            F.max(F.when(F.col("n") > 1, F.col("depth"))).alias("shared"),
            F.max((F.col("depth") == F.col("longest")).cast("long")).alias("leaf"),
            F.sum("size").alias("tail"),
        )
        .withColumn("last", F.greatest(F.col("first") - 1, F.coalesce("shared", F.lit(-1))))
        .filter("last >= 0")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / SLICE).cast("int"))))
    )
    below = prefixes.select("c", *NODE, F.floor(F.col("depth") / SLICE).cast("int").alias("slice"))
    return (
        below.join(owners, ["c", "slice"])
        .filter("depth <= last")
        .groupBy(*NODE)
        .agg(
            F.count_if(F.col("first") == F.col("depth") + 1).alias("branches"),
            F.sum("leaf").alias("leaves"),
            F.sum(F.when(F.col("depth") < F.col("first"), F.col("tail")).otherwise(0)).alias("tails"),
        )
    )


def prefix_trie(
    turns: DataFrame,
    base: Callable[[Column], Column] = base_of,
    head: Callable[[Column], Column] = head_turns,
) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    ``turns`` has conv_id, turn, role and text. A conversation is the first ``head``
    turns of the conversation ``base`` names, all if it has fewer and none if there is
    no such, and then its own turns after its first ``head``. A row per distinct prefix,
    the empty one included: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (bytes of text the members of the nodes
    below and of itself share, beyond the first) and ends_sha256.

    A null role or text is empty; a null turn comes first; turns of one number follow in
    the order of the SHA-256 of role and text, so repeated rows are repeated turns. Rows
    without a conv_id belong to no conversation. An empty table has no nodes. Other
    columns play no part.
    """
    for bases in BASES:
        prefixes = _rebuilt(turns.select("conv_id", "turn", "role", "text"), bases, base, head)
        try:
            nodes = _nodes(prefixes)
            break
        except Collision:
            continue
    else:
        raise Collision("different turns have one fingerprint with each of the bases")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
        F.col("rep").alias("parent_conv_id"),
    )
    several = F.col("n") > 1
    goes_on = (F.col("rep_len") > F.col("depth")).cast("long")
    return (
        nodes.join(parents, ["depth", "p1", "p2"], "left")
        .join(_summed(nodes, prefixes), NODE, "left")
        .join(_ends(prefixes), NODE, "left")
        .select(
            F.col("rep").alias("conv_id"),
            "depth",
            "parent_conv_id",
            F.col("n").alias("n_convs"),
            (F.coalesce("branches", F.lit(0)) + goes_on).alias("n_children"),
            F.when(several, F.col("leaves")).otherwise(1).alias("n_leaves"),
            (F.col("rest") - F.col("rep_rest") - F.coalesce("tails", F.lit(0))).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
