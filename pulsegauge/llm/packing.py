"""Token ids of documents packed into rows of one length, as binary matrices.

Documents longer than a row are cut into whole rows and a rest, nothing is lost. Rests
and short documents are packed best fit decreasing: from the longest down, each goes to
the row with the least room that still holds it. A segment tree over room, one leaf for
every amount, finds that row in as many steps as a row's length has bits.

Packing goes on within a task, over so many tokens at a time, so nothing is shuffled, no
task holds more than a window, and rows are as full as best fit makes thousands of
documents. A window's last rows are emitted as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import id_bytes
from .bpe import vocabulary as id_table

# The id of a byte is the byte; this one ends a document of bytes.
END_OF_TEXT = 256
LENGTH = 2048
# Tokens a task packs at a time.
WINDOW = 1 << 22
ROWS = 256
PACKED = (
    "doc_ids array<long>, doc_starts array<long>, cu_seqlens array<int>, n_tokens int, "
    "ids binary, positions binary"
)


class Segment(NamedTuple):
    """Tokens ``start`` to ``start + len(ids)`` of a document, its end token among them."""

    doc_id: int | None
    start: int
    ids: np.ndarray


class Room:
    """Open rows by the room they have left, and the one that fits an item best."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << length.bit_length()
        # Rows below each node of the tree.
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, row: int, room: int) -> None:
        if room:
            self.rows[room].append(row)
            self._change(room, 1)

    def best(self, size: int) -> tuple[int, int] | None:
        """The row with the least room of at least ``size``, and that room; it is taken out."""
        count, node = self.count, self.leaves + size
        if not count[node]:
            # Up to the first right-hand neighbour that has rows, then down its left edge.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """The items of each row; no size exceeds ``length``. Of equal sizes the first goes first."""
    room, rows = Room(length), []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = room.best(sizes[item])
        if found is None:
            rows.append([])
            found = len(rows) - 1, length
        row, left = found
        rows[row].append(item)
        room.add(row, left - sizes[item])
    return rows


def rows_of(segments: list[Segment], length: int) -> Iterator[list[Segment]]:
    """Segments of any length as rows of ``length`` at most."""
    rests = []
    for s in segments:
        whole = len(s.ids) // length * length
        for at in range(0, whole, length):
            yield [Segment(s.doc_id, s.start + at, s.ids[at : at + length])]
        if whole < len(s.ids):
            rests.append(Segment(s.doc_id, s.start + whole, s.ids[whole:]))
    for row in best_fit_decreasing([len(s.ids) for s in rests], length):
        yield [rests[i] for i in row]


def _batch(rows: list[list[Segment]], length: int, end: int, kind: np.dtype) -> pa.RecordBatch:
    ids = np.full((len(rows), length), end, dtype=kind)
    positions = np.zeros((len(rows), length), dtype=kind)
    steps = np.arange(length, dtype=kind)
    ends = []
    for k, row in enumerate(rows):
        at = 0
        ends.append([0])
        for s in row:
            ids[k, at : at + len(s.ids)] = s.ids
            positions[k, at : at + len(s.ids)] = steps[: len(s.ids)]
            at += len(s.ids)
            ends[-1].append(at)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([[s.doc_id for s in row] for row in rows], pa.list_(pa.int64())),
            pa.array([[s.start for s in row] for row in rows], pa.list_(pa.int64())),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array([e[-1] for e in ends], pa.int32()),
            pa.array([r.tobytes() for r in ids], pa.binary()),
            pa.array([r.tobytes() for r in positions], pa.binary()),
        ],
        names=[part.split()[0] for part in PACKED.split(", ")],
    )


def _documents(
    batch: pa.RecordBatch, width: int, kind: np.dtype, end: int, vocabulary: str | None
) -> Iterator[Segment]:
    names, held = batch.column("doc_id").to_pylist(), batch.column("ids")
    if vocabulary is not None:
        texts = (text.as_py() or "" for text in held)
        encoded = (np.frombuffer(ids, dtype="<i4") for ids in id_bytes(texts, vocabulary))
    else:
        encoded = (None for _ in names)
    for name, ids, found in zip(names, held, encoded):
        if found is not None:
            pass
        elif pa.types.is_binary(held.type):
            found = _fitting(np.frombuffer(ids.as_buffer(), dtype=f"<u{width}"), kind) if ids.is_valid else ()
        else:
            found = _fitting(_numbers(ids.values), kind) if ids.is_valid else ()
        own = np.empty(len(found) + 1, dtype=kind)
        own[:-1], own[-1] = found, end
        yield Segment(name, 0, own)


def _numbers(ids: pa.Array) -> np.ndarray:
    if ids.null_count:
        raise ValueError("a token id is null")
    return ids.to_numpy()


def _fitting(ids: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The ids as ``kind``, if it holds all of them."""
    if ids.size and not 0 <= ids.min() <= ids.max() <= np.iinfo(kind).max:
        raise ValueError(f"token ids from {ids.min()} to {ids.max()} do not fit {kind.itemsize} bytes; raise out_bytes")
    return ids.astype(kind)


def pack(
    docs: DataFrame,
    column: str = "token_ids",
    end: int = END_OF_TEXT,
    length: int = LENGTH,
    width: int = 1,
    vocabulary: str | None = None,
    out_bytes: int = 2,
    window: int = WINDOW,
) -> DataFrame:
    """Rows of ``length`` ids: which documents they hold from where, and the ids themselves.

    ``column`` is an array of ids, a binary of little-endian ids of ``width`` bytes, or,
    with the path of a ``vocabulary``, a text to encode on the way.
    Every document ends with ``end``; one that is null or empty is just that, so no row
    of the table is lost, and rows that repeat are packed again. A null doc_id stays
    null. ``cu_seqlens`` has where segments begin and where the last ends; ``positions``
    start over with each segment; what is left of a row is filled with ``end`` at
    position 0 and lies beyond ``n_tokens``. Both matrices are little-endian numbers of
    ``out_bytes``; an id, ``end`` or a position that does not fit raises, as does a null
    id in a list. Other columns play no part. An empty table gives no rows.
    """
    kind = np.dtype(f"<u{out_bytes}")
    # What a vocabulary can give is known beforehand; other ids are looked at as they come.
    largest = max(id_table(vocabulary).bytes) if vocabulary is not None else 0
    if not 0 <= max(end, length - 1, largest) <= np.iinfo(kind).max:
        raise ValueError(f"ids of {out_bytes} bytes cannot hold {max(end, largest)} and positions up to {length - 1}")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def documents(batch: pa.RecordBatch) -> Iterator[Segment]:
            return _documents(batch, width, kind, end, vocabulary)

        for segments in _windows(batches, documents, window):
            rows: list[list[Segment]] = []
            for row in rows_of(segments, length):
                rows.append(row)
                if len(rows) == ROWS:
                    yield _batch(rows, length, end, kind)
                    rows = []
            if rows:
                yield _batch(rows, length, end, kind)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{column}`").alias("ids")
    ).mapInArrow(packed, PACKED)


def _windows(
    batches: Iterable[pa.RecordBatch],
    documents: Callable[[pa.RecordBatch], Iterator[Segment]],
    window: int,
) -> Iterator[list[Segment]]:
    held, tokens = [], 0
    for batch in batches:
        for s in documents(batch):
            held.append(s)
            tokens += len(s.ids)
            if tokens >= window:
                yield held
                held, tokens = [], 0
    if held:
        yield held


def write(packed: DataFrame, folder: str) -> None:
    """The matrices as Parquet files, a binary of ids and one of positions to a row."""
    packed.write.parquet(folder)
