"""Removing passages that an earlier document has: exact matches of 13 words or more.

Two equal windows that start anywhere share an anchor. Anchors are the runs of ``L``
words at positions whose residue modulo a period is in a difference cover: for any two
residues some shift of less than a period takes both into the cover, so whatever the
places of two equal windows, at some offset an anchor starts in both, and the window is
long enough to hold it. With 13 words, period 7 and anchors of 7 words that is 3 of 7
positions.

1. Each chunk of documents sends the distinct hashes of its anchors, six bytes each, to
   buckets by hash; a bucket answers which of them another document has too.
2. Around those, each chunk extends to all windows that hold the anchor, and sends
   their 96-bit hashes with the smallest doc_id; the answer is whether there is a smaller.
3. Each chunk takes out the words those windows cover.

Hashes go out once per chunk, however often a passage repeats, and answers are bits in
the order of the question, so a passage in every document costs a bucket one entry per
chunk. Chunks and buckets are numbered by the size of the corpus and hold a few MB. The
texts are dealt out to chunks once; the three steps read that exchange again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import text_bytes

WINDOW = 13
# Perfect difference covers, by period; fixed values.
COVERS = {1: (0,), 3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14)}
CHUNK_BYTES = 4 << 20
BUCKET_ANCHORS = 1 << 20
# Anchors to expect for a byte of text: 3/7 of words of six bytes.
ANCHORS_PER_BYTE = 1 / 14
NO_ID = np.iinfo(np.int64).max
SENT = "chunk long, bucket int, keys binary, ids binary"
ANSWER = "chunk long, bucket int, kind int, bits binary"


def cover(window: int) -> tuple[int, tuple[int, ...]]:
    """Period and residues for windows of so many words; anchors are at least as long as the period."""
    period = max(p for p in COVERS if 2 * p - 1 <= window)
    return period, COVERS[period]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> W.U64(40)) * W.U64(buckets)) >> W.U64(24)


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])


class _Chunk:
    """The documents of a chunk with what all three steps derive from them alike."""

    def __init__(self, rows: pa.Table, window: int) -> None:
        self.window = window
        row = rows.column("row").combine_chunks()
        self.row = row
        self.words = W.split(row.field("text"))
        ids = row.field("doc_id").cast(pa.int64())
        self.ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.hash = W.hashes(self.words)
        period, residues = cover(window)
        length = window - period + 1
        n = len(self.hash)
        place = np.arange(n) - self.words.first[self.words.text]
        fits = place + length <= self.words.counts[self.words.text]
        self.anchor = np.flatnonzero(fits & np.isin(place % period, residues))
        hashed = W.windows(self.hash, length)[self.anchor] & ~W.U64(1)
        # Distinct anchors, in the order of their hashes; the low bit says that two documents of the chunk have it.
        order = np.argsort(hashed, kind="stable")
        first = _runs(hashed[order])
        self.group = np.empty(len(order), dtype=np.int64)
        self.group[order] = np.repeat(
            np.arange(len(first)), np.diff(np.append(first, len(order)))
        )
        owner = self.words.text[self.anchor][order]
        twice = np.zeros(0, dtype=bool)
        if len(first):
            twice = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        self.keys = hashed[order][first] | twice.astype(np.uint64)

    def extend(self, shared: np.ndarray) -> None:
        """The windows that hold an anchor another document has, distinct, with smallest ids."""
        period, _ = cover(self.window)
        at = self.anchor[shared[self.group]] if len(self.anchor) else self.anchor
        n = len(self.hash)
        marks = np.zeros(n + 1, dtype=np.int64)
        np.add.at(marks, np.maximum(at - period + 1, 0), 1)
        np.add.at(marks, at + 1, -1)
        near = np.flatnonzero(np.cumsum(marks[:n]) > 0)
        near = near[near + self.window <= self.words.first[self.words.text[near] + 1]]
        self.at = near
        low = W.windows(self.hash, self.window)[near]
        high = W.windows(W.hashes(self.words, W.BASES[1]), self.window)[near] >> W.U64(32)
        ids = self.ids[self.words.text[near]]
        order = np.lexsort((ids, high, low))
        pair = np.stack([low[order], high[order]], axis=1)
        new = np.ones(len(order), dtype=bool)
        new[1:] = (pair[1:] != pair[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        self.of = np.empty(len(order), dtype=np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.low, self.high = pair[first, 0], pair[first, 1]
        self.smallest = ids[order][first]

    def remove(self, smaller: np.ndarray) -> pa.Table:
        ids = self.ids[self.words.text[self.at]]
        gone = smaller[self.of] | (ids > self.smallest[self.of]) if len(self.at) else np.zeros(0, bool)
        marks = np.zeros(len(self.hash) + self.window + 1, dtype=np.int64)
        marks[self.at[gone]] += 1
        marks[self.at[gone] + self.window] -= 1
        keep = np.cumsum(marks)[: len(self.hash)] == 0
        removed = np.bincount(self.words.text[~keep], minlength=len(self.ids))
        return pa.Table.from_arrays(
            [
                self.row,
                pa.array(self.words.counts, pa.int64()),
                pa.array(removed, pa.int64()),
                W.kept_texts(self.words, keep).cast(pa.string()),
            ],
            names=["row", "n_words", "n_removed", "kept"],
        )


def _sent(chunk: int, hashes: np.ndarray, buckets: int, keys: np.ndarray, ids: np.ndarray | None) -> pa.Table:
    """Keys, which are in order of ``hashes``, by bucket. ``keys`` has a row of bytes for each."""
    bucket = _bucket(hashes, buckets).astype(np.int64)
    cuts = _runs(bucket)
    ends = np.append(cuts[1:], len(bucket))
    return pa.Table.from_arrays(
        [
            pa.array([chunk] * len(cuts), pa.int64()),
            pa.array(bucket[cuts], pa.int32()),
            pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            pa.array([b"" if ids is None else ids[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        ],
        names=["chunk", "bucket", "keys", "ids"],
    )


def _heard(answers: pa.Table, kind: int, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The answers of one kind, put where the questions stood."""
    out = np.zeros(len(hashes), dtype=bool)
    bucket = _bucket(hashes, buckets).astype(np.int64)
    for b, k, bits in zip(*[answers.column(c).to_pylist() for c in ("bucket", "kind", "bits")]):
        if k == kind:
            low, high = np.searchsorted(bucket, [b, b + 1])
            out[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low)
    return out


def _answered(rows: pa.Table, sizes: np.ndarray, yes: np.ndarray, kind: int) -> pa.Table:
    chunks = rows.column("chunk").to_pylist()
    bucket = rows.column("bucket")[0].as_py()
    ends = np.cumsum(sizes)
    found = [
        (chunk, bucket, kind, np.packbits(yes[end - size : end]).tobytes())
        for chunk, size, end in zip(chunks, sizes, ends)
        if yes[end - size : end].any()
    ]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.Table.from_arrays(
        [pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)],
        names=["chunk", "bucket", "kind", "bits"],
    )


def _bytes(rows: pa.Table, column: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    parts = rows.column(column).to_pylist()
    data = np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(-1, width)
    return data, np.array([len(p) // width for p in parts], dtype=np.int64)


def _padded(data: np.ndarray) -> np.ndarray:
    """Little-endian numbers of less than eight bytes as 64-bit ones."""
    wide = np.zeros((len(data), 8), dtype=np.uint8)
    wide[:, : data.shape[1]] = data
    return wide.view(np.uint64).ravel()


def _low_bytes(values: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width]


def _which_are_shared(rows: pa.Table) -> pa.Table:
    data, sizes = _bytes(rows, "keys", 6)
    keys = _padded(data)
    bare = keys >> W.U64(1)
    order = np.argsort(bare, kind="stable")
    equal = bare[order][1:] == bare[order][:-1]
    again = np.r_[equal, False] | np.r_[False, equal] if len(order) else np.zeros(0, bool)
    yes = (keys & W.U64(1)).astype(bool)
    yes[order] |= again
    return _answered(rows, sizes, yes, 0)


def _which_have_smaller(rows: pa.Table) -> pa.Table:
    data, sizes = _bytes(rows, "keys", 12)
    low, high = _padded(data[:, :8]), _padded(data[:, 8:])
    ids = np.frombuffer(b"".join(rows.column("ids").to_pylist()), dtype=np.int64)
    order = np.lexsort((ids, high, low))
    l, h = low[order], high[order]
    first = np.flatnonzero(np.r_[True, (l[1:] != l[:-1]) | (h[1:] != h[:-1])])
    least = np.repeat(ids[order][first], np.diff(np.append(first, len(order))))
    yes = np.empty(len(order), dtype=bool)
    yes[order] = ids[order] > least
    return _answered(rows, sizes, yes, 1)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with ``n_words``, ``n_removed`` and ``kept``.

    Removed is each word of a window whose words also start, in that order, somewhere in
    a document with a smaller doc_id; windows are those of the input. ``kept`` has the
    other words joined by one space. A null text has no words. A null doc_id is larger
    than any other, and equal doc_ids are not smaller than each other, so repeated rows
    of one doc_id leave each other alone. Columns called like the new ones are replaced.
    An empty table gives none.
    """
    size = text_bytes(docs)
    chunks = max(1, size // CHUNK_BYTES)
    buckets = max(1, min(1 << 24, int(size * ANCHORS_PER_BYTE) // BUCKET_ANCHORS))
    plain = docs.drop("n_words", "n_removed", "kept")
    dealt = plain.select(
        F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("row"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"),
    ).repartition("chunk")

    def asked(key: tuple, rows: pa.Table) -> pa.Table:
        held = _Chunk(rows, window)
        return _sent(key[0].as_py(), held.keys, buckets, _low_bytes(held.keys, 6), None)

    def extended(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        held = _Chunk(rows, window)
        held.extend(_heard(answers, 0, held.keys, buckets))
        keys = np.concatenate([_low_bytes(held.low, 8), _low_bytes(held.high, 4)], axis=1)
        return _sent(key[0].as_py(), held.low, buckets, keys, held.smallest)

    def removed(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        held = _Chunk(rows, window)
        held.extend(_heard(answers, 0, held.keys, buckets))
        return held.remove(_heard(answers, 1, held.low, buckets))

    by_chunk = dealt.groupBy("chunk")
    shared = by_chunk.applyInArrow(asked, SENT).groupBy("bucket").applyInArrow(_which_are_shared, ANSWER)
    smaller = (
        by_chunk.cogroup(shared.groupBy("chunk"))
        .applyInArrow(extended, SENT)
        .groupBy("bucket")
        .applyInArrow(_which_have_smaller, ANSWER)
    )
    kinds = (
        T.StructType([dealt.schema["row"]])
        .add("n_words", T.LongType())
        .add("n_removed", T.LongType())
        .add("kept", T.StringType())
    )
    return (
        by_chunk.cogroup(shared.union(smaller).groupBy("chunk"))
        .applyInArrow(removed, kinds)
        .select("row.*", "n_words", "n_removed", "kept")
    )
