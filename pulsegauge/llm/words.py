"""Words of many texts at once, as arrays: places in the bytes, and 64-bit hashes.

Words are runs of anything but the six ASCII blanks, unchanged. A word's hash is a
polynomial in its bytes modulo 2**64, taken from prefix sums, so that it costs the same
few array operations for all words of a batch; it is mixed with the word's length.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
# Bytes hashed at once; the tables of powers are as long.
PIECE = 1 << 17
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
ROLL = np.uint64(0xFF51AFD7ED558CCD)
U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(29))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(32))


class Words(NamedTuple):
    """Words of texts laid end to end with a blank after each text.

    ``text`` is the number of a word's text; a text's words are ``first[i]:first[i+1]``.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split(texts: pa.Array) -> Words:
    """The words of each text; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    _, places, content = texts.buffers()
    at = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(content, dtype=np.uint8) if content is not None else np.zeros(0, np.uint8)
    data = np.full(int(at[-1] - at[0]) + n, 32, dtype=np.uint8)
    for i in range(n):
        data[at[i] - at[0] + i : at[i + 1] - at[0] + i] = raw[at[i] : at[i + 1]]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[1:] = ~_BLANK[data]
    edge = np.diff(inside, append=np.int8(0))
    start, end = np.flatnonzero(edge[: len(data)] == 1), np.flatnonzero(edge == -1)
    text_end = (at[1:] - at[0]) + np.arange(n)
    first = np.concatenate([[0], np.searchsorted(start, text_end, side="left")]).astype(np.int64)
    text = np.repeat(np.arange(n), np.diff(first))
    return Words(data, start, end, text, first)


@functools.cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(PIECE + 1, U64(base))
    down = np.full(PIECE + 1, U64(pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def hashes(words: Words, base: int = BASES[0]) -> np.ndarray:
    """A hash for each word; equal words have equal hashes wherever they stand."""
    up, down = _powers(base)
    n = len(words.start)
    out = np.empty(n, dtype=np.uint64)
    i = 0
    while i < n:
        low = words.start[i]
        j = int(np.searchsorted(words.end, low + PIECE, side="right"))
        if j <= i:  # one word longer than a piece
            out[i] = _long(words.data[low : words.end[i]], base)
            i += 1
            continue
        piece = words.data[low : words.end[j - 1]].astype(np.uint64) + U64(1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(piece * up[: len(piece)], out=sums[1:])
        s = words.start[i:j] - low
        out[i:j] = (sums[words.end[i:j] - low] - sums[s]) * down[s]
        i = j
    return mixed(out + (words.end - words.start).astype(np.uint64) * U64(BASES[1]))


def _long(word: np.ndarray, base: int) -> np.uint64:
    up, _ = _powers(base)
    total, scale = 0, 1
    for at in range(0, len(word), PIECE):
        piece = word[at : at + PIECE].astype(np.uint64) + U64(1)
        total += scale * int((piece * up[: len(piece)]).sum(dtype=np.uint64))
        scale = scale * int(up[PIECE]) % (1 << 64)
    return U64(total % (1 << 64))


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` values in a row, wherever texts end."""
    n = max(0, len(values) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out *= ROLL
        out += values[k : k + n]
    return mixed(out)


def kept_texts(words: Words, keep: np.ndarray) -> pa.Array:
    """The words kept of each text, joined by one space."""
    n = len(words.first) - 1
    chosen = np.flatnonzero(keep)
    owner = words.text[chosen]
    last = np.ones(len(chosen), dtype=bool)
    last[:-1] = owner[1:] != owner[:-1]
    start, end = words.start[chosen], words.end[chosen] + ~last
    marks = np.zeros(len(words.data) + 2, dtype=np.int8)
    marks[start] += 1
    marks[end] -= 1
    inside = np.cumsum(marks, dtype=np.int8)[: len(words.data)].astype(bool)
    data = np.where(_BLANK[words.data], np.uint8(32), words.data)[inside]
    size = np.bincount(owner, weights=end - start, minlength=n).astype(np.int64)
    places = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        n, pa.py_buffer(places.tobytes()), pa.py_buffer(data.tobytes())
    )
