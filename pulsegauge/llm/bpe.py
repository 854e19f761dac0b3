"""Byte-level BPE: texts to token ids and back.

A text is cut at special tokens, then into pieces by the vocabulary's pattern, and each
piece is merged by itself. The merge to do next is the leftmost of the lowest rank. A
segment tree over the ranks of adjacent pairs has it at its root; a merge changes three
leaves, so a piece of n bytes takes O(n log n), also where it is a megabyte without a
blank. Short pieces are merged many at once, their trees side by side in one array.
Pieces repeat, so each worker keeps the ids of those it met last.

The vocabulary file is read where tasks run; give a path every executor has.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pieces a worker remembers, about 200 bytes each.
REMEMBERED = 700_000
# Text cut into pieces at once.
BATCH_CHARS = 1 << 20
# Pieces up to these many bytes are merged side by side.
WIDTHS = (4, 8, 16, 32, 64)
SIDE_BY_SIDE = 1 << 12
# Texts per batch out of a task, in tokens.
BATCH_TOKENS = 1 << 20
NONE = 1 << 62
PLACE = (1 << 32) - 1

# How a vocabulary of this kind cuts text into pieces; fixed values.
BLANK = r"\p{White_Space}"
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{BLANK}\p{{L}}\p{{N}}]+|{BLANK}+(?!\P{{White_Space}})|{BLANK}+"
)
# The same for texts below U+0240, spelled out: all letters, numbers and blanks there are.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ȿ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
BEYOND_LATIN = re.compile("[^\x00-ȿ]")


def pieces(text: str) -> list[str]:
    return (LATIN if text.isascii() or not BEYOND_LATIN.search(text) else PIECES).findall(text)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a vocabulary file.

    Bytes that are printable stand for themselves, the others for U+0100 and up in turn.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Ids, merges and special tokens of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        letters = byte_letters()
        of_letter = {letter: byte for byte, letter in enumerate(letters)}
        ids = held["model"]["vocab"]
        self.first = [ids[letter] for letter in letters]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(held["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(ids[left] << 32 | ids[right], rank)
            self.made.append(ids[left + right])
        keys = np.array(sorted(self.rank), dtype=np.int64)
        self.pairs = keys if len(keys) else np.array([-1])
        self.ranks = np.array([self.rank[k] for k in keys.tolist()] or [0], dtype=np.int64)
        self.made_array = np.array(self.made or [0], dtype=np.int64)
        self.first_array = np.array(self.first, dtype=np.int64)
        every = np.arange(256)
        self.byte_pairs = self._leaf(
            self.first_array[every][:, None], self.first_array[every][None, :], 0
        ).ravel()
        self.bytes = {i: bytes(of_letter[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.bytes |= {i: content.encode() for content, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, longest_first)) or "(?!)")

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        ids = [self.first[b] for b in piece]
        n = len(ids)
        leaves = n - 1
        if leaves < 1:
            return ids
        rank, made = self.rank, self.made
        tree = [NONE] * (2 * leaves)
        for i in range(leaves):
            r = rank.get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[leaves + i] = r << 32 | i
        for i in range(leaves - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

        def put(i: int, value: int) -> None:
            i += leaves
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                value = a if a < b else b
                if tree[i] == value:
                    return
                tree[i] = value
                i >>= 1

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) != NONE:
            i = root & PLACE
            gone = after[i]
            right = after[gone]
            ids[i] = made[root >> 32]
            after[i] = right
            if gone < leaves:
                put(gone, NONE)
            if right < n:
                before[right] = i
                r = rank.get(ids[i] << 32 | ids[right])
                put(i, NONE if r is None else r << 32 | i)
            else:
                put(i, NONE)
            left = before[i]
            if left >= 0:
                r = rank.get(ids[left] << 32 | ids[i])
                put(left, NONE if r is None else r << 32 | left)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece, as ``merge`` gives them."""
        out: list[list[int]] = [[]] * len(pieces)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        least = 0
        for width in WIDTHS:
            chosen = np.flatnonzero((sizes > least) & (sizes <= width)).tolist()
            for at in range(0, len(chosen), SIDE_BY_SIDE):
                some = chosen[at : at + SIDE_BY_SIDE]
                for i, ids in zip(some, self._side_by_side([pieces[i] for i in some], width)):
                    out[i] = ids
            least = width
        for i in np.flatnonzero(sizes > least).tolist():
            out[i] = self.merge(pieces[i])
        return out

    def _leaf(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place of pairs, ``NONE`` for those that don't merge."""
        keys = left << 32 | right
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == keys, self.ranks[at] << 32 | place, NONE)

    def _side_by_side(self, pieces: list[bytes], width: int) -> list[list[int]]:
        n = len(pieces)
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        data = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), dtype=np.uint8)
        columns = np.arange(width)
        alive = (columns < size[:, None]).ravel()
        # All of these are n rows laid end to end; ``at`` is a place in them.
        ids = self.first_array[data]
        tree = np.full((n, 2 * width), NONE, dtype=np.int64)
        pairs = data[:-1].astype(np.int64) << 8 | data[1:]
        leaves = np.append(self.byte_pairs[pairs], NONE).reshape(n, width) | columns
        leaves[columns + 1 >= size[:, None]] = NONE
        tree[:, width:] = leaves
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(
                tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2]
            )
            level //= 2
        tree = tree.ravel()
        after = np.tile(columns + 1, n)
        before = np.tile(columns - 1, n)
        row = np.flatnonzero(tree[1 :: 2 * width] < NONE)
        while len(row):
            base, trees = row * width, row * (2 * width)
            root = tree[trees + 1]
            i = root & PLACE
            at = base + i
            gone = after[at]
            right = after[base + gone]
            made = self.made_array[root >> 32]
            ids[at] = made
            after[at] = right
            alive[base + gone] = False
            some = np.flatnonzero(right < size[row])
            place = base[some] + right[some]
            before[place] = i[some]
            own = np.full(len(row), NONE)
            own[some] = self._leaf(made[some], ids[place], i[some])
            left = before[at]
            some = np.flatnonzero(left >= 0)
            tree[trees + width + gone] = NONE
            tree[trees + width + i] = own
            tree[trees[some] + width + left[some]] = self._leaf(
                ids[base[some] + left[some]], made[some], left[some]
            )
            nodes = [width + gone, width + i, width + np.where(left >= 0, left, i)]
            level = width
            while level > 1:
                nodes = [node >> 1 for node in nodes]
                for node in nodes:
                    two = trees + 2 * node
                    tree[trees + node] = np.minimum(tree[two], tree[two + 1])
                level //= 2
            row = row[tree[trees + 1] < NONE]
        flat = ids[alive].tolist()
        ends = np.cumsum(alive.reshape(n, width).sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """What the ids stand for; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def spans(self, text: str) -> Iterator[tuple[str, bool]]:
        """The stretches of a text in order, and whether each is a special token."""
        at = 0
        for found in self.specials.finditer(text):
            if found.start() > at:
                yield text[at : found.start()], False
            yield found[0], True
            at = found.end()
        if at < len(text):
            yield text[at:], False

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for stretch, special in self.spans(text):
            if special:
                ids.append(self.special[stretch])
            else:
                for piece in pieces(stretch):
                    ids += self.merge(piece.encode())
        return ids


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """Read once by a worker."""
    return Vocabulary(path)


class _Memory:
    """The pieces a worker met last with what was made of their ids."""

    def __init__(self, path: str, made: Callable[[list[int]], object]) -> None:
        self.known, self.made = vocabulary(path), made
        self.of: dict[str, object] = {}
        # What the ids of each piece decode to.
        self.decoded: dict[str, bytes] = {}

    def learn(self, lists: list[list[str]]) -> None:
        """Makes sure that all these pieces are known; forgets the others if there are too many."""
        new = list(set().union(*lists).difference(self.of))
        if len(self.of) + len(new) > REMEMBERED:
            self.of.clear()
            self.decoded.clear()
            new = list(set().union(*lists))
        raw = [piece.encode() for piece in new]
        for piece, ids in zip(new, self.known.merge_many(raw)):
            self.of[piece] = self.made(ids)
            self.decoded[piece] = self.known.decode_bytes(ids)

    def back(self, pieces: list[str]) -> bytes:
        """What the ids of the pieces decode to."""
        return b"".join(map(self.decoded.__getitem__, pieces))


def _as_numbers(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<i4").tobytes()


def _as_text(ids: list[int]) -> str:
    return ",".join(map(str, ids))


@functools.cache
def _memory(path: str, made: Callable[[list[int]], object]) -> _Memory:
    """One per worker and use; it stays from task to task."""
    return _Memory(path, made)


def _cut(texts: Iterator[str], memory: _Memory) -> Iterator[list[tuple[list[str], int | None]]]:
    """For each text its stretches: pieces that ``memory`` knows, or the id of a special token."""

    def known(held: list[list[tuple[list[str], int | None]]]) -> Iterator:
        memory.learn([cut for stretches in held for cut, _ in stretches])
        yield from held

    held, chars = [], 0
    for text in texts:
        held.append(
            [
                ([], memory.known.special[stretch]) if special else (pieces(stretch), None)
                for stretch, special in memory.known.spans(text)
            ]
        )
        chars += len(text)
        if chars >= BATCH_CHARS:
            yield from known(held)
            held, chars = [], 0
    yield from known(held)


def id_bytes(texts: Iterator[str], path: str) -> Iterator[bytes]:
    """The ids of each text as little-endian 32-bit numbers."""
    memory = _memory(path, _as_numbers)
    for stretches in _cut(texts, memory):
        out = []
        for cut, special in stretches:
            out += [_as_numbers([special])] if special is not None else map(memory.of.__getitem__, cut)
        yield b"".join(out)


def digests(texts: Iterator[str], path: str) -> Iterator[tuple[int, str, str]]:
    """Number of ids, SHA-256 of the ids as text, SHA-256 of what they decode to."""
    memory = _memory(path, _as_text)
    for stretches in _cut(texts, memory):
        ids, decoded = [], []
        for cut, special in stretches:
            if special is None:
                ids += map(memory.of.__getitem__, cut)
                decoded.append(memory.back(cut))
            else:
                ids.append(str(special))
                decoded.append(memory.known.bytes[special])
        listed = ",".join(ids)
        back = b"".join(decoded).decode("utf-8", "replace").encode()
        yield (
            listed.count(",") + 1 if listed else 0,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(back).hexdigest(),
        )


def _with_row(docs: DataFrame, *dropped: str) -> DataFrame:
    plain = docs.drop(*dropped)
    return plain.select(F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("row"))


def _texts(column: pa.Array) -> Iterator[str]:
    for i in range(len(column)):
        yield column[i].as_py() or ""


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """The documents with ``token_ids``; a null or empty text has none.

    Texts are encoded whole and by themselves, so repeated rows repeat, other columns
    play no part, and an empty table gives none. A column called ``token_ids`` is
    replaced.
    """
    held = _with_row(docs, "token_ids")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            start, sizes, parts, held_now = 0, [], [], 0

            def done(end: int) -> pa.RecordBatch:
                places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = np.frombuffer(b"".join(parts), dtype="<i4")
                ids = pa.ListArray.from_arrays(pa.array(places), pa.array(values))
                return pa.RecordBatch.from_arrays([rows[start:end], ids], names=["row", "token_ids"])

            for i, part in enumerate(id_bytes(_texts(rows.field(column)), path), 1):
                parts.append(part)
                sizes.append(len(part) // 4)
                held_now += sizes[-1]
                if held_now >= BATCH_TOKENS:
                    yield done(i)
                    start, sizes, parts, held_now = i, [], [], 0
            if parts:
                yield done(len(rows))

    kinds = T.StructType([*held.schema.fields]).add("token_ids", T.ArrayType(T.IntegerType()))
    return held.mapInArrow(encoded, kinds).select("row.*", "token_ids")


def decode(tokens: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """The rows with ``decoded``, the text their ids stand for; null ids give an empty text."""
    held = _with_row(tokens, "decoded")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            rows = batch.column("row")
            ids = rows.field(column)
            texts = [known.decode(ids[i].as_py() or []) for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(texts, pa.string())], names=["row", "decoded"]
            )

    kinds = T.StructType([*held.schema.fields]).add("decoded", T.StringType())
    return held.mapInArrow(decoded, kinds).select("row.*", "decoded")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, and of its text's ids the number and digest, and the digest of what they decode to.

    The encoder is the one of ``encode``; the ids themselves stay in the task.
    """
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(digests(_texts(batch.column("text")), path))
            made = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *made],
                names=[part.split()[0] for part in kinds.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(digested, kinds)
