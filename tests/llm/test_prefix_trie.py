import random

import pytest

from pulsegauge.llm import prefix_trie as trie

from . import brute

KIND = "conv_id long, turn long, role string, text string"


def compared(spark, rows, partitions=None):
    turns = spark.createDataFrame(rows, KIND)
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = trie.prefix_trie(turns).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute.trie(rows)))


@pytest.mark.parametrize("seed", range(3))
def test_few_words_and_many_ends(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(60):
        own = rows[-1][0] if rows and rng.random() < 0.3 else c
        copied = [r for r in rows if r[0] == own]
        said = copied if own != c else [None] * rng.randint(1, 12)
        for turn, r in enumerate(said):
            text = r[3] if r else rng.choice(["", "yes", "no", "é漢"])
            rows.append((c, turn, rng.choice(["user", "user", "assistant"]), text))
    rng.shuffle(rows)
    compared(spark, rows)


def test_long_conversations_in_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "SLICE", 7)
    rng = random.Random(5)
    rows = [(c, t, "user", f"t{t % 11}") for c in (0, 1, 2, 7) for t in range(90 + c)]
    rows += [(c, t, "user", rng.choice("ab")) for c in (20, 21, 22) for t in range(9)]
    compared(spark, rows, partitions="13")


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody"),
        (3, None, None, None),
        (3, None, "user", None),
        (3, 0, None, "first"),
        (3, 0, None, "first"),
        (4, 1, "a", "bc"),
        (4, 2, "ab", "c"),
        (5, 1, "ab", "c"),
        (9, 0, "user", "x" * 200_000),
        (-3, 0, "user", "below"),
        (-7, 0, "user", "below"),
        (0, 0, "user", "below"),
        (10**15, 5, "user", "far"),
    ]
    compared(spark, rows)
    clashing = spark.createDataFrame(
        [(*r, 1, "x", 2, 3) for r in rows], KIND + ", c long, n string, depth long, rep long"
    )
    found = trie.prefix_trie(clashing).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute.trie(rows)))


def test_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], KIND)).collect() == []


def test_a_collision_is_noticed(spark, monkeypatch):
    rows = [(0, 0, "user", "a"), (0, 1, "user", "b"), (5, 0, "user", "c")]
    # Bases of nought make all fingerprints equal.
    monkeypatch.setattr(trie, "BASES", ((trie.PRIME,) * 4, trie.BASES[0]))
    monkeypatch.setattr(trie, "pow", lambda b, e, m: 0 if b % m == 0 else pow(b, e, m), raising=False)
    compared(spark, rows)
    monkeypatch.setattr(trie, "BASES", ((trie.PRIME,) * 4,))
    with pytest.raises(trie.Collision):
        trie.prefix_trie(spark.createDataFrame(rows, KIND))
