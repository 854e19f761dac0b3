import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulsegauge.llm import graph, similar

from . import brute
from .conftest import texts


def compared(docs, **options):
    found = similar.join(docs.select("doc_id", "text"), **options).collect()
    assert sorted(repr(tuple(r)) for r in found) == sorted(map(repr, brute.classes(texts(docs))))


def planted(seed, size=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(size):
        if docs and rng.random() < 0.6:
            w = rng.choice(docs)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        docs.append((i, " ".join(w)))
    return docs


@pytest.mark.parametrize("block", [2000, 8])
def test_planted_copies(spark, monkeypatch, block):
    monkeypatch.setattr(similar, "BUCKET_BLOCK", block)
    monkeypatch.setattr(similar, "VERIFY_BLOCK", block)
    monkeypatch.setattr(similar, "COLUMNS", 16 * block)
    compared(spark.createDataFrame(planted(block), "doc_id long, text string"))


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(similar, "VERIFY_BLOCK", 60)
    monkeypatch.setattr(similar, "BUCKET_BLOCK", 50)
    base = [f"b{i}" for i in range(160)]
    docs = []
    for i in range(200):
        w = list(base)
        w[i % 160] = f"n{i}"
        docs.append((i, " ".join(w)))
    compared(spark.createDataFrame(docs, "doc_id long, text string"))


def test_documents_and_odd_rows(spark, documents, odd_documents):
    compared(documents)
    compared(odd_documents)
    for docs in (documents, odd_documents):
        kept = similar.one_of_each(docs)
        assert kept.columns == docs.columns
        classes = brute.classes(texts(docs))
        wordless = {t or "" for _, t in texts(docs) if not brute.words(t)}
        firsts = {c for _, c, _, _ in classes}
        found = texts(kept)
        assert {i for i, t in found if brute.words(t)} == {
            c for c in firsts if any(i == c and brute.words(t) for i, t in texts(docs))
        }
        assert len([t for _, t in found if not brute.words(t)]) == len(wordless)
    assert similar.join(odd_documents.limit(0)).count() == similar.one_of_each(odd_documents.limit(0)).count() == 0


def test_prefixes_are_shortened_to_the_recall():
    even = similar.shortened(0.8, {}, similar.TREES, similar.DEPTH, similar.RECALL)
    assert similar.recall(0.8, even) >= similar.RECALL and max(even) - min(even) <= 1
    deeper = sorted(even)
    deeper[0] += 1
    assert similar.recall(0.8, deeper) < similar.RECALL
    # Where short prefixes of a trie are common, it stays deep and others make up for it.
    common = {(t, k): 10**9 >> k for t in range(4) for k in range(1, 9)}
    depths = similar.shortened(0.8, common, similar.TREES, similar.DEPTH, similar.RECALL)
    assert similar.recall(0.8, depths) >= similar.RECALL
    assert set(depths[:4]) == {similar.DEPTH} and max(depths[4:]) < similar.DEPTH
    assert similar.shortened(0.01, {}, 2, 3, 1 - 1e-9) == [1, 1]


def test_pairs_are_counted_in_sorted_keys(spark):
    rng = random.Random(4)
    keys = [[bytes(rng.choice(b"\0\0\1") for _ in range(12)) for _ in range(2)] for _ in range(300)]
    described = spark.createDataFrame([(str(i), k) for i, k in enumerate(keys)], "key string, tries array<binary>")
    rows = described.select(F.posexplode("tries").alias("trie", "sig")).coalesce(1).sortWithinPartitions("trie", "sig")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        found = rows.mapInArrow(similar._shared(3), "trie int, depth int, pairs long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = {}
    for t in range(2):
        for k in range(1, 4):
            sizes = Counter(key[t][: 4 * k] for key in keys).values()
            wanted[t, k] = sum(n * (n - 1) // 2 for n in sizes)
    assert {(r["trie"], r["depth"]): r["pairs"] for r in found} == {k: n for k, n in wanted.items() if n}


def test_tries_end_at_different_depths(spark):
    """Many texts share most of their shingles, which some tries have first."""
    rng = random.Random(8)
    line = [f"l{i}" for i in range(30)]
    docs = [(i, " ".join(line + [f"w{rng.randrange(10**6)}" for _ in range(12)])) for i in range(400)]
    docs += [(400 + i, docs[i][1] + " more") for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    described = frame.select(F.md5("text").alias("key"), "text").mapInArrow(
        similar._described(similar.TREES, similar.DEPTH, 5), "key string, tries array<binary>, sketch binary"
    )
    depths = similar.forest_depths(described, 0.8, similar.TREES, similar.DEPTH, similar.RECALL)
    assert len(set(depths)) > 1 and similar.recall(0.8, depths) >= similar.RECALL
    compared(frame)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)]
    edges += [(200, 200 + i) for i in range(40)] + [(7, 7), (None, 3)]
    owner = {}
    for a, b in edges:
        if a is not None and a != b:
            owner.setdefault(a, a)
            owner.setdefault(b, b)
            low, high = sorted((owner[a], owner[b]))
            owner = {k: low if v == high else v for k, v in owner.items()}
    found = graph.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in found} == owner and len(found) == len(owner)


def test_stars_take_no_turn(spark, monkeypatch):
    """What is a graph of stars is written once; a path takes few turns, none of them only to see it is done."""
    written = []
    settled = graph.settled
    monkeypatch.setattr(graph, "settled", lambda rows, name: written.append(name) or settled(rows, name))
    stars = spark.createDataFrame([(1, 5), (6, 1), (1, 7), (2, 8), (8, 2)], "u long, v long")
    found = {r["node"]: r["component"] for r in graph.components(stars).collect()}
    assert found == {1: 1, 5: 1, 6: 1, 7: 1, 2: 2, 8: 2}
    assert written == ["edges"]
    path = spark.createDataFrame([(1, 2), (2, 3)], "u long, v long")
    assert {r["component"] for r in graph.components(path).collect()} == {1}
    assert written.count("stars") == 1
