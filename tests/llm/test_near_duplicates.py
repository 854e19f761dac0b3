import math
import random

import numpy as np
import pytest

from pulsegauge.llm import near_duplicates as near

from . import brute
from .conftest import texts


def compared(docs):
    found = near.near_duplicates(docs.select("doc_id", "text")).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute.near_duplicates(texts(docs))))
    return found


def edited(rng, words, count):
    w = list(words)
    for _ in range(count):
        w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
    return w


@pytest.mark.parametrize("block", [2000, 8])
def test_planted_copies(spark, monkeypatch, block):
    for name in ("LIST_BLOCK", "SET_BLOCK", "EDGE_BLOCK"):
        monkeypatch.setattr(near, name, block)
    rng = random.Random(block)
    docs = []
    for i in range(150):
        if docs and rng.random() < 0.7:
            w = edited(rng, rng.choice(docs)[1].split(" "), rng.choice([0, 0, 1, 1, 2, 3]))
            if rng.random() < 0.3:
                w = [x.upper() for x in w]
        else:
            w = [f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 220))]
        docs.append((i, " ".join(w)))
    found = compared(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sum(not r["kept"] for r in found) > 20


def test_one_passage_in_all(spark):
    """Many documents share a line and little else; a third are copies; a chain hangs together."""
    rng = random.Random(3)
    line = [f"l{i}" for i in range(40)]
    docs = [line + [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(5, 90))] for _ in range(120)]
    docs += [docs[0]] * 60
    chain = [f"c{i}" for i in range(200)]
    for _ in range(25):
        docs.append(chain)
        chain = edited(rng, chain, 2)
    compared(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string"))


def test_parts_that_only_others_join(spark):
    """Copies of one text in both directions from it: not all are linked to the first."""
    base = [f"b{i}" for i in range(300)]
    docs = []
    for i in range(60):
        w = list(base)
        for k in range(1 + i % 4):
            w[(7 * i + 53 * k) % 300] = f"n{i}x{k}"
        docs.append((i, " ".join(w)))
    compared(spark.createDataFrame(docs, "doc_id long, text string"))


def test_documents_and_odd_rows(spark, documents, odd_documents):
    compared(documents)
    compared(odd_documents)
    assert compared(spark.createDataFrame([], "doc_id long, text string")) == []


def test_threshold_is_the_binomial_tail():
    tail = lambda k: sum(math.comb(64, i) * 0.85**i * 0.15 ** (64 - i) for i in range(k, 65))
    least = near.threshold(0.85)
    assert tail(least) >= near.RECALL > tail(least + 1)
    assert near.threshold(1.0) == near.COORDINATES
    rng = np.random.default_rng(0)
    assert (rng.binomial(64, 0.85, 10**6) >= near.threshold(0.85)).mean() > 0.9999


def test_a_forest_has_no_pair_twice():
    met = lambda i, others: others % 3 == i % 3
    assert sorted(near.forest(met, 9)) == [(3, 0), (4, 1), (5, 2), (6, 0), (7, 1), (8, 2)]
