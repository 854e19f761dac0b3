import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegauge.llm import passages
from pulsegauge.llm import words as W

from . import brute
from .conftest import texts


@pytest.mark.parametrize("period", passages.COVERS)
def test_covers_meet_at_every_shift(period):
    residues = set(passages.COVERS[period])
    for a in range(period):
        for b in range(period):
            assert any((a + d) % period in residues and (b + d) % period in residues for d in range(period))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aé漢🙂 \t\n\x0b\x1c", max_size=30)), max_size=8))
def test_words_and_their_hashes(rows):
    found = W.split(pa.array(rows, pa.string()))
    wanted = [w for t in rows for w in brute.words(t)]
    raw = found.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(found.start, found.end)] == wanted
    assert found.counts.tolist() == [len(brute.words(t)) for t in rows]
    hashes = W.hashes(found).tolist()
    assert len(set(zip(hashes, wanted))) == len(set(hashes)) == len(set(wanted))
    kept = W.kept_texts(found, np.ones(len(wanted), bool)).to_pylist()
    assert kept == [" ".join(brute.words(t)) for t in rows]


def test_long_words_hash_like_themselves():
    word = "abcdefghij" * 50_000
    found = W.hashes(W.split(pa.array([word, "x " + word, word[:-1]])))
    assert found[0] == found[2] and found[0] != found[3]


def planted(seed):
    rng = random.Random(seed)
    shared = [[f"s{k}w{i}" for i in range(rng.choice([12, 13, 14, 30, 60]))] for k in range(5)]
    docs = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [f"d{i}x{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 20))]
            if rng.random() < 0.6:
                part = rng.choice(shared)
                a = rng.randint(0, 3)
                w += part[a : len(part) - rng.randint(0, 3)]
        docs.append((rng.randint(0, 1000) * 100 + i, " ".join(w)))
    return docs


def compared(spark, docs, **options):
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = [tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept")) for r in passages.remove_repeats(table, **options).collect()]
    wanted = brute.passages(docs, options.get("window", 13))
    assert sorted(map(repr, found)) == sorted(map(repr, wanted))


@pytest.mark.parametrize("chunk,bucket", [(1 << 22, 1 << 20), (300, 20)])
def test_planted_passages(spark, monkeypatch, chunk, bucket):
    monkeypatch.setattr(passages, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(passages, "BUCKET_ANCHORS", bucket)
    compared(spark, planted(chunk))


def test_other_windows(spark):
    docs = [(i, "a b c d e f"[i % 3 :]) for i in range(6)] + [(9, "x a b y")]
    for window in (1, 2, 5, 25):
        compared(spark, docs, window=window)


def test_odd_rows(spark, odd_documents):
    found = passages.remove_repeats(odd_documents)
    assert set(odd_documents.columns) <= set(found.columns) | {"kept"}
    rows = found.collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r["n_words"] == len(brute.words(r["text"]))
        assert len(brute.words(r["kept"])) == r["n_words"] - r["n_removed"]
    removed = {(r["doc_id"], r["source"]): r["n_removed"] for r in rows}
    assert removed[(5, "b")] == 60_000 and removed[(4, "b")] < 60_000
    assert removed[(7, "a")] == removed[(7, "a")] > 0 == removed[(6, None)]
    assert passages.remove_repeats(odd_documents.limit(0)).count() == 0


def test_documents(spark, documents):
    compared(spark, texts(documents))
