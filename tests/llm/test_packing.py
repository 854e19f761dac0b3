from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from pulsegauge.llm import bpe, packing
from pulsegauge.llm.catalog import vocabulary

from .conftest import texts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_decreasing(sizes):
    rows, wanted = packing.best_fit_decreasing(sizes, 40), []
    room = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fitting = [r for r in room if r >= sizes[item]]
        if fitting:
            room.remove(min(fitting))
        left = (min(fitting) if fitting else 40) - sizes[item]
        room.append(left)
    wanted = sorted(room)
    assert sorted(i for row in rows for i in row) == list(range(len(sizes)))
    assert sorted(40 - sum(sizes[i] for i in row) for row in rows) == wanted


def unpacked(rows, length, kind="<u2"):
    out = defaultdict(list)
    for r in rows:
        ids, positions = np.frombuffer(r["ids"], kind), np.frombuffer(r["positions"], kind)
        cuts = r["cu_seqlens"]
        assert len(ids) == len(positions) == length and cuts[0] == 0 and cuts[-1] == r["n_tokens"]
        assert not positions[cuts[-1] :].any()
        for doc, start, a, b in zip(r["doc_ids"], r["doc_starts"], cuts, cuts[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            out[doc].append((start, ids[a:b].tolist()))
    return {d: sorted(parts) for d, parts in out.items()}


def test_documents_come_back_whole(spark, documents):
    docs = documents.select("doc_id", F.col("text").cast("binary").alias("token_ids"), F.lit(1).alias("ids"))
    for length, window in ((64, 5000), (8192, 1 << 23)):
        rows = packing.pack(docs, length=length, window=window).collect()
        found = unpacked(rows, length)
        for i, text in texts(documents):
            ids = [x for _, part in found[i] for x in part]
            assert ids == [*(text or "").encode(), 256]
        assert sum(r["n_tokens"] for r in rows) > 0.9 * length * len(rows)


def test_ids_of_a_vocabulary(spark, documents):
    encoded = bpe.encode(documents, vocabulary()).cache()
    rows = packing.pack(encoded, end=50256, length=512).collect()
    found = unpacked(rows, 512)
    at_once = packing.pack(documents, "text", end=50256, length=512, vocabulary=vocabulary())
    assert unpacked(at_once.collect(), 512) == found
    for r in encoded.collect():
        assert [x for _, part in found[r["doc_id"]] for x in part] == [*r["token_ids"], 50256]


def test_odd_rows(spark, odd_documents):
    docs = odd_documents.drop("token_ids").withColumn("token_ids", F.col("text").cast("binary"))
    found = unpacked(packing.pack(docs, length=1000).collect(), 1000)
    assert set(found) == {i for i, _ in texts(odd_documents)}
    for i in found:
        own = sum(len((t or "").encode()) + 1 for k, t in texts(odd_documents) if k == i)
        assert sum(len(part) for _, part in found[i]) == own
    assert packing.pack(docs.limit(0)).count() == 0


def test_what_does_not_fit_raises(spark):
    ids = spark.createDataFrame([(1, [5, 70_000])], "doc_id long, token_ids array<int>")
    with pytest.raises(PythonException, match="raise out_bytes"):
        packing.pack(ids, end=0, length=8).collect()
    row = packing.pack(ids, end=0, length=8, out_bytes=4).first()
    assert np.frombuffer(row["ids"], "<u4")[:3].tolist() == [5, 70_000, 0]
    for wrong in ([-1], [None, 3]):
        rows = spark.createDataFrame([(1, wrong)], "doc_id long, token_ids array<int>")
        with pytest.raises(PythonException):
            packing.pack(rows, end=0, length=8).collect()
    with pytest.raises(ValueError):
        packing.pack(ids, end=70_000)
    with pytest.raises(ValueError):
        packing.pack(ids, end=0, length=1 << 17)
