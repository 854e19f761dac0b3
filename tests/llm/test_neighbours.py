import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegauge.llm import neighbours
from pulsegauge.llm.catalog import REGISTERED

KIND = "vec_id long, embedding array<float>, label int, pivot string, asks int"


def exact(rows, asks, nearest):
    fine = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            fine[i] = np.array(v, dtype=np.float32).astype(np.float64)
    out = {}
    for q in fine:
        if asks(q):
            score = {i: float(sum(a * b for a, b in zip(v, fine[q]))) for i, v in fine.items() if i != q}
            out[q] = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:nearest]
    return out


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 0, None, None) for i, v in rows], KIND)
    out = {}
    for r in neighbours.search(table, F.col("vec_id") % 2 == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_with_every_file_visited_the_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    monkeypatch.setattr(neighbours, "ASKING", 5)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(40)]
    wanted = exact(rows, lambda i: i % 2 == 0, 5)
    got = found(spark, rows, nearest=5, pivots=10, visited=10)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in wanted.items()}
    for q in wanted:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in wanted[q]])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [None, 1.0]),
            (None, [1.0, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0, 3.0])]
    assert found(spark, rows) == {0: [(7, 1.0)]}
    assert found(spark, rows[:1]) == {}
    assert found(spark, []) == found(spark, rows[1:4]) == {}


def test_footrule():
    assert neighbours.footrule(np.array([0, 1, 2]), np.array([[0, 1, 2], [1, 0, 2], [5, 6, 7]]), 9).tolist() == [0, 2, 12]


def test_recall(spark, tables):
    got = REGISTERED["op9_neighbours"](spark, tables).collect()
    rows = spark.read.parquet(f"{tables}/embeddings.parquet").select("vec_id", "embedding").collect()
    wanted = exact([tuple(r) for r in rows], lambda i: i % 20 == 0, 20)
    found_ids = {(r["query_id"], r["vec_id"]) for r in got}
    wanted_ids = {(q, i) for q, v in wanted.items() for i, _ in v}
    assert len(found_ids) == len(wanted_ids)
    assert len(found_ids & wanted_ids) >= 0.9 * len(wanted_ids)


def test_vectors_of_each_length_have_an_index_of_their_own(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3 + i % 3).astype(np.float32).tolist()) for i in range(90)]
    got = found(spark, rows, nearest=4, visited=1000)
    for n in (3, 4, 5):
        own = [r for r in rows if len(r[1]) == n]
        for q, wanted in exact(own, lambda i: i % 2 == 0, 4).items():
            assert [i for i, _ in got.pop(q)] == [i for i, _ in wanted]
    assert got == {}


def test_short_lists_go_on_to_further_files(spark):
    rng = np.random.default_rng(6)
    centres = np.eye(3) * 10
    rows = [(i, (centres[i % 3] + rng.normal(size=3) * 0.01).astype(np.float32).tolist()) for i in range(30)]
    wanted = exact(rows, lambda i: i % 2 == 0, 20)
    got = found(spark, rows, pivots=30, visited=1)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in wanted.items()}
    assert {len(v) for v in found(spark, rows).values()} == {20}


def test_copies_are_found_by_their_smallest_ids(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    hot = [100.0] * 8
    rows += [(1000 + i, hot) for i in range(150)]
    # The same vec_id with other vectors: the better one counts.
    rows += [(1001, [200.0] * 8), (1003, rows[5][1])]
    got = found(spark, rows, nearest=10)
    for q in range(1000, 1150, 2):
        assert [i for i, _ in got[q]] == [i for i in [1001, 1000, *range(1002, 1012)] if i != q][:10]


def test_best_takes_each_id_once():
    score = np.array([1.0, 3.0, 3.0, 2.0, 3.0])
    ids = np.empty(5, dtype=object)
    ids[:] = [[1, 2], [5, 9], [5], [4], [7, 8]]
    first = np.array([x[0] for x in ids])
    assert neighbours._best(score, first, ids, 4) == [(3.0, 5), (3.0, 7), (3.0, 8), (3.0, 9)]
    assert neighbours._best(score, first, ids, 6) == [(3.0, 5), (3.0, 7), (3.0, 8), (3.0, 9), (2.0, 4), (1.0, 1)]


def test_settings_follow_the_structure_of_the_vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 5
    tight = [(i, (centres[i % 40] + rng.normal(size=16) * 0.1).tolist()) for i in range(3000)]
    loose = [(i, rng.normal(size=16).tolist()) for i in range(3000)]
    seen = []

    def spy(*args):
        seen.append(real(*args))
        return seen[-1]

    real = neighbours._fitted
    neighbours._fitted = spy
    try:
        for rows in (tight, loose):
            got = found(spark, rows)
            wanted = exact(rows, lambda i: i % 100 == 0, 20)
            hits = sum(len({i for i, _ in v} & {i for i, _ in got[q]}) for q, v in wanted.items())
            assert hits >= 0.9 * 20 * len(wanted)
    finally:
        neighbours._fitted = real
    (near, _), (wide, _) = seen
    assert near[16] < wide[16]
