import math
import random

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from pulsegauge.llm import negatives

from . import brute

KIND = "vec_id long, label int, embedding array<double>"


def compared(spark, rows, every=5, kind=KIND, **options):
    table = spark.createDataFrame(rows, kind)
    found = negatives.hard_negatives(table, F.col("vec_id") % every == 0, **options)
    wanted = brute.hard_negatives([r[:3] for r in rows], lambda i: i % every == 0)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    return wanted


def around(rng, centres, spread, size):
    return [rng.choice(centres)[k] + rng.gauss(0, spread) for k in range(size)]


@pytest.mark.parametrize("group, block", [(2048, 8192), (12, 50)])
def test_clusters(spark, group, block):
    rng = random.Random(group)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(6)]
    rows = []
    for i in range(400):
        centre = centres[i % 6]
        rows.append((i, (i % 6 + (rng.random() < 0.3)) % 6, [x + rng.gauss(0, 0.3) for x in centre]))
    rows += [(400 + i, i % 3, rows[7][2]) for i in range(150)]
    assert len(compared(spark, rows, group=group, block=block, pivots=4)) > 500


def test_bounds_spare_scores(spark):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    centres = rng.normal(0, 100, (2, 8))
    vectors = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(0, 2, (400, 8)))
    anchors = vectors[:20]
    order, parent, edge = negatives.spanning_tree(anchors)
    place = np.argsort(order)
    tree = pa.table({
        "parent": place[parent[order]], "edge": edge[order],
        "vector": [v.tobytes() for v in anchors[order]],
    })
    exact = vectors @ anchors[order].T
    asked = 0

    def wanted(k, low, high):
        assert (low <= exact[:, k]).all() and (exact[:, k] <= high).all()
        return np.flatnonzero((high >= exact[:, k].max() * 0.9))

    for k, chosen, scores in negatives.Bounds(vectors, tree, 8).walk(wanted):
        assert (scores == exact[chosen, k]).all()
        asked += len(chosen)
    assert asked < exact.size * 0.6


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, 1, [0.5, 0.5]), (5, 1, [0.5, -0.5]), (5, 1, [0.5, -0.5]), (5, 0, [0.4, 0.5]),
        (1, 1, [1.0, 1.0]), (2, 2, [0.7, 0.7]), (3, 2, [0.6, 0.8]), (4, 2, [0.7, 0.7]),
        (None, 2, [0.7, 0.7]), (6, None, [0.7, 0.7]), (7, 2, None), (8, 2, [nan, 0.7]),
        (9, 2, [inf, 0.7]), (11, 2, [None, 0.7]), (12, 2, [0.7, 0.7, 0.7]), (10, 2, [0.1, 0.1, 0.1]),
        (13, 1, [0.2, 0.2, 0.2]), (14, 2, [0.5, 0.5, 0.2]), (15, 1, []), (16, 1, []), (17, 2, []),
        (20, 3, [0.0, 0.0]), (21, 3, [-0.0, 0.0]), (22, 4, [1.0, 1.0]),
    ]
    compared(spark, rows)
    clashing = [(*r, 1, 2, "x", 3) for r in rows]
    compared(spark, clashing, kind=KIND + ", id long, size long, v string, grp long")
    assert compared(spark, []) == []
    assert compared(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_large_numbers_are_exact(spark):
    big = 3.3e6
    rows = [(i, i % 2, [(big + i) * (1 - i % 2 / 5), big - 3 * i, 1.0 / (i + 1)]) for i in range(12)]
    assert compared(spark, rows)
    with pytest.raises(PythonException, match="does not fit"):
        compared(spark, [(i, i % 2, [1e30, float(i)]) for i in range(12)])
