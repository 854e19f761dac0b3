from collections import defaultdict
from itertools import product

import pytest

from pulsegauge.llm import mixing

from . import brute


def level(sizes, weights, most=3.0):
    """Targets by cutting off and sharing again, round by round."""
    total = sum(sizes.values())
    capped = {}
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weights[s] / sum(weights[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [(5, 5, 5), (1, 1, 100), (0, 1, 2, 900, 3, 4, 5), (7,), (0, 0)])
def test_targets_share_what_is_cut_off(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(table).collect()}
    wanted = level(dict(zip(names, sizes)), dict(zip(names, [1.0, 2.0, 3.0] * 3)))
    assert found == pytest.approx(wanted)


def test_sources_come_near_their_targets(spark):
    rows = [
        (i, f"s{i % 4}" if i % 3 else "s0", "w " * (i * i % 911)) for i in range(6000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken, target = defaultdict(int), {}
    for r in mixing.mix(docs).collect():
        assert 0 <= r["mix"]["copies"] <= 3
        taken[r["source"]] += r["mix"]["copies"] * r["mix"]["size"]
        target[r["source"]] = r["mix"]["target"]
    for source in target:
        assert taken[source] == pytest.approx(target[source], rel=0.01)


def test_reruns_agree_and_partitions_do_not_matter(spark):
    rows = [(i, f"s{i % 3}", "w " * (i % 50)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    one, two = (
        sorted(map(repr, mixing.mix(d).collect())) for d in (docs, docs.repartition(7))
    )
    assert one == two


def test_odd_rows(spark, odd_documents):
    found = mixing.mix(odd_documents).collect()
    assert len(found) == odd_documents.count()
    for r in found:
        assert r["mix"]["size"] == len(brute.words(r["text"]))
    mixed = mixing.mixed(odd_documents)
    assert mixed.columns == odd_documents.columns
    assert mixed.count() == sum(r["mix"]["copies"] for r in found)
    assert mixing.mix(odd_documents.limit(0)).count() == mixing.mixed(odd_documents.limit(0)).count() == 0


def test_bands_rise_with_sizes(spark):
    found = spark.range(0, 5000).select("id", mixing.band("id").alias("b")).orderBy("id").collect()
    assert all(x["b"] <= y["b"] for x, y in product(found[:1], found)) and [
        r["b"] for r in found
    ] == sorted(r["b"] for r in found)


def cut_rows(n=3000):
    """Sizes of which one is a third of all, one source with half of all, some without a doc_id."""
    size = [7 if i % 3 == 0 else 40 + i % 23 if i % 3 == 1 else 300 + i * i % 700 for i in range(n)]
    return [
        (None if i % 50 == 0 else i, "hot" if i % 2 else f"s{i % 5}" if i % 5 else None, f"t{i} " + "w " * (size[i] - 1))
        for i in range(n)
    ]


def test_cutting_slices_changes_no_result(spark, monkeypatch):
    docs = spark.createDataFrame(cut_rows(), "doc_id long, source string, text string")
    wanted = sorted(map(repr, mixing.mix(docs).collect()))
    for most in (1, 3, 20):
        monkeypatch.setattr(mixing, "SLICE", most)
        assert sorted(map(repr, mixing.mix(docs).collect())) == wanted


def test_no_slice_is_much_larger_than_asked_for(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 10)
    rows = [(i, "one", "w " * 12) for i in range(20_000)] + [(None, "one", f"x{i} " + "w " * 11) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    seen = []
    real = mixing._cut

    def spy(table, cuts):
        seen.append(real(table, cuts))
        return seen[-1]

    monkeypatch.setattr(mixing, "_cut", spy)
    taken = mixing.mix(docs).agg({"mix.copies": "sum"}).first()[0]
    assert taken == pytest.approx(40_000, abs=1)
    slices = seen[0].groupBy("_source", "_band", "_salt", "_part", "_fine").count()
    assert max(r["count"] for r in slices.collect()) <= 40
