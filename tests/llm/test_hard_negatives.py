from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlake.llm.hard_negatives import (
    _moments, _on_curve, bounds, candidate_blocks, hard_negatives, hilbert,
)
from cardlake.llm.vectors import LARGEST, whole_vectors
from tests.llm.vector_cases import cloud, hot, odd, vectors


def _brute(rows, every, positives=5, negatives=10):
    kept = [(i, np.clip(np.floor(256 * np.asarray(v, np.float32).astype(float)), -LARGEST, LARGEST)
             .astype(int).tolist(), g) for i, v, g in rows
            if i is not None and g is not None and v is not None and len(v) == len(rows[0][1])
            and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for i, v, g in kept:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, h == g)
                        for j, w, h in kept if j != i)
        for p, positive, _ in [s for s in scored if s[2]][:positives]:
            fits = [(s, j) for s, j, same in scored if not same and 30 * -p <= 100 * -s <= 90 * -p]
            found += [(i, positive, n + 1, j, -p, -s) for n, (s, j) in enumerate(fits[:negatives])]
    return sorted(found)


@pytest.mark.parametrize("axes, bits", [(2, 3), (3, 2), (2, 1), (4, 1)])
def test_neighbours_on_the_curve_touch(axes, bits):
    cells = np.array(list(product(range(1 << bits), repeat=axes))).T
    place = hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(1 << axes * bits))
    steps = np.abs(np.diff(cells[:, place.argsort()], axis=1)).sum(0)
    assert (steps == 1).all()


def test_bounds_hold_all_scores():
    rng = np.random.default_rng(0)
    anchors = rng.integers(-300, 300, (20, 8))
    blocks = [rng.integers(-50, 200, (30, 8)) for _ in range(6)]
    least, largest = bounds(
        anchors, np.array([b.min(0) for b in blocks]), np.array([b.max(0) for b in blocks]))
    for j, block in enumerate(blocks):
        scores = anchors @ block.T
        assert (least[:, j] <= scores.min(1)).all() and (scores.max(1) <= largest[:, j]).all()


def test_blocks_hold_all_rows_of_one_label_with_their_zones(spark):
    rows = hot(500)
    kept = whole_vectors(vectors(spark, rows), "vec_id", "embedding", F.col("label").cast("long").alias("label"))
    blocks = candidate_blocks(_on_curve(kept, _moments(kept, 256), 256), 500, block_rows=20).collect()
    assert sorted(i for b in blocks for i in b.ids) == list(range(500))
    labels = {i: g for i, _, g in rows}
    assert len({b.block for b in blocks}) == len(blocks) and max(b.n for b in blocks) == 20
    for b in blocks:
        assert {labels[i] for i in b.ids} == {b.label} and b.first_id == min(b.ids)
        x = np.array(b.parts).reshape(b.n, -1)
        assert (x.min(0) == b.low).all() and (x.max(0) == b.high).all()


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 7, "stretch": 6, "anchors_each": 3}])
@pytest.mark.parametrize("rows", [cloud(300), hot(240), odd(), cloud(12)],
                         ids=["cloud", "hot", "odd", "few"])
def test_against_brute_force(spark, rows, sizes):
    found = hard_negatives(
        vectors(spark, rows).repartition(3), F.col("vec_id") % 10 == 0, F.col("label"), **sizes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id",
                             "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == _brute(rows, 10)


def test_far_blocks_are_not_read(spark, monkeypatch):
    """Labels in opposite corners: an anchor's windows need no block of the other corner."""
    from cardlake.llm import hard_negatives as module

    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * 0.05 + (-1) ** (i % 2)).astype(np.float32), i % 4)
            for i in range(400)]
    read, needs = [], module._needs

    def noted(*args):
        found = needs(*args)
        read.append(found.select("block", F.explode("anchors").alias("anchor")).distinct().count())
        return found

    monkeypatch.setattr(module, "_needs", noted)
    found = hard_negatives(
        vectors(spark, rows), F.col("vec_id") % 20 == 0, F.col("label"), block_rows=10)
    assert sorted(map(tuple, found.collect())) == _brute(rows, 20)
    # 20 anchors and some 40 blocks, of which three quarters have other labels.
    assert read[3] <= 20 * 12 and read[2] <= 20


def test_empty_tables_and_anchors_without_others(spark):
    def mined(rows, anchors=F.lit(True)):
        return hard_negatives(vectors(spark, rows), anchors, F.col("label")).count()

    assert mined([]) == mined([(1, None, 1)]) == mined(cloud(30), F.lit(False)) == 0
    assert mined([(1, [1.0, 2.0], 1)]) == mined([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]) == 0
