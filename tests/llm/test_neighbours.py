import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlake.llm.neighbours import (
    Cuts, Tree, _box_distances, _searched, chi_square, directions, nearest_by_cosine, reach,
)
from tests.llm.vector_cases import cloud, hot, odd, vectors


def _brute(rows, every, k=5):
    kept = {}
    for i, v, _ in rows:
        if v is not None and len(v) == len(rows[0][1]) and all(
                x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.asarray(v, np.float32).astype(float)
            kept[i, v.tobytes()] = v
    found = {}
    for (i, key), v in kept.items():
        if i is None or i % every:
            continue
        scored = [(-float((v * w).sum() / (math.sqrt((v * v).sum()) * math.sqrt((w * w).sum()))),
                   j is None, j or 0) for (j, _), w in kept.items() if j != i]
        found.setdefault(i, []).append(sorted(scored)[:k])
    return found


def _answers(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.query_id, []).append(r)
    return {i: sorted(rows, key=lambda r: r["rank"]) for i, rows in found.items()}


def test_stopping_bound_is_that_of_chi_square():
    rng = np.random.default_rng(0)
    for freedom in (2, 6, 8):
        at = reach(0.9, freedom)
        assert abs(chi_square(at, freedom) - 0.9) < 1e-9
        drawn = (rng.standard_normal((200_000, freedom)) ** 2).sum(1)
        assert abs((drawn <= at).mean() - 0.9) < 0.005
    a, b = rng.standard_normal((2, 400, 64))
    gap = ((a - b) @ directions(8, 64)) ** 2
    assert 0.85 < (gap.sum(1) / ((a - b) ** 2).sum(1) <= reach(0.9, 8)).mean() < 0.95


def test_tree_gives_rows_in_order_of_distance():
    rng = np.random.default_rng(3)
    places = rng.normal(size=(500, 6))
    places[100:130] = places[100]
    point = rng.normal(size=6)
    away = ((places - point) ** 2).sum(1)
    given, last = [], -1.0
    for ring, within in Tree(places, 16).outwards(point):
        assert (away[ring] <= within).all() and (away[ring] > last).all()
        given += ring.tolist()
        assert sorted(given) == np.flatnonzero(away <= within).tolist()
        last = within
    assert len(given) == 500


def test_cells_hold_their_places():
    rng = np.random.default_rng(4)
    cuts = Cuts(rng.normal(size=(400, 4)), 4)
    places = rng.normal(size=(1000, 4))
    cells = cuts.cells(places)
    assert np.bincount(cells, minlength=16).min() > 20
    for place, cell in zip(places, cells, strict=True):
        assert cuts.away(place)[cell] == 0 and (cuts.low[cell] <= place).all()
    assert _box_distances(np.zeros(1), np.array([[2.0]]), np.array([[3.0]]))[0] == 4


@pytest.mark.parametrize("cell_rows", [4096, 30])
@pytest.mark.parametrize("rows", [cloud(400), hot(300)], ids=["cloud", "hot"])
def test_recall_against_brute_force(spark, rows, cell_rows):
    found = _answers(nearest_by_cosine(
        vectors(spark, rows).repartition(4), F.col("vec_id") % 5 == 0, cell_rows=cell_rows))
    expected = _brute(rows, 5)
    assert found.keys() == expected.keys()
    hits = 0
    for i, (best,) in expected.items():
        assert [r["rank"] for r in found[i]] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in found[i]] == sorted((-r.score, r.vec_id) for r in found[i])
        hits += len({j for _, _, j in best} & {r.vec_id for r in found[i]})
    assert hits >= 0.95 * 5 * len(expected)


def test_whole_table_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    expected = _brute(rows, 50)
    for cell_rows in (4096, 64):
        found = _answers(nearest_by_cosine(table, F.col("vec_id") % 50 == 0, cell_rows=cell_rows))
        hits = sum(len({j for _, _, j in best} & {r.vec_id for r in found[i]})
                   for i, (best,) in expected.items())
        assert hits >= 0.9 * 5 * len(expected)
        exact = {(i, j): -s for i, (best,) in expected.items() for s, _, j in best}
        for i, answers in found.items():
            for r in answers:
                assert abs(r.score - exact.get((i, r.vec_id), r.score)) < 1e-14


def test_all_candidates_where_these_are_few(spark):
    rows = odd()
    expected = _brute(rows, 100, k=100)
    found = nearest_by_cosine(vectors(spark, rows), F.col("vec_id") % 100 == 0, k=100)
    by_query = {}
    for r in found.collect():
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert by_query.keys() == expected.keys()
    for i, (best,) in expected.items():
        given = sorted(by_query[i])
        assert [g[1] for g in given] == [None if none else j for _, none, j in best]
        assert np.allclose([g[2] for g in given], [-s for s, _, _ in best], atol=1e-12)


def test_empty_tables_and_one_row(spark):
    anything = F.lit(True)
    assert nearest_by_cosine(vectors(spark, []), anything).count() == 0
    assert nearest_by_cosine(vectors(spark, cloud(1)), anything).count() == 0
    assert nearest_by_cosine(vectors(spark, cloud(9)), F.lit(False)).count() == 0
    assert nearest_by_cosine(vectors(spark, cloud(3)), anything).count() == 6
    with pytest.raises(ValueError):
        nearest_by_cosine(vectors(spark, cloud(3)), anything, coordinates=5)


def test_a_cell_beyond_the_radius_gives_nothing():
    rng = np.random.default_rng(6)
    units = rng.normal(size=(200, 16))
    units /= np.linalg.norm(units, axis=1)[:, None]
    tree = Tree(units @ directions(8, 16))
    far = (units[0] @ directions(8, 16)) + 50
    rows, verified = _searched(tree, units, units[0], far, 5, reach(0.95, 8), 0.9)
    assert len(rows) == 0 and verified == 0
