import hashlib
from collections import defaultdict

import numpy as np
import pytest

from cardlake.llm.vector_codes import Gnat, compress, decoded, learned_codebooks
from cardlake.llm.vectors import LARGEST, whole_vectors
from tests.llm.vector_cases import cloud, hot, odd, vectors


def test_tree_finds_the_nearest_entry_with_the_lowest_index():
    rng = np.random.default_rng(1)
    for width, spread in ((4, 3), (4, 200), (1, 50), (2, LARGEST)):
        entries = rng.integers(-spread, spread + 1, (64, width))
        entries[40:] = entries[:24]  # equal entries
        points = np.concatenate([rng.integers(-spread, spread + 1, (3000, width)), entries])
        away = ((points[:, None] - entries[None]) ** 2).sum(2)
        for degree in (2, 5, 8):
            index, best = Gnat(entries, degree=degree).nearest(points)
            assert (index == away.argmin(1)).all() and (best == away.min(1)).all()


def test_tree_leaves_whole_children_out():
    rng = np.random.default_rng(2)
    entries = (rng.normal(size=(8, 1, 4)) * 1000 + rng.normal(size=(8, 8, 4)) * 5).astype(int).reshape(64, 4)
    points = entries + 1
    tree = Gnat(entries)
    best, index = np.full(64, 1 << 60), np.full(64, 1 << 60)
    assert tree._search(points, np.arange(64), best, index) < 64 * 24
    assert (index == np.arange(64)).all()


def _expected(rows, parts=16, entries=64, rounds=2):
    kept = [(i, np.clip(np.floor(256 * np.asarray(v, np.float64)), -LARGEST, LARGEST).astype(int), g)
            for i, v, g in rows
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, tuple(r[1])))
    width = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    cut = np.array([r[1] for r in kept]).reshape(len(kept), parts, -1)
    books = cut[:entries].transpose(1, 0, 2).copy()

    def assigned():
        away = ((cut[:, :, None] - books[None]) ** 2).sum(3)
        return away.argmin(2), away.min(2)

    for _ in range(rounds):
        index, _ = assigned()
        for p in range(parts):
            for e in range(books.shape[1]):
                if (own := cut[index[:, p] == e, p]).size:
                    books[p, e] = own.sum(0) // len(own)
    index, away = assigned()
    by_label = defaultdict(int)
    for (_, _, g), a in zip(kept, away, strict=True):
        by_label[g] += int(a.sum())
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    return sorted(map(repr, (
        (i, "".join(f"{x:02x}" for x in code), int(a.sum()), by_label[g], digest)
        for (i, _, g), code, a in zip(kept, index, away, strict=True))))


@pytest.mark.parametrize("rows", [cloud(300), hot(150), odd(), cloud(10), cloud(90, 32)],
                         ids=["cloud", "hot", "odd", "few", "wide"])
def test_codes_against_brute_force(spark, rows):
    found = compress(vectors(spark, rows).repartition(5))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(repr, map(tuple, found.collect()))) == _expected(rows)


def test_decoded_codes_are_as_far_as_the_error_says(spark):
    rows = cloud(120)
    table = vectors(spark, rows)
    books = learned_codebooks(whole_vectors(table, "vec_id", "embedding"))
    for row in compress(table).collect():
        whole = np.floor(256 * np.asarray(rows[row.vec_id][1], np.float64)).astype(int)
        assert ((whole - decoded(row.code, books)) ** 2).sum() == row.error


def test_empty_tables_and_parts_that_do_not_fit(spark):
    assert compress(vectors(spark, [])).count() == 0
    assert compress(vectors(spark, [(1, None, 1), (2, [], 2)])).count() == 0
    with pytest.raises(ValueError):
        compress(vectors(spark, cloud(5, 10)))
