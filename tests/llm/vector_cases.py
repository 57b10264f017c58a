"""Vectors that every operator on vectors meets in its tests."""

import numpy as np

VECTORS = "vec_id long, embedding array<float>, label int, rank int, score string, block string"


def vectors(spark, rows, clashing=True):
    """Rows (vec_id, vector, label), with columns whose names the operators use themselves."""
    made = [(i, None if v is None else [None if x is None else float(x) for x in v], g, 7, "x", "x")
            for i, v, g in rows]
    found = spark.createDataFrame(made, VECTORS)
    return found if clashing else found.select("vec_id", "embedding", "label")


def cloud(n, width=16, seed=5, groups=4):
    """Rounded vectors around a few centres, every sixth a copy of the one before."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, width))
    rows = []
    for i in range(n):
        v = centres[i % groups] * 0.4 + rng.normal(size=width) * 0.5
        rows.append((i, np.round(v, 2).astype(np.float32), i % groups))
        if i % 6 == 5:
            rows[-1] = (i, rows[-2][1], rows[-2][2])
    return rows


def hot(n, width=16):
    """A third of all rows has one vector."""
    rows = cloud(n, width)
    return [(i, rows[1][1], 1) if i % 3 == 0 else (i, v, g) for i, v, g in rows]


NAN, INF = float("nan"), float("inf")


def odd(width=16):
    """Nulls, zeros, non-finite and huge components, other lengths, repeated rows and ids."""
    rows = cloud(40, width)
    some = rows[3][1]
    return rows + [
        (100, None, 1), (101, [], 1), (102, [None] + [1.0] * (width - 1), 1),
        (103, [NAN] + [1.0] * (width - 1), 1), (104, [INF] + [1.0] * (width - 1), 1),
        (200, [0.0] * width, 1), (300, [1e30] + [-1e30] * (width - 1), 2), (400, [1.0] * 3, 1),
        (500, some, None), (500, some, None), (None, some, 2), (700, some, 0), (700, some, 0),
        (600, [1e-30] * width, 3), (7, [-0.0] * (width - 1) + [2.0], 1),
    ]
