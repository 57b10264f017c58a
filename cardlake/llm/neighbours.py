"""Nearest vectors by cosine, through a few stable projections and a kd-tree over them.

Unit vectors are projected to a few coordinates by normally distributed (2-stable)
directions. The squared distance of two projections, over that of the vectors, is then
chi-square distributed with as many degrees of freedom as there are coordinates. A
kd-tree over the projections hands out neighbours in order of projected distance,
and each is verified by its true distance. The search ends when a vector as near as the
k-th best found would have a projection within the distance reached with probability
``CERTAIN`` or more.

The upper part of the tree cuts the table into cells, each searched by tasks of its own;
the lower part is made within a cell. A query first searches the cell it lies in. That
gives it a k-th best, hence a radius beyond which the stopping test holds, and it then
searches the other cells that reach into the radius.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import forget, saved
from cardlake.llm.vectors import matrix, whole_vectors

K, COORDINATES, CERTAIN, SEED = 5, 8, 0.95, 13
# Vectors in a cell and in a leaf of its tree, on average; queries that search a cell at once.
CELL_ROWS, LEAF_ROWS, QUERIES_EACH = 4096, 32, 1024
# The cuts between cells are learned from about so many rows; all rows are indexed.
SAMPLE_ROWS = 50_000
# Rounding of a similarity: what is this close to the k-th best is measured exactly.
CLOSE = 1e-12
# The similarity of the k-th best while fewer are known: nothing is beyond its radius.
NONE = float("-inf")
_POINT = "vec_id long, digest binary, vector binary, place binary"
_FOUND = "digest binary, vec_id long, score double"


def chi_square(x: float, freedom: int) -> float:
    """The chi-square distribution for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def reach(certain: float, freedom: int) -> float:
    """The x at which ``chi_square`` is ``certain``."""
    low, high = 0.0, 1.0
    while chi_square(high, freedom) < certain:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < certain else (low, middle)
    return high


def directions(coordinates: int, width: int, seed: int = SEED) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((width, coordinates))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _levelled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component below one."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _unpacked(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values)).reshape(len(values), -1)


def _points(kept: DataFrame, coordinates: int, seed: int) -> DataFrame:
    """``_POINT`` of each vector that is not zero: levelled, and its projection.

    The digest is that of the levelled vector, so vectors with one digest have the same
    similarity to every other.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            there = np.abs(x).max(axis=1) > 0
            x = _levelled(x[there]) + 0.0  # no negative zeros
            place = _unit(x) @ directions(coordinates, x.shape[1], seed)
            digests = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).filter(pa.array(there)), pa.array(digests, pa.binary()),
                _packed(x), _packed(place)], ["vec_id", "digest", "vector", "place"])

    return kept.select("vec_id", "vector").mapInArrow(run, _POINT)


class Cuts:
    """The upper part of the tree: planes that cut space into 2^depth cells."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros(2 ** depth, np.int64)
        self.at = np.zeros(2 ** depth)
        self.low = np.full((2 ** depth, sample.shape[1]), -np.inf)
        self.high = np.full((2 ** depth, sample.shape[1]), np.inf)
        self._cut(sample, 1, 0, 2 ** depth)

    def _cut(self, sample: np.ndarray, node: int, first: int, last: int) -> None:
        """Halve the cells from ``first`` up to ``last`` along the widest axis."""
        if last - first == 1:
            return
        middle = (first + last) // 2
        axis = int(np.ptp(sample, axis=0).argmax()) if len(sample) else 0
        at = float(np.median(sample[:, axis])) if len(sample) else 0.0
        self.axis[node], self.at[node] = axis, at
        self.high[first:middle, axis] = np.minimum(self.high[first:middle, axis], at)
        self.low[middle:last, axis] = np.maximum(self.low[middle:last, axis], at)
        below = sample[:, axis] < at
        self._cut(sample[below], 2 * node, first, middle)
        self._cut(sample[~below], 2 * node + 1, middle, last)

    def cells(self, places: np.ndarray) -> np.ndarray:
        """The cell of each place."""
        node = np.ones(len(places), np.int64)
        for _ in range(self.depth):
            right = places[np.arange(len(places)), self.axis[node]] >= self.at[node]
            node = 2 * node + right
        return node - 2 ** self.depth

    def away(self, place: np.ndarray) -> np.ndarray:
        """The squared distance of a place from each cell."""
        return _box_distances(place, self.low, self.high)


def _box_distances(place: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    outside = np.maximum(np.maximum(low - place, place - high), 0.0)
    return (outside * outside).sum(axis=1)


class Tree:
    """The lower part: leaves of a few places of one cell, with the box of each."""

    def __init__(self, places: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.places = places
        self.leaves = []
        self._split(np.arange(len(places)), leaf_rows)
        self.low = np.array([places[leaf].min(axis=0) for leaf in self.leaves])
        self.high = np.array([places[leaf].max(axis=0) for leaf in self.leaves])

    def _split(self, rows: np.ndarray, leaf_rows: int) -> None:
        if len(rows) <= leaf_rows:
            self.leaves.append(rows)
            return
        own = self.places[rows]
        order = rows[own[:, int(np.ptp(own, axis=0).argmax())].argsort(kind="stable")]
        self._split(order[:len(order) // 2], leaf_rows)
        self._split(order[len(order) // 2:], leaf_rows)

    def outwards(self, place: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """Rows in rings of growing projected distance: the next rows, and the squared
        distance within which all rows have now been given."""
        away = _box_distances(place, self.low, self.high)
        order = away.argsort(kind="stable")
        held = np.empty(0, np.int64)
        held_away = np.empty(0)
        taken, step = 0, 4
        while taken < len(order):
            new = np.concatenate([self.leaves[i] for i in order[taken:taken + step]])
            taken, step = taken + step, step * 2
            gap = self.places[new] - place
            held = np.concatenate((held, new))
            held_away = np.concatenate((held_away, (gap * gap).sum(axis=1)))
            within = away[order[taken]] if taken < len(order) else np.inf
            ready = held_away <= within
            yield held[ready], within
            held, held_away = held[~ready], held_away[~ready]


def _searched(tree: Tree, units: np.ndarray, unit, place, k: int, radius: float, least: float):
    """(rows among which the k nearest of the cell are, how many were verified).

    ``least`` is the similarity of the k-th best that is known already.
    """
    rows, near = [], []
    best = np.empty(0)
    verified = 0
    for ring, within in tree.outwards(place):
        if len(ring):
            similar = units[ring] @ unit
            verified += len(ring)
            rows.append(ring)
            near.append(similar)
            best = np.concatenate((best, similar))
            if len(best) > k:
                best = np.partition(best, len(best) - k)[-k:]
            if len(best) == k:
                least = max(least, best.min())
        # The k-th best lies at 2 - 2 * least, squared.
        if within >= radius * max(0.0, 2 - 2 * least):
            break
    if not rows:
        return np.empty(0, np.int64), verified
    rows, near = np.concatenate(rows), np.concatenate(near)
    return rows[near >= least - CLOSE], verified


def _search_cells(asked: DataFrame, points: DataFrame, k: int, radius: float) -> DataFrame:
    """``_FOUND`` of the best k of each cell asked, as far as the stopping test goes.

    ``asked``: (cell, chunk, digest, vector, place, least). A chunk bounds the queries
    that search a cell at once.
    """
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        digests, ids, scores = [], [], []
        if left.num_rows and right.num_rows:
            vectors, of = _unpacked(right["vector"]), np.array(right["vec_id"].to_pylist(), object)
            units, tree = _unit(vectors), Tree(_unpacked(right["place"]))
            lengths = np.sqrt((vectors * vectors).sum(axis=1))
            wanted, places = _unpacked(left["vector"]), _unpacked(left["place"])
            for query, unit, place, digest, least in zip(
                    wanted, _unit(wanted), places, left["digest"].to_pylist(),
                    left["least"].to_pylist(), strict=True):
                rows, _ = _searched(tree, units, unit, place, k, radius, least)
                score = (vectors[rows] * query).sum(axis=1) / (
                    lengths[rows] * np.sqrt((query * query).sum()))
                order = sorted(range(len(rows)), key=lambda i: (
                    -score[i], of[rows[i]] is None, of[rows[i]] or 0))[:k]
                digests += [digest] * len(order)
                ids += [of[rows[i]] for i in order]
                scores += [score[i] for i in order]
        return pa.table({
            "digest": pa.array(digests, pa.binary()), "vec_id": pa.array(ids, pa.int64()),
            "score": pa.array(scores, pa.float64())})

    pairs = asked.select(
        F.col("cell").alias("in_cell"), F.col("chunk").alias("for_chunk")).distinct()
    given = points.join(pairs, F.col("cell") == F.col("in_cell")).select(
        "in_cell", "for_chunk", "vec_id", "vector", "place")
    return asked.groupBy("cell", "chunk").cogroup(
        given.groupBy("in_cell", "for_chunk")).applyInArrow(search, _FOUND)


def _best(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_by_cosine(
    vectors: DataFrame, asks: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding",
    coordinates: int = COORDINATES, certain: float = CERTAIN, cell_rows: int = CELL_ROWS,
    sample_rows: int = SAMPLE_ROWS, seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row where ``asks``.

    Candidates are all rows but those with the query's own id; ``score`` is the cosine in
    double precision; ties go to the smaller id, a null id last. Vectors that are null,
    empty, zero, of another length than the one with the least id, or hold a null or
    non-finite component take no part. A row repeated whole counts once. With fewer
    candidates all are given; an empty table gives an empty answer. Further columns of
    ``vectors`` do not matter.

    Each of the k nearest is found with probability ``certain`` or more; ``coordinates``
    is even. Of vectors with the same direction only the k + 1 least ids can be among the
    nearest, so a direction that very many rows share fills no cell.
    """
    if coordinates % 2:
        raise ValueError("an even number of coordinates")
    most = k + 1  # the query itself may be among them
    kept = whole_vectors(vectors, vec_id, vector)
    same = _points(kept, coordinates, seed).groupBy("digest", "vec_id").agg(
        F.any_value("vector").alias("vector"), F.any_value("place").alias("place"))
    same = saved(same)
    rows = same.count()
    least_ids = Window.partitionBy("digest").orderBy(F.col("vec_id").asc_nulls_last())
    few = same.withColumn("n", F.row_number().over(least_ids)).filter(F.col("n") <= most).drop("n")

    depth = max(0, math.ceil(math.log2(max(1, rows / cell_rows))))
    draw = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < (1 << 30) * min(
        1.0, sample_rows / max(1, rows))
    sample = few.filter(draw).select("place").limit(2 * sample_rows).toArrow()["place"]
    sampled = _unpacked(sample) if len(sample) else np.zeros((0, coordinates))
    # 2^depth cells; the cuts are learned from a bounded sample, so they are never many more.
    depth = min(depth, max(0, int(math.log2(max(1, len(sampled)) / 4))) if len(sampled) else 0)
    cuts, radius = Cuts(sampled, depth), reach(certain, coordinates)

    points = saved(few.select("vec_id", "digest", "vector", "place").mapInArrow(
        _at_home(cuts), _POINT + ", cell long"))
    queries = same.filter(asks).select("vec_id", "digest")
    chunks = max(1, -(-queries.count() // QUERIES_EACH))
    asked = same.filter(asks).groupBy("digest").agg(
        F.any_value("vector").alias("vector"), F.any_value("place").alias("place"))
    asked = saved(asked.select(
        "digest", "vector", "place",
        F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(chunks)).alias("chunk"),
    ).mapInArrow(
        _at_home(cuts), "digest binary, vector binary, place binary, chunk long, cell long"))
    home = saved(_search_cells(
        asked.withColumn("least", F.lit(NONE)), points, most, radius))
    known = home.groupBy("digest").agg(F.count("*").alias("n"), F.min("score").alias("low")).select(
        "digest", F.when(F.col("n") >= most, F.col("low")).otherwise(NONE).alias("least"))
    wide = asked.join(known, "digest", "left").select(
        "digest", "vector", "place", "chunk", "cell", F.coalesce("least", F.lit(NONE)).alias("least"))
    others = saved(_search_cells(wide.mapInArrow(
        _within(cuts, radius),
        "digest binary, vector binary, place binary, chunk long, cell long, least double",
    ), points, most, radius))
    best = saved(_best(home.union(others), most, "digest").drop("rank"))
    forget(points, asked, home, others)
    answers = queries.withColumnRenamed("vec_id", "query_id").join(best, "digest").filter(
        ~F.col("vec_id").eqNullSafe(F.col("query_id")))
    return _best(answers, k, "query_id", "digest").select("query_id", "rank", "vec_id", "score")


def _at_home(cuts: Cuts):
    """Adds the cell of each place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = cuts.cells(_unpacked(batch.column("place")))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])
    return run


def _within(cuts: Cuts, radius: float):
    """A row for each other cell that reaches into the radius of a query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                rows, cells = [], []
                for row, (place, least, home) in enumerate(zip(
                        _unpacked(part.column("place")), part.column("least").to_pylist(),
                        part.column("cell").to_pylist(), strict=True)):
                    near = cuts.away(place) < radius * max(0.0, 2 - 2 * least)
                    near[home] = False
                    found = np.flatnonzero(near)
                    rows += [row] * len(found)
                    cells += found.tolist()
                taken = part.take(pa.array(rows, pa.int64()))
                yield taken.set_column(
                    part.schema.get_field_index("cell"), "cell", pa.array(cells, pa.int64()))
    return run
