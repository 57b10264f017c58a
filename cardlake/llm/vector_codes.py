"""Product codes of vectors, with a geometric near-neighbour access tree per codebook.

A vector is cut into equal parts, and each part is replaced by the number of the nearest
entry of its position's codebook. The entries of a codebook form a tree: a node picks
split points far from each other, gives every other entry to its nearest split point, and
keeps, for each split point and each child, between which distances from the split point
the child's entries lie. A search measures the split points one after the other; a
child none of whose distances can be as near as the best entry so far is left out
whole. Distances are rounded to the safe side and a child goes only if it is strictly
farther, so what is measured decides ties: exact integers, then the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import saved
from cardlake.llm.vectors import integers, matrix, whole_vectors

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Split points of a node; with no more entries than ``LEAF`` they are not split further.
DEGREE, LEAF = 8, 4
# Rounding of square roots: a few units in the last place of a double.
SLACK = 1e-12
# Vectors searched at once.
BATCH = 8192


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to the point or rows ``b``."""
    away = a - b
    return np.einsum("ij,ij->i", away, away)


class Gnat:
    """The tree over ``entries`` (rows of integers), with their indices."""

    def __init__(self, entries: np.ndarray, indices: np.ndarray | None = None, degree: int = DEGREE):
        if indices is None:
            indices = np.arange(len(entries))
        self.children: list[Gnat | None] = []
        if len(entries) <= max(LEAF, degree):
            self.splits, self.indices = entries, indices
            self.children = [None] * len(entries)
        else:
            chosen = self._far_apart(entries, degree)
            rest = np.setdiff1d(np.arange(len(entries)), chosen)
            away = np.stack([_squared(entries[rest], entries[c]) for c in chosen], axis=1)
            nearest = away.argmin(axis=1)
            self.splits, self.indices = entries[chosen], indices[chosen]
            for child in range(degree):
                own = rest[nearest == child]
                self.children.append(
                    Gnat(entries[own], indices[own], degree) if len(own) else None)
        self.low, self.high = self._ranges()

    @staticmethod
    def _far_apart(entries: np.ndarray, degree: int) -> np.ndarray:
        """Places of split points, each as far as can be from those before it."""
        chosen = [0]
        away = _squared(entries, entries[0])
        while len(chosen) < degree:
            away[chosen] = -1  # equal entries are chosen last, but each only once
            chosen.append(int(away.argmax()))
            away = np.minimum(away, _squared(entries, entries[chosen[-1]]))
        return np.array(chosen)

    def members(self) -> np.ndarray:
        """All entries below, split points included."""
        below = [c.members() for c in self.children if c is not None]
        return np.concatenate([self.splits, *below])

    def _ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """[i, j]: between which distances from split point i all of child j lies, its own
        split point included, rounded outwards."""
        groups = [
            self.splits[[j]] if child is None else
            np.concatenate([self.splits[[j]], child.members()])
            for j, child in enumerate(self.children)]
        away = [[np.sqrt(_squared(group, point).astype(float)) for group in groups]
                for point in self.splits]
        low = np.array([[d.min() for d in row] for row in away]) * (1 - SLACK)
        high = np.array([[d.max() for d in row] for row in away]) * (1 + SLACK)
        return low, high

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each point; ties go to the
        lower index."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), np.iinfo(np.int64).max)
        self._search(points, np.arange(len(points)), best, index)
        return index, best

    def _search(self, points, rows, best, index) -> int:
        """Improve ``best`` and ``index`` of ``rows``; how many distances were measured."""
        n, degree = len(rows), len(self.splits)
        alive = np.ones((n, degree), bool)
        measured = 0
        own = points[rows]
        for i in range(degree):
            asked = np.flatnonzero(alive[:, i])
            if not len(asked):
                continue
            measured += len(asked)
            squared = _squared(own[asked], self.splits[i])
            at = rows[asked]
            better = (squared < best[at]) | ((squared == best[at]) & (self.indices[i] < index[at]))
            best[at[better]], index[at[better]] = squared[better], self.indices[i]
            away, radius = np.sqrt(squared.astype(float)), np.sqrt(best[at].astype(float))
            inner = (away - radius - SLACK * (away + radius))[:, None]
            outer = (away + radius + SLACK * (away + radius))[:, None]
            alive[asked] &= (inner <= self.high[i]) & (outer >= self.low[i])
        for j, child in enumerate(self.children):
            if child is not None:
                at = rows[alive[:, j]]
                if len(at):
                    measured += child._search(points, at, best, index)
        return measured


def _assigned(trees: list[Gnat], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x parts) indices and squared distances of integer vectors."""
    cut = vectors.reshape(len(vectors), len(trees), -1)
    found = [tree.nearest(cut[:, part]) for part, tree in enumerate(trees)]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _sums(kept: DataFrame, codebooks: np.ndarray, scale: int) -> DataFrame:
    """(part, entry, place, total, n): of the parts assigned to each entry."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in codebooks]
        totals = np.zeros((parts * entries, width), np.int64)
        counts = np.zeros(parts * entries, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                x = integers(matrix(batch.column(0).slice(start, BATCH)), scale)
                index, _ = _assigned(trees, x)
                flat = (index + np.arange(parts) * entries).ravel()
                np.add.at(totals, flat, x.reshape(-1, width))
                counts += np.bincount(flat, minlength=len(counts))
        used = np.flatnonzero(counts)
        where = np.repeat(used, width)
        yield pa.RecordBatch.from_arrays([
            pa.array(where // entries), pa.array(where % entries),
            pa.array(np.tile(np.arange(width), len(used))),
            pa.array(totals[used].ravel()), pa.array(counts[where]),
        ], ["part", "entry", "place", "total", "n"])

    found = kept.select("vector").mapInArrow(
        run, "part long, entry long, place long, total long, n long")
    return found.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def learned_codebooks(
    kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    scale: int = SCALE,
) -> np.ndarray:
    """Codebooks (part, entry, place) of (vec_id, vector): they start as the parts of the
    vectors with the least ids and become the rounded-down means of what is nearest.

    The driver holds the codebooks alone, ``entries`` times a vector.
    """
    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not seeds:
        return np.zeros((parts, 0, 0), np.int64)
    first = integers(np.array([s["vector"] for s in seeds], float), scale)
    if first.shape[1] % parts:
        raise ValueError(f"vectors of {first.shape[1]} components have no {parts} equal parts")
    codebooks = np.ascontiguousarray(
        first.reshape(len(first), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        new = codebooks.copy()
        for row in _sums(kept, codebooks, scale).collect():
            new[row["part"], row["entry"], row["place"]] = int(row["total"]) // row["n"]
        codebooks = new
    return codebooks


def coded(kept: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``kept`` with ``code`` (two hex digits per part) and ``error`` for its vector."""
    names = [c for c in kept.columns if c != "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in codebooks]
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                index, away = _assigned(trees, integers(matrix(part.column("vector")), scale))
                codes = [row.tobytes().hex() for row in index.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(codes), pa.array(away.sum(1))],
                    [*names, "code", "error"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in names)
    return kept.mapInArrow(run, f"{schema}, code string, error long")


def decoded(code: str, codebooks: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([codebooks[p, i] for p, i in enumerate(bytes.fromhex(code))])


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel())).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null, empty, of another length than the one with the least id, or
    holds a null or non-finite component take no part. Components become
    floor(scale * x), within plus and minus 2^24. A null id comes after all others. Of
    equally near entries the lower index is taken, so with equal entries (repeated
    vectors among the first) the first of them. Fewer vectors than ``entries`` give
    smaller codebooks; an empty table gives an empty answer; up to 256 entries.
    Further columns of ``vectors`` do not matter.
    """
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    kept = whole_vectors(vectors, vec_id, vector, F.col(label).alias("label"))
    codebooks = learned_codebooks(kept, parts, entries, rounds, scale)
    rows = saved(coded(kept, codebooks, scale))
    # A sum for each label; the rows of a common one can be split between tasks.
    sums = saved(rows.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    ).withColumnRenamed("label", "of_label")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
