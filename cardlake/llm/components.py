"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import forget, packed, saved

# Links that one task connects among themselves.
LINKS_EACH = 250_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the least node that links lead each to), for the links given."""
    nodes, place = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = place[:len(u)], place[len(u):]
    label = np.arange(len(nodes))
    while True:
        low, new = np.minimum(label[a], label[b]), label.copy()
        for end in (a, b, label[a], label[b]):
            np.minimum.at(new, end, low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _stars(edges: DataFrame, tasks: int) -> DataFrame:
    """Stars (u, v: the least) that connect what the links within each task connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if read:
            nodes, roots = forest(*(np.concatenate(ends) for ends in zip(*read, strict=True)))
            away = nodes != roots
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[away]), pa.array(roots[away])], ["u", "v"])

    return edges.coalesce(tasks).mapInArrow(run, "u long, v long")


def _with_least(pairs: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """(u, v, least): with the least neighbour of u; and the table of the least ones.

    The least ones are kept first: then both sides of the join are plain shuffles, and
    Spark can split a node that has very many neighbours.
    """
    least = saved(pairs.groupBy("u").agg(F.min("v").alias("least")), rows)
    return pairs.join(least.hint("merge"), "u"), least


def components(
    links: DataFrame, max_rounds: int = 60, links_each: int = LINKS_EACH,
) -> DataFrame:
    """(node, component) of the nodes in ``links`` (columns u, v: long); a component
    bears the least of its nodes. Self-links and repeated links do no harm.

    Each task first connects the links it holds, ``links_each`` on average. Then every
    node is joined to the least neighbour of its larger ones and of its smaller
    ones, and so on until each component is a star around its least node. Links that one
    task holds are stars after the first step.
    """
    edges = saved(links.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v"))
    place = F.xxhash64("u", "v").cast("decimal(38,0)")
    for _ in range(max_rounds):
        tasks = max(1, -(-edges.count() // links_each))
        stars = saved(_stars(edges, tasks))
        forget(edges)
        edges = stars
        if tasks == 1:
            break
        mark = edges.agg(F.count("*"), F.sum(place)).first()
        n = mark[0]
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, least = _with_least(both, 2 * n)
        large = saved(packed(large.filter("v > u").select(
            F.col("v").alias("u"), F.least("u", "least").alias("v")), 2 * n).distinct(), n)
        small, lesser = _with_least(large, n)
        own = small.select("u", F.col("least").alias("v"))
        others = small.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        joined = saved(packed(own.union(others), n).distinct(), n)
        forget(edges, least, large, lesser)
        edges = joined
        if edges.agg(F.count("*"), F.sum(place)).first() == mark:
            break
    else:
        raise RuntimeError("components not found within max_rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = saved(stars.union(centres), 2 * edges.count())
    forget(edges)
    return found
