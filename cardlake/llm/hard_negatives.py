"""Hard negatives of anchors, from candidate blocks along a Hilbert curve with zone maps.

Candidates are put in order of label and place on a Hilbert curve through the components
that vary most, and written as Parquet rows of one block each: some hundred vectors of
one label, with the least and largest value of every component. The least and largest
score that an anchor can have with anything in a block follow from these by interval
arithmetic. They say which blocks can hold one of the anchor's first positives, or a
score in one of its windows; only these are read. Each time a first pass reads the most
promising block of each stretch of zone maps, and what it finds narrows the second pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import forget, saved, shuffle_partitions
from cardlake.llm.vectors import integers, matrix, whole_vectors

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
# Rows of a block; blocks whose zone maps are looked at together; anchors that are.
BLOCK_ROWS, STRETCH, ANCHORS_EACH = 512, 1024, 256
# Rows that go to one task when they are put in order.
SORT_ROWS = 200_000
# Components the curve goes through, and bits of each: 64 in all.
CURVE, BITS = 16, 4

_BLOCK = ("block long, label long, n int, first_id long, ids array<long>, "
          "parts array<int>, low array<int>, high array<int>")
_NEED = ("group long, block long, anchors array<long>, own array<long>, parts array<int>, "
         "lows array<long>, highs array<long>, ties array<long>")
_FOUND = "anchor long, window int, vec_id long, score long"
_LARGE, _SMALL = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the curve of each column of ``cells`` (axes x rows, of ``bits`` bits).

    From the highest bit down, an axis whose bit is set turns the lower bits of the first
    axis round, another swaps them with its own; what remains is a Gray code.
    """
    x = cells.astype(np.uint64).copy()
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        lower = np.uint64((1 << bit) - 1)
        for axis in range(len(x)):
            is_set = (x[axis] >> np.uint64(bit)) & one == 1
            swap = np.where(is_set, 0, (x[0] ^ x[axis]) & lower).astype(np.uint64)
            x[0] ^= np.where(is_set, lower, swap).astype(np.uint64)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turned = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, 0, -1):
        is_set = (x[-1] >> np.uint64(bit)) & one == 1
        turned ^= np.where(is_set, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turned
    place = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            place = (place << one) | ((x[axis] >> np.uint64(bit)) & one)
    return place


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(least, largest) score of each anchor (rows) with anything in each block (columns),
    by interval arithmetic: a positive component is least at the low end, a negative one
    at the high end."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return (_product(up, low) + _product(down, high), _product(up, high) + _product(down, low))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of integer rows; in doubles where these hold every sum."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _lists(column) -> np.ndarray:
    """A column of lists of one length as a matrix of longs."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy().astype(np.int64).reshape(len(whole), -1)


def _as_lists(rows: np.ndarray, kind) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.ravel(), kind))


def _moments(kept: DataFrame, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each component, over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = integers(matrix(batch.column(0)), scale).astype(float)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(x.shape[1])), pa.array(x.sum(0)), pa.array((x * x).sum(0)),
                    pa.array(np.full(x.shape[1], len(x)))], ["place", "total", "squares", "n"])

    found = kept.select("vector").mapInArrow(
        run, "place long, total double, squares double, n long").groupBy("place").agg(
        F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.sum("n").alias("n"))
    rows = sorted(found.collect())
    mean = np.array([r["total"] / r["n"] for r in rows])
    square = np.array([r["squares"] / r["n"] for r in rows])
    return mean, np.sqrt(np.maximum(square - mean * mean, 0))


def _on_curve(kept: DataFrame, moments: tuple[np.ndarray, np.ndarray], scale: int) -> DataFrame:
    """(vec_id, label, parts: integer components, curve: place on the Hilbert curve)."""
    mean, spread = moments
    axes = np.argsort(-spread, kind="stable")[:CURVE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = integers(matrix(batch.column(2)), scale)
                away = (x[:, axes] - mean[axes]) / np.maximum(spread[axes], 1e-9)
                cells = np.clip((away + 2) * (1 << BITS) / 4, 0, (1 << BITS) - 1)
                curve = hilbert(cells.T.astype(np.int64), BITS) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1), _as_lists(x, pa.int32()),
                    pa.array(curve.view(np.int64))], ["vec_id", "label", "parts", "curve"])

    return kept.select("vec_id", "label", "vector").mapInArrow(
        run, "vec_id long, label long, parts array<int>, curve long")


def candidate_blocks(on_curve: DataFrame, rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``_BLOCK`` of (vec_id, label, parts, curve): blocks of one label with their zone maps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, parts, own = [], [], None

        def block():
            x = np.concatenate(parts)
            listed = np.concatenate(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([own]), pa.array([len(x)], pa.int32()),
                pa.array([listed.min()]), _as_lists(listed[None], pa.int64()),
                _as_lists(x.reshape(1, -1), pa.int32()), _as_lists(x.min(0)[None], pa.int32()),
                _as_lists(x.max(0)[None], pa.int32())],
                ["block", "label", "n", "first_id", "ids", "parts", "low", "high"])

        for batch in batches:
            if not batch.num_rows:
                continue
            labels = batch.column("label").to_numpy()
            listed, x = batch.column("vec_id").to_numpy(), _lists(batch.column("parts"))
            start = 0
            while start < len(labels):
                held = sum(map(len, ids))
                if held and (held == block_rows or labels[start] != own):
                    yield block()
                    number, ids, parts, held = number + 1, [], [], 0
                own = int(labels[start])
                change = np.flatnonzero(labels[start:] != own)
                end = min(
                    start + block_rows - held, start + (change[0] if len(change) else len(labels)),
                    len(labels))
                ids.append(listed[start:end])
                parts.append(x[start:end])
                start = end
        if ids:
            yield block()

    order = ["label", "curve", "vec_id"]
    tasks = shuffle_partitions(on_curve.sparkSession, rows, SORT_ROWS)
    placed = on_curve.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return saved(placed.mapInArrow(run, _BLOCK))


def _needs(
    anchors: DataFrame, zones: DataFrame, stretches: int, groups: int, same: bool, only_best: bool,
) -> DataFrame:
    """``_NEED``: the blocks each group of anchors reads, with the anchors that do.

    An anchor needs a block of its own label (``same``) or of another that can hold a
    score in one of its windows ``lows`` to ``highs`` and, at the lowest score itself, an
    id below ``ties``. ``only_best``: the one with the largest bound of each stretch;
    otherwise all but those it has ``seen``.
    """
    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            x, low, high = (_lists(c) for c in (left["parts"], right["low"], right["high"]))
            least, largest = bounds(x, low, high)
            of, label = left["label"].to_numpy(), right["label"].to_numpy()
            block, first = right["block"].to_numpy(), right["first_id"].to_numpy()
            wanted = np.zeros(least.shape, bool)
            lows, highs, ties = (_lists(left[c]) for c in ("lows", "highs", "ties"))
            for w in range(lows.shape[1]):
                a, b, tie = (y[:, w][:, None] for y in (lows, highs, ties))
                wanted |= (least <= b) & (a <= b) & (
                    (largest > a) | (largest == a) & (first[None] < tie))
            wanted &= (of[:, None] == label[None]) == same
            if only_best:
                best = np.where(wanted, largest, _SMALL).argmax(axis=1)
                alone = np.zeros_like(wanted)
                alone[np.arange(len(x)), best] = True
                wanted &= alone
            else:
                for i, seen in enumerate(left["seen"].to_pylist()):
                    wanted[i] &= ~np.isin(block, np.array(seen, np.int64))
            for j in np.flatnonzero(wanted.any(axis=0)):
                use = np.flatnonzero(wanted[:, j])
                rows.append((
                    left["group"][0].as_py(), int(block[j]), left["anchor"].to_numpy()[use],
                    left["vec_id"].to_numpy()[use], x[use].ravel(), lows[use].ravel(),
                    highs[use].ravel(), ties[use].ravel()))
        names = ["group", "block", "anchors", "own", "parts", "lows", "highs", "ties"]
        kinds = [pa.int64()] * 2 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.int32())] + [
            pa.list_(pa.int64())] * 3
        return pa.table({
            name: pa.array([r[i] for r in rows], kind)
            for i, (name, kind) in enumerate(zip(names, kinds, strict=True))})

    left = anchors.withColumn("stretch", F.explode(F.sequence(F.lit(0), F.lit(stretches - 1))))
    right = zones.withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    return left.groupBy("group", "stretch").cogroup(
        right.groupBy("group", "stretch")).applyInArrow(choose, _NEED)


def _read(needs: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """``_FOUND``: the first ``k`` rows of each block read that lie in an anchor's window.

    ``needs`` holds a row per group of anchors and block, so one task reads one block
    for a bounded number of anchors at a time.
    """
    def search(rows: pa.Table) -> pa.Table:
        anchors, windows, ids, scores = [], [], [], []
        for row in range(rows.num_rows):
            one = {name: rows[name][row].values.to_numpy().astype(np.int64) for name in (
                "anchors", "own", "parts", "lows", "highs", "ties", "ids", "of_block")}
            n = len(one["anchors"])
            product = _product(one["parts"].reshape(n, -1), one["of_block"].reshape(len(one["ids"]), -1))
            lows, highs, ties = (one[c].reshape(n, -1) for c in ("lows", "highs", "ties"))
            for i in range(n):
                other = one["ids"] != one["own"][i]
                for w in range(lows.shape[1]):
                    score = product[i]
                    fits = np.flatnonzero(other & (score <= highs[i, w]) & (
                        (score > lows[i, w]) | (score == lows[i, w]) & (one["ids"] < ties[i, w])))
                    if len(fits) > k:
                        fits = fits[np.lexsort((one["ids"][fits], -score[fits]))[:k]]
                    anchors.append(np.full(len(fits), one["anchors"][i]))
                    windows.append(np.full(len(fits), w, np.int32))
                    ids.append(one["ids"][fits])
                    scores.append(score[fits])
        return pa.table({
            "anchor": pa.array(np.concatenate(anchors), pa.int64()),
            "window": pa.array(np.concatenate(windows), pa.int32()),
            "vec_id": pa.array(np.concatenate(ids), pa.int64()),
            "score": pa.array(np.concatenate(scores), pa.int64())})

    read = blocks.select("block", "ids", F.col("parts").alias("of_block"))
    return needs.join(read, "block").groupBy("block", "group").applyInArrow(search, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _mined(anchors, blocks, zones, stretches, groups, same: bool, k: int) -> DataFrame:
    """(anchor, window, vec_id, score, rank): the first ``k`` of each window of each anchor.

    ``anchors``: (group, anchor, vec_id, label, parts, lows, highs), lows inclusive.
    """
    open_ties = anchors.withColumn("ties", F.transform("lows", lambda x: F.lit(_LARGE)))
    picked = saved(_needs(open_ties, zones, stretches, groups, same, True))
    found = saved(_read(picked, blocks, k))
    best = _first(found, k)
    # The k-th found bounds what can still come: a higher score, or the same and a lower id.
    kth = best.filter(F.col("rank") == k).select(
        "anchor", F.struct("window", "score", "vec_id").alias("kth")).groupBy("anchor").agg(
        F.collect_list("kth").alias("kth"))  # one per window
    seen = picked.select(F.explode("anchors").alias("anchor"), "block").groupBy("anchor").agg(
        F.collect_list("block").alias("seen"))  # one per stretch

    def bound(field: str, otherwise: Column) -> Column:
        return F.transform(otherwise, lambda x, i: F.coalesce(F.get(F.transform(
            F.filter("kth", lambda y: y["window"] == i), lambda y: y[field]), F.lit(0)), x))

    narrowed = open_ties.join(kth, "anchor", "left").join(seen, "anchor", "left").withColumns({
        "kth": F.coalesce("kth", F.expr("cast(array() as array<struct<window:int,score:long,vec_id:long>>)")),
        "seen": F.coalesce("seen", F.expr("cast(array() as array<long>)")),
    }).withColumns({"lows": bound("score", F.col("lows")), "ties": bound("vec_id", F.col("ties"))})
    narrowed = saved(narrowed.drop("kth"))
    rest = saved(_read(_needs(narrowed, zones, stretches, groups, same, False), blocks, k))
    both = saved(_first(found.union(rest), k))
    forget(picked, found, narrowed, rest)
    return both


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
    vec_id: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS,
    stretch: int = STRETCH, anchors_each: int = ANCHORS_EACH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x), within plus and minus 2^24, and scores are inner
    products. Positives of an anchor are the first ``positives`` other rows with its
    ``label``, a whole number; for each, the first ``negatives`` rows of other labels
    between ``low`` and ``high`` percent of its score are given. Higher scores come first,
    then smaller ids. A positive without a negative gives no row, nor does one with a
    score below zero.

    Rows take no part whose id, label or vector is null, or whose vector is empty, of
    another length than the one with the least id, or holds a null or non-finite
    component. Rows with an anchor's id are no other rows; of a repeated anchor each
    row is one, and repeated rows each are candidates. An empty table gives an empty
    answer; further columns of ``vectors`` do not matter.
    """
    kept = whole_vectors(
        vectors.filter(F.col(vec_id).isNotNull() & label.isNotNull()), vec_id, vector,
        label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = kept.count()
    if not rows:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, "
                "positive_score long, negative_score long")
    moments = _moments(kept, scale)
    blocks = candidate_blocks(_on_curve(kept, moments, scale), rows, block_rows)
    stretches = max(1, -(-blocks.count() // stretch))
    zones = blocks.select(
        "block", "label", "first_id", "low", "high",
        F.pmod(F.xxhash64("block"), F.lit(stretches)).cast("int").alias("stretch"))
    asking = kept.filter("asks")
    # Anchors that are near on the curve read much the same blocks.
    dealt = _on_curve(asking, moments, scale).repartitionByRange(
        max(1, -(-asking.count() // anchors_each)), "curve", "vec_id")
    anchors = saved(dealt.select(
        F.spark_partition_id().cast("long").alias("group"),
        F.monotonically_increasing_id().alias("anchor"), "vec_id", "label", "parts"))
    groups = (anchors.agg(F.max("group").alias("n")).first()["n"] or 0) + 1

    any_score = anchors.withColumns({
        "lows": F.array(F.lit(_SMALL)), "highs": F.array(F.lit(_LARGE))})
    first = _mined(any_score, blocks, zones, stretches, groups, True, positives)
    by_anchor = first.groupBy("anchor").agg(F.sort_array(F.collect_list(
        F.struct("rank", "score"))).alias("best"))  # ``positives`` at most

    # Ends of each positive's window in whole scores; an empty one where there is none.
    def ends(value: str, otherwise: int) -> Column:
        return F.expr(f"transform(sequence(0, {positives - 1}), i -> if(get(best, i).score >= 0, "
                      f"({value.format('get(best, i).score')}) div 100, {otherwise}L))")

    inside = saved(anchors.join(by_anchor, "anchor").withColumns({
        "lows": ends(f"{low} * {{}} + 99", 1), "highs": ends(f"{high} * {{}}", 0)}).drop("best"))
    found = _mined(inside, blocks, zones, stretches, groups, False, negatives)
    of_window = first.select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    names = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return found.join(of_window, ["anchor", "window"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
