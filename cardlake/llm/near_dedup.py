"""Near-duplicate texts by DartMinHash signatures over word shingles.

Each shingle of a text owns a strip as wide as its weight in a plane of weight and
rank. Hashed darts fall on the strip one after the other by rank; those that hit a
text's part of it count. A dart belongs to one of k coordinates by its hash, and the
earliest of each coordinate are the signature: two texts agree in a coordinate with
the probability of their weighted Jaccard similarity. Bands of coordinates bring
candidates together, which are then compared by their whole shingle sets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.bpe_automaton import slices
from cardlake.llm.common import (
    ROWS_EACH, forget, fresh, numbered, on_files, packed, saved, text_or_empty, without_rows,
)
from cardlake.llm.components import components
from cardlake.llm.hashing import STEPS, U, mixed, spans, times

SHINGLE = 5
SIMILARITY = 0.8
# 24 bands of 5 coordinates: of pairs with similarity 0.8, all but 7 in 100,000 share one.
BANDS, BAND_ROWS = 24, 5
# Passes that compare rows with leaders before the rest is joined: see ``_links``.
ROUNDS = 2
# Shingle sets that go to one task where rows of the others count ``ROWS_EACH``.
SETS_EACH = 5_000
# Sizes of sets in the join of the rest go by classes that grow so; and the counters,
# at most, by whose sums it orders shingles.
GROWTH = 1.05
MAX_COUNTERS = 1 << 22
# Up to so many row numbers (8 bytes each) are broadcast.
MAX_BROADCAST_ROWS = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Bytes hashed at once.
_BLOCK = 1 << 20
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def _block_hashes(block: bytes) -> np.ndarray:
    """A 64-bit hash of each word of some text, in order."""
    raw = np.frombuffer(block, np.uint8)
    word = ~_SPACE[raw]
    edges = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return spans(raw, starts, ends)


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word ``[^\\x20\\x09-\\x0D]+``; long texts go block by block."""
    raw = text.encode()
    if len(raw) <= _BLOCK:
        return _block_hashes(raw)
    found, start = [], 0
    while start < len(raw):
        gap = _BREAK.search(raw, start + _BLOCK)
        end = gap.start() if gap else len(raw)
        found.append(_block_hashes(raw[start:end]))
        start = end
    return np.concatenate(found)


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of each window of ``size`` words; of a shorter text the whole is one."""
    count = len(words)
    if not count:
        return words
    size = min(size, count)
    total = np.zeros(count - size + 1, U) + U(size)
    for place in range(size):
        total = mixed(total * STEPS[place % 5] + words[place:place + count - size + 1])
    return total


def weighted(hashes: np.ndarray, weight: str) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles and their weights: 1 (``set``) or how often they occur (``count``)."""
    if weight == "set":
        unique = np.unique(hashes)
        return unique, np.ones(len(unique))
    unique, counts = np.unique(hashes, return_counts=True)
    return unique, counts.astype(float)


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1], from the upper 53 bits."""
    return ((x >> U(11)).astype(float) + 1.0) / (1 << 53)


def _darts(elements, weights, owner, limit):
    """(owner, rank, hash) of the darts that hit, up to the owner's ``limit`` of rank.

    The strip of an element is cut into cells [0, 1), [1, 2), [2, 4), [4, 8), ...; the
    darts of a cell are a Poisson stream by rank, at uniform places across, and are the
    same for all texts: a text's weight only says which of them hit.
    """
    found = []
    cell, low, width = 0, 0.0, 1.0
    while True:
        inside = weights > low
        if not inside.any():
            break
        seed = mixed(elements[inside] + times(2, cell))
        own, weight = owner[inside], weights[inside]
        rank = np.zeros(len(seed))
        number = 0
        while len(seed):
            draw = mixed(seed + times(3, number))
            rank = rank - np.log(_uniform(draw)) / width
            on = rank <= limit[own]
            seed, own, weight, rank, draw = seed[on], own[on], weight[on], rank[on], draw[on]
            dart = mixed(draw ^ STEPS[4])
            hit = low + width * _uniform(dart) <= weight
            found.append((own[hit], rank[hit], mixed(dart)[hit]))
            number += 1
        cell, low, width = cell + 1, low + width, max(1.0, low + width)
    return (np.concatenate([f[i] for f in found]) for i in range(3))


def dart_signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """k hashes for each weighted set: the earliest dart of each coordinate.

    Darts are thrown as far in rank as fills k coordinates nearly always; for sets with
    one left empty, twice as far again. An empty set has zeros.
    """
    signatures = np.zeros((len(sets), k), U)
    left = np.array([i for i, (e, _) in enumerate(sets) if len(e)], np.int64)
    reach = k * np.log(k) + 3 * k if k > 1 else 8.0
    while len(left):
        sizes = [len(sets[i][0]) for i in left]
        elements = np.concatenate([sets[i][0] for i in left])
        weights = np.concatenate([sets[i][1] for i in left])
        owner = np.repeat(np.arange(len(left)), sizes)
        limit = reach / np.array([sets[i][1].sum() for i in left])
        own, rank, dart = _darts(elements, weights, owner, limit)
        place = own * k + ((dart >> U(20)) % U(k)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")  # the earliest is written last
        rows = np.zeros(len(left) * k, U)
        rows[place[order]] = dart[order] | U(1)
        rows = rows.reshape(len(left), k)
        full = (rows != 0).all(axis=1)
        signatures[left[full]] = rows[full]
        left, reach = left[~full], reach * 2
    return signatures


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    cut = signatures.reshape(len(signatures), bands, rows)
    keys = np.zeros((len(signatures), bands), U) + np.arange(1, bands + 1, dtype=U)
    for row in range(rows):
        keys = mixed(keys * STEPS[row % 5] + cut[:, :, row])
    return keys.view(np.int64)


def _sets_of(texts: list[str], size: int, weight: str):
    words = [word_hashes(t) for t in texts]
    return words, [weighted(shingles(w, size), weight) for w in words]


def _signed(read: DataFrame, bands: int, band_rows: int, size: int, weight: str) -> DataFrame:
    """(row, doc_id, content: digest of the words in order, keys: of the bands)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                words, sets = _sets_of(part.column(2).to_pylist(), size, weight)
                keys = band_keys(dart_signatures(sets, bands * band_rows), bands, band_rows)
                content = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in words]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(content, pa.binary()),
                    pa.array([k if len(w) else [] for k, w in zip(keys, words, strict=True)],
                             pa.list_(pa.int64())),
                ], ["row", "doc_id", "content", "keys"])

    return read.mapInArrow(run, "row long, doc_id long, content binary, keys array<long>")


def _shingle_sets(read: DataFrame, size: int, weight: str) -> DataFrame:
    """(row, shingles: sorted 32-bit hashes). With weights, each occurrence is one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices([batch]):
                _, sets = _sets_of(texts, size, weight)
                packed = []
                for elements, weights in sets:
                    if weight == "count":
                        times = weights.astype(np.int64)
                        first = np.repeat(np.cumsum(times) - times, times)
                        turn = (np.arange(times.sum()) - first).astype(U)
                        elements = mixed(np.repeat(elements, times) + turn)
                    packed.append(np.unique((elements >> U(32)).astype("<u4")).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(packed, pa.binary())], ["row", "shingles"])

    return read.mapInArrow(run, "row long, shingles binary")


def _similar(pairs: DataFrame, least: float) -> DataFrame:
    """(u, v) of the pairs (u, v, a, b: shingle sets) that are similar enough."""
    def alike(a: bytes, b: bytes) -> bool:
        a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
        if min(len(a), len(b)) < least * max(len(a), len(b)):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both >= least * (len(a) + len(b) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                keep = pa.array([alike(a, b) for a, b in sets], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).filter(keep) for i in (0, 1)], ["u", "v"])

    return pairs.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _led(buckets: DataFrame, entries: int, tried: DataFrame | None, turn: int) -> DataFrame:
    """(u, v): each bucket's rows with its leader, where the two are not connected yet.

    ``buckets``: (key, node, component). The first time the leaders are those least by
    one hash of the node, so that a group has few; later by a hash of node and key.
    """
    order = F.xxhash64("node") if turn == 0 else F.xxhash64("node", "key", F.lit(turn))
    leaders = saved(buckets.groupBy("key").agg(
        F.min(F.struct(order.alias("order"), "node", "component")).alias("leader"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).filter("low != high").select(
        "key", F.col("leader.node").alias("v"), F.col("leader.component").alias("own")), entries)
    pairs = packed(buckets.join(leaders.hint("merge"), "key"), entries).filter(
        "component != own").select(
        F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v")).distinct()
    if tried is not None:
        pairs = pairs.join(tried.hint("merge"), ["u", "v"], "left_anti")
    kept = saved(pairs, entries)
    forget(leaders)
    return kept


def _rest(current: DataFrame, entries: int) -> DataFrame:
    """(node, component) of the rows of buckets whose pairs are neither all compared nor
    all connected. A bucket of two rows has been compared."""
    mixed_ = current.groupBy("key").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"),
    ).filter("n > 2 and low != high").select("key")
    met = packed(current.join(packed(mixed_, entries).hint("merge"), "key"), entries)
    return met.select("node", "component").distinct()


def _counters(sets: DataFrame) -> np.ndarray:
    """How many sets have a shingle of each counter (by its lowest bits), 0 for only one."""
    total = sets.agg(F.coalesce(F.sum(F.length("shingles")), F.lit(0)).alias("n")).first()["n"] // 4
    size = min(MAX_COUNTERS, 1 << max(10, int(total).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                np.add.at(counts, np.frombuffer(packed, "<u4") & np.uint32(size - 1), 1)
        used = counts.nonzero()[0]
        for start in range(0, len(used), 100_000):
            part = used[start:start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(counts[part])], ["place", "n"])

    found = sets.select("shingles").mapInArrow(run, "place long, n long").groupBy("place").agg(
        F.sum("n").alias("n")).filter("n > 1").toArrow()
    counts = np.zeros(size, np.int64)
    counts[found["place"].to_numpy()] = found["n"].to_numpy()
    return counts


def size_classes(most: int) -> np.ndarray:
    """The least size of each class of sizes, beyond ``most``."""
    low = [1]
    while low[-1] <= most:
        low.append(max(low[-1] + 1, int(low[-1] * GROWTH)))
    return np.array(low, np.int64)


def prefix_keys(shingles_: np.ndarray, counters: np.ndarray, least: float):
    """(key, side, place) of a set, so that of two sets as similar as ``least`` one has a
    key at side 0 that the other has at side 1; and the place of its shingle in the order.

    Shingles stand in one order for all sets, the rarest first. Two sets that share
    enough of them share one among the first of each: how many first ones depends on
    both sizes, hence on the class of the other's. A key is a shingle and the classes of
    both, the smaller one at side 0. What no other set has needs no key.
    """
    n = len(shingles_)
    often = counters[shingles_ & np.uint32(len(counters) - 1)]
    order = np.lexsort((shingles_, often))
    ordered, often = shingles_[order].astype(U), often[order]
    low = size_classes(int(n / least) + 1)
    own = int(np.searchsorted(low, n, "right")) - 1
    keys, sides, places = [], [], []
    for other in range(len(low) - 1):
        if low[other + 1] - 1 < least * n - 1e-9 or low[other] * least > n + 1e-9:
            continue
        small, large = sorted((own, other))
        fewest = max(int(low[other]), int(np.ceil(least * n - 1e-9)))
        shared = int(np.ceil(least / (1 + least) * (n + fewest) - 1e-9))
        place = np.flatnonzero(often[:max(0, n - shared + 1)] > 0).astype(np.int32)
        key = mixed(mixed(ordered[place] + times(1, small)) + times(2, large))
        for side in (0, 1):
            if (small, large)[side] == own:
                keys.append(key)
                sides.append(np.full(len(key), side, np.int32))
                places.append(place)
    return np.concatenate(keys), np.concatenate(sides), np.concatenate(places)


def _rest_pairs(rest: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(u, v) of all rows of different components that may be similar, by their rarest
    shingles (see ``prefix_keys``): no pair as similar as ``least`` is left out.

    Of a key's rows most may be of one component; these are not paired with each other.
    """
    shared = rest.sparkSession.sparkContext.broadcast(_counters(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found = [prefix_keys(np.frombuffer(s, "<u4"), shared.value, least)
                         for s in part.column(2).to_pylist()]
                keys, sides, places = (np.concatenate(f) for f in zip(*found, strict=True))
                sizes = [len(f[0]) for f in found]
                ns = np.array([len(s) // 4 for s in part.column(2).to_pylist()], np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys.view(np.int64)), pa.array(sides), pa.array(places),
                    pa.array(np.repeat(ns, sizes)),
                    *(pa.array(np.repeat(part.column(i).to_numpy(), sizes)) for i in (0, 1)),
                ], ["key", "side", "place", "size", "node", "component"])

    rows = rest.count()
    known = packed(
        rest.join(sets.select(F.col("row").alias("node"), "shingles").hint("merge"), "node"),
        rows * ROWS_EACH // SETS_EACH)
    entries = saved(known.select("node", "component", "shingles").mapInArrow(
        run, "key long, side int, place int, size int, node long, component long"))
    n = entries.count()
    by_component = packed(entries.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high")), n)
    main = saved(by_component.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("components"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ).filter("components > 1 and low = 0 and high = 1").select(
        "key", F.col("main.component").alias("main")), n)
    live = saved(entries.join(main.hint("merge"), "key").select(
        "key", "side", "place", "size", "node", "component",
        (F.col("component") == F.col("main")).alias("usual")), n)
    forget(entries, main)

    def side(number: int, which: str) -> DataFrame:
        return live.filter(f"side = {number} and {which}").select(
            F.col("key").alias(f"k{number}"), F.col("place").alias(f"p{number}"),
            F.col("size").alias(f"s{number}"), F.col("node").alias(f"n{number}"),
            F.col("component").alias(f"c{number}"))

    # What two sets share comes before the shingle in both, is it, or comes after it.
    most = "least(p0, p1) + least(s0 - p0, s1 - p1)"

    def paired(first: str, second: str) -> DataFrame:
        both = side(0, first).join(side(1, second).hint("merge"), F.expr(
            f"k0 = k1 and c0 != c1 and {1 + least!r}D * ({most}) >= {least!r}D * (s0 + s1) - 1e-6D"))
        return packed(both, live.count()).select(
            F.greatest("n0", "n1").alias("u"), F.least("n0", "n1").alias("v"))

    found = saved(paired("not usual", "true").union(paired("usual", "not usual")).distinct(), n)
    forget(live)
    return found


def _sets_for(nodes: DataFrame, read: DataFrame, size: int, weight: str) -> DataFrame:
    """``_shingle_sets`` of the rows in ``nodes`` (column row)."""
    few = nodes.count() <= MAX_BROADCAST_ROWS
    wanted = F.broadcast(nodes) if few else nodes.hint("shuffle_hash")
    return saved(_shingle_sets(
        read.select("row", "text").join(wanted, "row", "left_semi"), size, weight))


def _verified(pairs: DataFrame, rows: int, sets: DataFrame, least: float) -> DataFrame:
    """The similar ones of ``rows`` pairs."""
    of_u = sets.select(F.col("row").alias("u"), F.col("shingles").alias("a"))
    of_v = sets.select(F.col("row").alias("v"), F.col("shingles").alias("b"))
    each = rows * ROWS_EACH // SETS_EACH
    with_u = packed(pairs.join(of_u.hint("merge"), "u"), each)
    return saved(_similar(packed(with_u.join(of_v.hint("merge"), "v"), each), least), rows)


def _links(nodes: DataFrame, read: DataFrame, least: float, rounds: int, size: int, weight: str):
    """((u, v) verified links, (node, component)) of nodes with band keys.

    Rows of a bucket are not paired with each other at first: each is compared with the
    bucket's leader. A bucket whose rows are then in one component needs no more; in
    the others another leader is taken and compared with the rows not connected to
    it, ``rounds`` times at most. The rows of the buckets that still are in several
    components are then joined by their rarest shingles, which leaves no link out, also
    where a bucket is crowded by a passage that many texts share.
    """
    keyed = saved(nodes.select("node", F.explode("keys").alias("key")))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    shared = saved(shared, keyed.count())
    buckets = saved(keyed.join(shared.hint("merge"), "key").select("key", "node"), keyed.count())
    forget(keyed, shared)
    entries = buckets.count()
    current = buckets.withColumn("component", F.col("node"))
    links = tried = known = None
    for turn in range(rounds):
        pairs = _led(current, entries, tried, turn)
        n = pairs.count()
        if not n:
            forget(pairs)
            break
        needed = saved(
            pairs.select(F.col("u").alias("row")).union(pairs.select("v")).distinct(), 2 * n)
        sets = _sets_for(needed, read, size, weight)
        found = _verified(pairs, n, sets, least)
        forget(needed, sets)
        links, old = (found if links is None else saved(links.union(found))), links
        tried, past = (pairs if tried is None else saved(tried.union(pairs))), tried
        forget(old, past)
        if turn:
            forget(found, pairs)
        forget(known, current)
        known = components(links)
        current = saved(
            buckets.join(known.hint("merge"), "node", "left").select(
                "key", "node", F.coalesce("component", "node").alias("component")), entries)
    rest = saved(_rest(current, entries), entries)
    forget(current, buckets)
    if not rest.isEmpty():
        sets = _sets_for(rest.select(F.col("node").alias("row")), read, size, weight)
        pairs = _rest_pairs(rest, sets, least)
        if tried is not None:
            new = saved(pairs.join(tried.hint("merge"), ["u", "v"], "left_anti"), pairs.count())
            forget(pairs)
            pairs = new
        found = _verified(pairs, pairs.count(), sets, least)
        forget(pairs, sets)
        if not found.isEmpty():
            links, old = (found if links is None else saved(links.union(found))), links
            forget(old, known)
            known = components(links)
    forget(rest, tried)
    if links is None:
        spark = nodes.sparkSession
        empty = spark.createDataFrame([], "u long, v long")
        return empty, spark.createDataFrame([], "node long, component long")
    return links, known


def near_duplicates(
    docs: DataFrame, least: float = SIMILARITY, text: str = "text", doc_id: str = "doc_id",
    shingle: int = SHINGLE, weight: str = "set", bands: int = BANDS, band_rows: int = BAND_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, n_links, kept, row.

    Texts with the same words in order are copies; of each, one stands for all. Two
    texts are linked if their ``shingle``-word windows (of a shorter text: all its
    words) have a Jaccard similarity of ``least`` or more; ``weight="count"`` counts
    how often windows occur. A class is what links and copies connect. ``class_id`` is
    its least doc_id, and the row with it is kept; null ids come last, and of rows
    with the same id the first in the table is kept. ``n_links`` counts the links
    verified for the row's text, which are enough to connect the class but not all.
    Null, empty and blank texts have no window and are copies of each other. Repeated
    rows are copies; an empty table gives an empty answer; further columns of ``docs``
    do not matter.
    """
    row = fresh(docs, "row")
    read = numbered(on_files(docs), row).select(
        F.col(row).alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
        text_or_empty(text).alias("text"))
    rows = saved(_signed(read, bands, band_rows, shingle, weight))
    # Nulls last, then by id and place.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    copies = saved(rows.groupBy("content").agg(
        F.min(order).alias("first"), F.count("*").alias("copies")))
    n = copies.count()
    texts = copies.select("content", "first", "copies", F.col("first.row").alias("node"))
    keys = rows.select(F.col("row").alias("node"), "keys")
    nodes = keys.join(texts.select("node").hint("merge"), "node")
    links, known = _links(nodes, read, least, rounds, shingle, weight)
    ends = links.select(F.col("u").alias("node")).union(links.select("v"))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    # Linked texts with their component; the others are classes of their own.
    linked = packed(texts.join(known.hint("merge"), "node"), n)
    linked = saved(linked.join(packed(degree, n).hint("merge"), "node", "left").drop("node"), n)
    forget(links, known)
    classes = saved(linked.groupBy("component").agg(
        F.min("first").alias("least"), F.sum("copies").alias("class_size")), n)
    in_class = linked.join(classes.hint("merge"), "component").select(
        "content", "least", "class_size", "n_links")
    alone = texts.join(linked.select("content").hint("merge"), "content", "left_anti").select(
        "content", F.col("first").alias("least"), F.col("copies").alias("class_size"),
        F.lit(0).cast("long").alias("n_links"))
    judged = saved(in_class.union(alone), 2 * n)
    forget(linked, classes, copies)
    return rows.select("row", "doc_id", "content").join(judged.hint("merge"), "content").select(
        "doc_id", F.col("least.doc_id").alias("class_id"), "class_size",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (F.col("row") == F.col("least.row")).alias("kept"), "row")


def drop_near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, all columns as they are."""
    docs = on_files(docs)
    found = near_duplicates(docs, least)
    return without_rows(docs, found.filter(~F.col("kept")), "row")
