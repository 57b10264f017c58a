"""Exact dedup by an index of live digests behind cuckoo filters.

The index is a table of entries (digest, document that stays, group size) spread
over shards by digest. In a shard, a cuckoo filter of 16-bit fingerprints answers
most look-ups; a hit is verified against the digests stored for the bucket's slots,
and a full filter is rebuilt at twice the size from the stored digests. Inserts and
deletions come as batches: see ``change_index``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import (
    SPACE_CLASS, fresh, numbered, on_files, saved, shuffle_partitions, text_or_empty, without_rows,
)

SLOTS = 4
MAX_KICKS = 200
# Entries a map task holds before it passes them on; entries in a shard on average.
MAP_ENTRIES = 200_000
SHARD_ENTRIES = 250_000

LIVE, DELETE, INSERT = 0, 1, 2
ENTRY = "digest binary, keep_id long, keep_row long, group_size long"


class CuckooIndex:
    """Digests with the least (id, row) and the number of rows of each.

    ``slots`` holds fingerprints, ``held`` the number of the entry behind each slot,
    so a bucket's content can be compared with a digest that its fingerprints match.
    An id may be None, which comes after all others.
    """

    def __init__(self, buckets: int = 1024):
        self.entries: list[list | None] = []
        self.free: list[int] = []
        self.live = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.buckets = buckets
        self.slots = [0] * (buckets * SLOTS)
        self.held = [0] * (buckets * SLOTS)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        fingerprint = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & (self.buckets - 1)
        return fingerprint, first, self._other(first, fingerprint)

    def _other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ (fingerprint * 0x5BD1E995 & (self.buckets - 1))

    def _find(self, digest: bytes) -> int:
        """The slot of a live digest, or -1. A matching fingerprint is verified."""
        fingerprint, first, second = self._places(digest)
        for bucket in (first, second):
            start = bucket * SLOTS
            for slot in range(start, start + SLOTS):
                if self.slots[slot] == fingerprint:
                    if self.entries[self.held[slot]][0] == digest:
                        return slot
        return -1

    def _place(self, digest: bytes, number: int) -> bool:
        """Put a fingerprint into a slot, moving others; False if the filter is full."""
        fingerprint, bucket, second = self._places(digest)
        for place in (bucket, second):
            start = place * SLOTS
            for slot in range(start, start + SLOTS):
                if not self.slots[slot]:
                    self.slots[slot], self.held[slot] = fingerprint, number
                    return True
        bucket = second
        for kick in range(MAX_KICKS):
            slot = bucket * SLOTS + (kick + fingerprint) % SLOTS
            self.slots[slot], fingerprint = fingerprint, self.slots[slot]
            self.held[slot], number = number, self.held[slot]
            bucket = self._other(bucket, fingerprint)
            start = bucket * SLOTS
            for slot in range(start, start + SLOTS):
                if not self.slots[slot]:
                    self.slots[slot], self.held[slot] = fingerprint, number
                    return True
        return False

    def _grow(self) -> None:
        """Twice the buckets, filled again from the stored digests."""
        size = self.buckets
        while True:
            size *= 2
            self._empty(size)
            if all(self._place(e[0], n) for n, e in enumerate(self.entries) if e):
                return

    def insert(self, digest: bytes, keep: tuple, rows: int) -> None:
        slot = self._find(digest)
        if slot >= 0:
            entry = self.entries[self.held[slot]]
            entry[1] = min(entry[1], keep)
            entry[2] += rows
            return
        entry = [digest, keep, rows]
        if self.free:
            number = self.free.pop()
            self.entries[number] = entry
        else:
            number = len(self.entries)
            self.entries.append(entry)
        self.live += 1
        if not self._place(digest, number):
            self._grow()

    def delete(self, digest: bytes) -> bool:
        """Forget a live digest; whether there was one."""
        slot = self._find(digest)
        if slot < 0:
            return False
        number = self.held[slot]
        self.slots[slot] = 0
        self.entries[number] = None
        self.free.append(number)
        self.live -= 1
        return True

    def __contains__(self, digest: bytes) -> bool:
        return self._find(digest) >= 0

    def table(self) -> pd.DataFrame:
        live = [e for e in self.entries if e]
        return pd.DataFrame({
            "digest": [e[0] for e in live],
            "keep_id": pd.array([e[1][1] for e in live], dtype="Int64"),
            "keep_row": [e[1][2] for e in live],
            "group_size": [e[2] for e in live],
        })


def _keep(doc_id, row) -> tuple:
    """Order of the rows that may stay: least id, nulls last, then least row."""
    return (True, 0, row) if pd.isna(doc_id) else (False, int(doc_id), row)


def _insert(index: CuckooIndex, batch: pd.DataFrame) -> None:
    columns = (batch[c] for c in ("digest", "keep_id", "keep_row", "group_size"))
    for digest, doc_id, row, rows in zip(*columns, strict=True):
        index.insert(bytes(digest), _keep(doc_id, row), rows)


def _shown(table: pd.DataFrame, index: CuckooIndex) -> pd.DataFrame:
    null = [e[1][0] for e in index.entries if e]
    table.loc[null, "keep_id"] = pd.NA
    return table


def _in_task(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of one map task, summed before they are shuffled."""
    index = CuckooIndex()
    for batch in batches:
        _insert(index, batch)
        if index.live >= MAP_ENTRIES:
            yield _shown(index.table(), index)
            index = CuckooIndex()
    yield _shown(index.table(), index)


def _in_shard(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Live entries of a shard after a batch: rows come as those that are live, deletions,
    and inserts."""
    index = CuckooIndex()
    for batch in batches:
        _insert(index, batch[batch["op"] == LIVE])
        for digest in batch.loc[batch["op"] == DELETE, "digest"]:
            index.delete(bytes(digest))
        _insert(index, batch[batch["op"] == INSERT])
    yield _shown(index.table(), index)


def normalised(text: str = "text"):
    """A text with each run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), SPACE_CLASS + "+", " ")


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(digest, keep_id, keep_row, group_size 1) of each row."""
    return numbered(on_files(docs), fresh(docs, "row")).select(
        F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
        F.col(doc_id).cast("long").alias("keep_id"),
        F.col(fresh(docs, "row")).alias("keep_row"),
        F.lit(1).cast("long").alias("group_size"),
    )


def change_index(
    index: DataFrame | None, inserts: DataFrame | None = None, deletes: DataFrame | None = None,
    shards: int | None = None,
) -> DataFrame:
    """The index after a batch: deletions (column ``digest``) first, then inserts.

    ``index`` and the answer have the columns of ``ENTRY``, ``inserts`` those of
    ``digests``. An insert of a live digest joins its group; after a deletion the
    same digest starts a group anew. Deleting a digest that is not live does nothing.
    Inserts are summed per map task first, so that a digest of many rows comes to its
    shard as one row a task.
    """
    parts = []
    if index is not None:
        parts.append(index.withColumn("op", F.lit(LIVE)))
    if deletes is not None:
        parts.append(deletes.select(
            "digest", F.lit(None).cast("long").alias("keep_id"),
            F.lit(0).cast("long").alias("keep_row"), F.lit(0).cast("long").alias("group_size"),
            F.lit(DELETE).alias("op")))
    if inserts is not None:
        parts.append(inserts.mapInPandas(_in_task, ENTRY).withColumn("op", F.lit(INSERT)))
    changes = parts[0]
    for part in parts[1:]:
        changes = changes.unionByName(part)
    spark = changes.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = changes.repartition(shards, "digest").sortWithinPartitions("op")
    return placed.mapInPandas(_in_shard, ENTRY)


def find_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, row.

    Texts are equal when identical after each run of white space is one space; null
    counts as empty, so null, empty texts form one group. The row with the least id
    stays; a null id comes after all others, and of rows with the same id the first
    in the table stays. An empty table gives an empty answer; further columns of
    ``docs`` do not matter.
    """
    rows = saved(digests(docs, text, doc_id))
    shards = shuffle_partitions(docs.sparkSession, rows.count(), SHARD_ENTRIES)
    index = change_index(None, inserts=rows, shards=shards).select(
        "digest", "keep_id", F.col("keep_row").alias("stays"), "group_size")
    members = rows.select("digest", F.col("keep_id").alias("doc_id"), F.col("keep_row").alias("row"))
    return members.join(index, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("stays")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row")


def drop_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are."""
    docs = on_files(docs)
    found = find_duplicates(docs, text, doc_id)
    return without_rows(docs, found.filter(~F.col("kept")), "row")
