"""Harmonic packing of tokenized documents into sequences of a fixed length.

A length belongs to the class j of the reciprocal capacity it fits: capacity / (j + 1)
< length <= capacity / j. A bin of class j takes j pieces, whatever else comes, so each
task fills its bins on its own, without looking at others.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cardlake.llm.bpe_automaton import WORDS, BpeAutomaton, read_texts, slices

END_ID = 1
# Pieces of exactly a class's size that may be cut from what is left of a document
# after whole sequences, before the rest goes to the class it fits.
CUTS = 1


# Letters, digits and signs that both libraries take for the same: see ``TokenizerIds``.
_PLAIN = re.compile("[^\x00-\u024f]")


class TokenizerIds:
    """Ids as the tokenizers library gives them.

    Where the file's ids follow the order of its merges, texts of Latin letters are
    encoded by tiktoken with the same merges, at a third of the cost; the tests compare
    the two over that whole range. Texts with other letters, where the libraries may
    know different versions of Unicode, or with the string of a special token, go to
    tokenizers itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        automaton = BpeAutomaton(path)
        self.special = automaton.splitter
        # Whether no special token holds white space, and which ids begin with a space.
        self.apart = not any(c.isspace() for t in automaton.special for c in t)
        self.spaced = np.array([label[:1] == b" " for label in automaton.labels])
        self.fast = None
        made = [(rank, number) for number, rank in enumerate(automaton.made) if rank >= 0]
        in_order = [number for _, number in sorted(made)]
        if in_order == sorted(in_order):
            import tiktoken

            self.fast = tiktoken.Encoding(
                "plain", pat_str=WORDS.pattern, mergeable_ranks=automaton.ids, special_tokens={})

    def is_plain(self, text: str) -> bool:
        special = self.special is not None and self.special.search(text)
        return self.fast is not None and not special and not _PLAIN.search(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, unsigned 32-bit little-endian."""
        plain = [self.is_plain(t) for t in texts]
        rest = [t for t, p in zip(texts, plain, strict=True) if not p]
        slow = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        return [
            self.fast.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() if p
            else np.array(next(slow).ids, dtype="<u4").tobytes()
            for t, p in zip(texts, plain, strict=True)]


@lru_cache(maxsize=2)
def tokenizer_ids(path: str) -> TokenizerIds:
    """One per Python worker."""
    return TokenizerIds(path)


def cut(tokens: int, capacity: int, cuts: int = CUTS) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, up to ``cuts`` pieces
    of exactly a class's size, and the rest."""
    start = tokens // capacity * capacity
    pieces = [(s, capacity) for s in range(0, start, capacity)]
    for _ in range(cuts):
        left = tokens - start
        if not left:
            break
        size = capacity // -(-capacity // left)  # the largest class size that fits in
        if size == left:
            break
        pieces.append((start, size))
        start += size
    if tokens > start:
        pieces.append((start, tokens - start))
    return pieces


class HarmonicBins:
    """The open bins of a task, one for each class, and those that are full."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next = capacity, first_id
        self.open: dict[int, list] = {}

    def _closed(self, pieces: list) -> list:
        placed, offset = [], 0
        for piece in pieces:
            placed.append((*piece, self.next, offset))
            offset += piece[2]
        self.next += 1
        return placed

    def add(self, piece: tuple) -> list:
        """Take a piece (doc_id, start, length, ...); the bin it fills, if it does."""
        kind = self.capacity // piece[2]
        if kind == 1:
            return self._closed([piece])
        bin_ = self.open.setdefault(kind, [])
        bin_.append(piece)
        if len(bin_) < kind:
            return []
        del self.open[kind]
        return self._closed(bin_)

    def rest(self) -> Iterator[list]:
        """Bins of what lies in open ones: fewer than a class takes, so put together
        by length, each into the first bin that has room."""
        pieces = sorted((p for b in self.open.values() for p in b), key=lambda p: -p[2])
        bins: list[list] = []
        room: list[int] = []
        for piece in pieces:
            place = next((n for n, r in enumerate(room) if r >= piece[2]), None)
            if place is None:
                bins.append([])
                room.append(self.capacity)
                place = len(bins) - 1
            bins[place].append(piece)
            room[place] -= piece[2]
        self.open = {}
        for bin_ in bins:
            yield self._closed(bin_)


_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, text: str = "text",
    doc_id: str = "doc_id", cuts: int = CUTS, with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a row of ``docs``: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset; with ``with_ids`` also its ids (array of int).

    A document is its ids by the tokenizer file and id 1; null counts as an empty
    text, of which id 1 is left. Longer documents are cut at whole sequences; what is
    left is cut as ``cut`` says. Sequences are not padded here: the pieces of one lie
    from offset 0 without gaps, and fill ``capacity`` at most. A sequence is filled
    within a task and numbered by task and place, so the packing follows the
    partitions of ``docs``; a task run again gives the same for the same rows. Repeated
    rows are packed each; an empty table gives an empty answer; further columns of
    ``docs`` do not matter.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer_ids(path)
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 33)
        end = END_ID.to_bytes(4, "little")

        def table(rows: list) -> pa.RecordBatch:
            columns = [[r[i] for r in rows] for i in (0, 1, 2, 3, 4, -2, -1)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            if with_ids:
                names.append("ids")
                arrays.append(pa.array([np.frombuffer(r[5], dtype="<i4") for r in rows],
                                       pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        for doc_ids, texts in slices(batches):
            rows = []
            for number, ids in zip(doc_ids.to_pylist(), ids_of.encode(texts), strict=True):
                ids += end
                tokens = len(ids) // 4
                for start, length in cut(tokens, capacity, cuts):
                    own = ids[4 * start:4 * (start + length)]
                    piece = (number, start, length, zlib.crc32(own), tokens)
                    rows += bins.add((*piece, own) if with_ids else piece)
            if rows:
                yield table(rows)
        for rows in bins.rest():
            yield table(rows)

    schema = _PIECES + (", ids array<int>" if with_ids else "")
    return read_texts(docs, text, doc_id).mapInArrow(run, schema)
