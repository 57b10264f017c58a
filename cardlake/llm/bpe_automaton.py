"""Byte-level BPE by an automaton compiled from the merges.

The automaton reads tokens: its states are the token read last, and an arc says which
token may come next in a correct encoding. It starts as one state with an arc for each
byte; each merge, in order, adds a gadget: behind the left part the arc of the right
part is cut, and the merged token's arc is laid beside the left part's arcs and leads
to a copy of the state behind the right part. For each string exactly one path from
the start spells it. A state is kept as what it was copied from, and when, with its own
cuts; so states share what they have in common.

To read bytes, a second table says which tokens end at a byte: a node is the longest end
of what was read that some token begins with. Of the tokens that end there exactly one
has an arc from the state before it, and that is the state now: each byte is read
once, and its state follows from the table and from states before. Decoding emits the
labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import text_or_empty

# Texts handled at a time in a task, and entries a cache may hold.
TEXTS_EACH = 256
CACHE_ENTRIES = 600_000

# Fixed value: the pattern words are split by before byte-level merging.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable ones for
    themselves, the others from code point 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(rest)}


class BpeAutomaton:
    """Encodes words and decodes ids with the vocabulary of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            file = json.load(file)
        model, letters = file["model"], byte_letters()
        spelled = {t: bytes(letters[c] for c in t) for t in model["vocab"]
                   if all(c in letters for c in t)}
        special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        size = max([*model["vocab"].values(), *special.values()]) + 1
        self.labels = [b""] * size
        for token, number in model["vocab"].items():
            self.labels[number] = spelled.get(token, token.encode())
        for token, number in special.items():
            self.labels[number] = token.encode()
        self.special = special
        ids = model["vocab"]
        self.ids = {spelled[c]: ids[c] for c in letters if c in ids}
        # A token's state: a copy of the state of ``source``, as it was before merge ``made``;
        # its arc: laid beside the arcs of ``left`` by that merge. Bytes have made -1.
        self.made, self.left, self.source = [-1] * size, [-1] * size, [-1] * size
        # The merge that cut the arc of a token from a state, by state and token.
        self.cuts: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            whole = ids[left + right]
            if self.made[whole] >= 0:
                raise ValueError(f"two merges make {left + right!r}")
            self._add_gadget(rank, ids[left], ids[right], whole)
            self.ids[spelled[left + right]] = whole
        self._compile_reader()
        self.arcs: dict[int, bool] = {}
        self.splitter = (
            regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len)[::-1])
                          + ")") if special else None)

    def _add_gadget(self, rank: int, left: int, right: int, whole: int) -> None:
        self.cuts[left << 32 | right] = rank
        self.made[whole], self.left[whole], self.source[whole] = rank, left, right

    def _compile_reader(self) -> None:
        """The table that reads bytes: a row of next nodes for each node, shared by nodes
        that no longer token goes on from, and the tokens that end at each node."""
        below: list[dict[int, int]] = [{}]
        token_at = [-1]
        for label, token in self.ids.items():
            node = 0
            for byte in label:
                if byte not in below[node]:
                    below[node][byte] = len(below)
                    below.append({})
                    token_at.append(-1)
                node = below[node][byte]
            token_at[node] = token
        row_of, shorter = [0] * len(below), [0] * len(below)
        ends: list[tuple[tuple[int, int], ...]] = [()] * len(below)
        rows = [np.zeros(256, np.int32)]
        for byte, child in below[0].items():
            rows[0][byte] = child
        queue = [(child, 1) for child in below[0].values()]
        for node, depth in queue:  # grows: shorter nodes come first
            shared = shorter[node]
            ends[node] = (((token_at[node], depth),) if token_at[node] >= 0 else ()) + ends[shared]
            if not below[node]:
                row_of[node] = row_of[shared]
                continue
            row = rows[row_of[shared]].copy()
            for byte, child in below[node].items():
                shorter[child] = int(row[byte])
                row[byte] = child
                queue.append((child, depth + 1))
            row_of[node] = len(rows)
            rows.append(row)
        self.next_node = memoryview(np.concatenate(rows)).cast("B").cast("i")
        self.row_of = [256 * row for row in row_of]
        self.ends = ends

    def _arc(self, last: int, token: int) -> bool:
        """Whether an arc ``token`` leaves the state behind ``last``, after all gadgets."""
        made, left, source, cuts = self.made, self.left, self.source, self.cuts
        built = len(cuts)
        while True:
            rank = cuts.get(last << 32 | token)
            if rank is not None and rank < built:
                return False  # its gadget cut this arc
            if made[last] < 0 and made[token] < 0:
                return True
            if made[token] >= made[last]:  # laid beside its left part's arc, after the cut
                built, token = made[token] + 1, left[token]
            else:  # a copy of another state, before the gadget
                built, last = made[last], source[last]

    def states(self, stream: Iterable[int]) -> Iterator[int]:
        """The state after each byte: the last token of the path that spells all so far."""
        next_node, row_of, ends, arcs = self.next_node, self.row_of, self.ends, self.arcs
        node, before = 0, []
        for byte in stream:
            node = next_node[row_of[node] + byte]
            place = len(before)
            for token, size in ends[node]:
                if size > place:  # from the start, where every arc leaves
                    state = token
                    break
                last = before[place - size]
                leads = arcs.get(last << 32 | token)
                if leads is None:
                    if len(arcs) > 4 * CACHE_ENTRIES:
                        arcs.clear()
                    leads = arcs[last << 32 | token] = self._arc(last, token)
                if leads:
                    state = token
                    break
            before.append(state)
            yield state

    def encode_word(self, word: bytes) -> list[int]:
        """The labels of the path that spells ``word``, read off from its last state."""
        states, labels = list(self.states(word)), self.labels
        path, place = [], len(word)
        while place:
            path.append(states[place - 1])
            place -= len(labels[path[-1]])
        path.reverse()
        return path

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


class Irregular(Exception):
    """A text whose white space is not single spaces before words."""


class Cache(dict):
    """What was met lately: when full, entries get old, and those not met again go."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.entries = entries
        self.old: dict = {}

    def keep(self, key, value):
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Pieces(Cache):
    """Ids (unsigned 32-bit, little-endian) of words, encoded when first met."""

    def __init__(self, automaton: BpeAutomaton, entries: int):
        super().__init__(entries)
        self.automaton = automaton

    def encode(self, word: str) -> bytes:
        ids = self.automaton.encode_word(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        return self.keep(word, self.encode(word) if ids is None else ids)


class _Units(Cache):
    """Ids of what stands between single spaces, with the space before it.

    A word boundary is always before a single space that a word follows, so a unit
    can be split into words on its own. Others are irregular.
    """

    def __init__(self, encode: Callable[[str, bool], bytes], entries: int):
        super().__init__(entries)
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        if not unit or unit[0].isspace():
            raise Irregular
        ids = self.old.get(unit)
        return self.keep(unit, self.encode(" " + unit, unit.isalpha()) if ids is None else ids)


class Encoder:
    """Whole texts to ids, by words and the automaton."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        self.automaton = BpeAutomaton(path)
        self.pieces = _Pieces(self.automaton, entries)
        self.units = _Units(self.by_words, entries)

    def by_words(self, text: str, one_word: bool = False) -> bytes:
        """``one_word``: a text of letters with at most one space, before them."""
        if one_word:
            return self.pieces.encode(text)
        return b"".join(map(self.pieces.__getitem__, WORDS.findall(text)))

    def plain(self, text: str) -> bytes:
        """Ids of a text in which strings of special tokens are ordinary text."""
        first, *others = text.split(" ")
        try:
            rest = b"".join(map(self.units.__getitem__, others))
        except Irregular:
            return self.by_words(text)
        return self.by_words(first) + rest

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as unsigned 32-bit little-endian integers."""
        splitter = self.automaton.splitter
        if splitter is None or not splitter.search(text):
            return self.plain(text)
        special = self.automaton.special
        return b"".join(
            special[part].to_bytes(4, "little") if part in special else self.plain(part)
            for part in splitter.split(text))


@lru_cache(maxsize=2)
def encoder(path: str, entries: int = CACHE_ENTRIES) -> Encoder:
    """One encoder per Python worker, its tables kept from task to task."""
    return Encoder(path, entries)


def coded(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), decoded (text).

    Null counts as an empty text, which has no ids and decodes to an empty text.
    Strings of special tokens in a text become their ids. Repeated rows are coded
    each; further columns of ``docs`` do not matter.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for doc_ids, texts in slices(batches):
            ids = [np.frombuffer(code.encode(t), dtype="<u4") for t in texts]
            yield pa.RecordBatch.from_arrays([
                doc_ids, pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                pa.array([code.automaton.decode(i.tolist()) for i in ids], pa.string()),
            ], ["doc_id", "ids", "decoded"])

    return read_texts(docs, text, doc_id).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def code_digests(
    docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """As ``coded``, with the ids and the decoded text as SHA-256 made in the task:
    doc_id, n_tokens, ids_sha256, decoded_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for doc_ids, texts in slices(batches):
            counts, of_ids, of_texts = [], [], []
            for whole in texts:
                ids = code.encode(whole)
                back = code.automaton.decode(np.frombuffer(ids, dtype="<u4").tolist())
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_texts.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([
                doc_ids, pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                pa.array(of_texts, pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return read_texts(docs, text, doc_id).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def read_texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Few texts at a time, so that only these are Python strings."""
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS_EACH):
            part = batch.slice(start, TEXTS_EACH)
            yield part.column(0), part.column(1).to_pylist()
