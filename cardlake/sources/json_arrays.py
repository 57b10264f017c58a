"""One JSON array in one large file, cut between tasks.

A JSON text cannot be cut at any byte, as what a brace means depends on whether it stands
in a string, and so on all that comes before. But the state there is small: whether a
string is open, and how many braces and brackets are. So the file is read twice, in
pieces that end at closing braces. First each task tells how its part of the file changes
the state, whichever state it begins in; chained in the order of the parts, this
gives the state that each part begins in. Then each task cuts its part into records.
A record that lies across parts comes as fragments, which are put together by the part
that it begins in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARKS = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_STEP = {"{": 1, "[": 1, "}": -1, "]": -1}
_BLANK = ", \t\r\n"


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, part: begin of its part of the file, value, file_size) in the order of each
    file. Behind every value stands a closing brace, but for a file's last it may not."""
    read = spark.read.option("lineSep", "}").text(paths)
    return read.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("part"), "value",
        F.col("_metadata.file_size").alias("file_size"))


def _change(text: str, quoted: bool, depth: int, low: int) -> tuple[bool, int, int]:
    """The state behind a text, and the least depth so far."""
    for mark in _MARKS.finditer(text):
        found = mark[0]
        if found == '"':
            quoted = not quoted
        elif not quoted and found in _STEP:
            depth += _STEP[found]
            low = min(low, depth)
    return quoted, depth, low


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part: the state behind it, for either state of quotes before it, and the
    bytes of its values with a brace behind each."""
    found: dict[tuple[str, int], list] = {}
    for path, part, value, file_size in _rows(batches):
        row = found.setdefault((path, part), [(False, 0, 0), (True, 0, 0), 0, file_size])
        for n in (0, 1):
            row[n] = _change(value + "}", *row[n])
        row[2] += len(value.encode()) + 1
    columns = [[*key, *row[0], *row[1], *row[2:]] for key, row in found.items()]
    kinds = [pa.string(), pa.int64(), *[pa.bool_(), pa.int64(), pa.int64()] * 2, *[pa.int64()] * 2]
    names = ["path", "part", "plain", "plain_depth", "plain_low", "quoted", "quoted_depth",
             "quoted_low", "size", "file_size"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([c[i] for c in columns], kind) for i, kind in enumerate(kinds)], names)


def _begins(changes: list) -> dict[tuple[str, int], tuple[bool, int, int, bool]]:
    """(in a string, depth, part in which the open record begins, whether the last value
    has no brace behind it) of each part."""
    found, sizes, path = {}, {}, None
    ordered = sorted(changes, key=lambda r: (r["path"], r["part"]))
    last = {r["path"]: r["part"] for r in ordered}
    for row in ordered:
        sizes[row["path"]] = sizes.get(row["path"], 0) + row["size"]
    for row in ordered:
        if row["path"] != path:
            path, quoted, depth, first = row["path"], False, 0, row["part"]
        bare = last[path] == row["part"] and sizes[path] != row["file_size"]
        found[path, row["part"]] = (quoted, depth, first, bare)
        if depth + (row["quoted_low"] if quoted else row["plain_low"]) < 2:
            first = row["part"]  # what is open behind it begins in it
        depth += row["quoted_depth"] if quoted else row["plain_depth"]
        quoted = row["quoted"] if quoted else row["plain"]
    return found


class _Cutter:
    """Cuts what follows a state into records: what stands at depth 2 and more, with its
    braces, and what else there is between two of these but commas and white space."""

    def __init__(self, quoted: bool, depth: int):
        self.quoted, self.depth = quoted, depth
        self.text = ""  # of the record that is open
        self.begun = depth < 2  # whether it begins here

    def read(self, text: str) -> Iterator[tuple[str, bool]]:
        """(record, whether it begins here) of those that end in ``text``."""
        start = 0
        for mark in _MARKS.finditer(text):
            found = mark[0]
            if found == '"':
                self.quoted = not self.quoted
            elif not self.quoted and found in _STEP:
                step, at = _STEP[found], mark.start()
                if self.depth <= 1:  # an element begins, or the array begins or ends
                    yield from self._between(text[start:at])
                    start = at if step > 0 and self.depth == 1 else at + 1
                self.depth += step
                if self.depth == 1 and step < 0:
                    yield self.text + text[start:at + 1], self.begun
                    self.text, self.begun, start = "", True, at + 1
        self.text += text[start:]

    def _between(self, text: str) -> Iterator[tuple[str, bool]]:
        rest = (self.text + text).strip(_BLANK)
        self.text = ""
        if rest:
            yield rest, True

    def left(self) -> Iterator[tuple[str, bool]]:
        """What is open when a part ends."""
        if self.text and (self.depth >= 2 or self.text.strip(_BLANK)):
            yield self.text, self.begun


def _cut(begins: dict):
    """(path, part: in which it begins, place, value, whole) of records and fragments."""
    names = ["path", "part", "place", "value", "whole"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]

    def of_part(key, values: Iterator[str]) -> Iterator[tuple]:
        path, part = key
        quoted, depth, first, bare = begins[key]
        cutter, held = _Cutter(quoted, depth), None
        for value in chain(values, [None]):
            if held is not None:
                behind = "" if value is None and bare else "}"
                for text, here in cutter.read(held + behind):
                    yield path, part if here else first, part, text, here
            held = value
        for text, here in cutter.left():
            yield path, part if here else first, part, text, False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = groupby(_rows(batches), key=lambda r: (r[0], r[1]))
        found = chain.from_iterable(of_part(key, (r[2] for r in own)) for key, own in parts)
        while some := list(islice(found, 1000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in some], k) for i, k in enumerate(kinds)], names)

    return run


def array_elements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value): the elements of the JSON arrays in the files, as texts, in several tasks each.

    The driver holds a row for each part of a file that is a task's. What is left open at
    the end of a file is an element as well, so that a broken file shows. Tasks read the
    files by Spark's own reader, so any store that it reads will do.
    """
    pieces = _pieces(spark, paths)
    changes = pieces.mapInArrow(_changes, (
        "path string, part long, plain boolean, plain_depth long, plain_low long, quoted boolean, "
        "quoted_depth long, quoted_low long, size long, file_size long")).collect()
    found = pieces.mapInArrow(
        _cut(_begins(changes)), "path string, part long, place long, value string, whole boolean")
    # Two fragments for each part at most; those of a record by the part it begins in.
    stitched = found.filter("not whole").groupBy("path", "part").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), "").alias("value"))
    return found.filter("whole").select("value").union(stitched.select("value"))
