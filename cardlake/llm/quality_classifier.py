"""Quality by compression: how much better a text's parts compress with a dictionary of
good texts than with one of bad texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.bpe_automaton import read_texts, slices
from cardlake.llm.common import id_remainder, in_sample

# Rows of each label, on average, that the dictionaries are made from, and rows that the
# scores are calibrated with.
SAMPLE_ROWS = 1500
CALIBRATION_ROWS = 4000
# Of a text to learn from that is longer than so many parts of so many characters, these.
PARTS, PART = 4, 2048
DICTIONARY_BYTES = 64 << 10
# A dictionary acts at the begin of what is compressed, so texts go in parts of this size.
PART_BYTES = 2048
LEVEL = 3
THRESHOLD = 0.3


def parts_of(text: str) -> list[bytes]:
    whole = text.encode()
    return [whole[i:i + PART_BYTES] for i in range(0, len(whole), PART_BYTES)]


class _Compressors:
    """One compressor per dictionary; not to be sent, made where used."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        self.both = []
        for content in dictionaries:
            data = zstandard.ZstdCompressionDict(content)
            data.precompute_compress(level=LEVEL)
            self.both.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False,
                write_dict_id=False))

    def measures(self, text: str) -> tuple[float, float]:
        """(bad - good) / (bad + good) of the compressed sizes, and the logarithm of
        the smaller one's share of the plain size; 0 and 0 for an empty text."""
        parts = parts_of(text)
        if not parts:
            return 0.0, 0.0
        good, bad = (sum(len(c.compress(p)) for p in parts) for c in self.both)
        return (bad - good) / (bad + good), log(min(good, bad) / sum(map(len, parts)))


@dataclass
class QualityModel:
    """Two dictionaries, and the logistic line that makes a difference a probability.

    The line's second term is how far a text compresses at all: of a text that only
    repeats itself, both dictionaries leave nearly nothing, and no difference.
    """

    good: bytes
    bad: bytes
    line: tuple[float, float, float]

    def probability(self, measures: np.ndarray) -> np.ndarray:
        *slopes, offset = self.line
        return 1 / (1 + np.exp(-np.clip(measures @ np.array(slopes) + offset, -30, 30)))


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few for that."""
    parts = [p for t in texts for p in parts_of(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


def calibrated(measures: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Slopes and offset of the logistic line, by Newton's method with a weak prior."""
    scale = np.where(measures.std(axis=0) > 0, measures.std(axis=0), 1.0)
    x = np.column_stack([measures / scale, np.ones(len(labels))])
    # Platt's targets: never quite 0 or 1.
    good = labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    line = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        slope = x.T @ (target - p) - 1e-3 * line
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3)
        step = np.linalg.solve(curve, slope)
        line = line + step
        if np.abs(step).max() < 1e-8:
            break
    return float(line[0] / scale[0]), float(line[1] / scale[1]), float(line[2])


def evenly_cut(text: str) -> Column:
    """A text of up to ``PARTS`` times ``PART`` characters, or so many evenly spaced parts."""
    length = F.length(text)
    step = F.floor((length - PART) / (PARTS - 1)).cast("int")
    parts = F.concat(*[F.substring(F.col(text), 1 + n * step, F.lit(PART)) for n in range(PARTS)])
    return F.when(length <= PARTS * PART, F.col(text)).otherwise(parts)


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
    quality: str = "quality",
) -> QualityModel:
    """A model of the labelled rows.

    The dictionaries come from about ``SAMPLE_ROWS`` rows of each label, taken by hash
    of the id; the line from about ``CALIBRATION_ROWS`` other rows in their natural
    mixture. Of a long text evenly spaced parts are learned from (scores are of whole
    texts); of several texts with one id the least. Rows with a null text or label are
    left out. Without texts of both labels all scores are the smoothed
    share of label 1 (0.5 where there is no label).
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).cast("int").alias("label"))
    known = known.filter("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    rows = sum(counts.values())
    share = (counts.get(1, 0) + 1) / (rows + 2)
    unskilled = QualityModel(b"", b"", (0.0, 0.0, float(np.log(share / (1 - share)))))
    if len(counts) < 2:
        return unskilled
    share = F.when(F.col("label") == 1, F.lit(min(0.5, SAMPLE_ROWS / counts[1]))).otherwise(
        F.lit(min(0.5, SAMPLE_ROWS / counts[0])))
    # What the dictionaries do not take, in the same shares of both labels.
    for_line = ~in_sample("doc_id", share) & in_sample("doc_id", CALIBRATION_ROWS / rows, salt=1)
    chosen = known.withColumn("made", in_sample("doc_id", share)).filter(F.col("made") | for_line)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # A broadcast of some ids and labels: their number is bounded by the sample's. With one
    # text for each, of bounded length, the sample is as well.
    sample = texts.filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    bounded = sample.groupBy("doc_id", "made", "label").agg(
        F.min(evenly_cut("text")).alias("text")).collect()
    made = {k: sorted(r["text"] for r in bounded if r["made"] and r["label"] == k) for k in (0, 1)}
    if not (made[0] and made[1]):
        return unskilled
    model = QualityModel(_dictionary(made[1]), _dictionary(made[0]), (0.0, 0.0, 0.0))
    compressors = _Compressors((model.good, model.bad))
    others = [r for r in bounded if not r["made"]] or bounded
    measures = np.array([compressors.measures(r["text"]) for r in others])
    marks = np.array([r["label"] for r in others])
    # The rows kept for the line hold each label at the share left over: weighed by
    # moving the offset to the share of all labelled rows.
    *slopes, offset = calibrated(measures, marks)
    seen = (marks.sum() + 1) / (len(marks) + 2)
    true = (counts[1] + 1) / (rows + 2)
    offset += float(np.log(true / (1 - true)) - np.log(seen / (1 - seen)))
    model.line = (*slopes, offset)
    return model


def scored(
    spark: SparkSession, docs: DataFrame, model: QualityModel, text: str = "text",
    doc_id: str = "doc_id", threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted (1 from ``threshold`` on)."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        compressors = _Compressors((model.good, model.bad)) if model.good else None
        for doc_ids, texts in slices(batches):
            measures = [compressors.measures(t) if compressors else (0.0, 0.0) for t in texts]
            score = model.probability(np.array(measures))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return read_texts(docs, text, doc_id).mapInArrow(
        run, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Learns from labelled rows whose remainder modulo 5 is not 0. Null counts as an
    empty text, whose score is that of a difference of 0. Several labels of one id
    count as the highest. Repeated rows are scored each; an empty table gives an empty
    answer; further columns do not matter.
    """
    model = train(docs, labels.filter(id_remainder("doc_id", 5) != 0))
    found = scored(docs.sparkSession, docs, model)
    held_out = (id_remainder("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "score", "predicted")
