"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed 2- and 3-letter groups, weighted by term and inverse
document frequency and of length 1. The vectors of each language are clustered by
cosine; a text gets the language of the centroid nearest to it, and is rejected where
even that one is too far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import fresh, id_remainder, in_sample, saved, text_or_empty

BITS = 12
CLUSTERS = 6
# Rows per language, on average, that the centroids are made from.
SAMPLE_ROWS = 400
# A centroid near which fewer of its language's rows lie is noise.
LEAST_SHARE = 0.03
# The least similarity of a language lies so far up from what texts of other languages have
# with it (their 99 % quantile) to what its own have (their 1 % quantile).
BAR = 0.4
# Short texts are less similar to everything: of n letter groups, by sqrt(n / (n + this)).
HALF_GROUPS = 100
UNKNOWN = "und"
# Up to so many languages with their shares are broadcast.
MAX_BROADCAST_LANGUAGES = 10_000

# Texts of about so many letters are made into vectors at once.
_LETTERS_EACH = 2_000_000
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def _groups(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts of each text's letter groups, whether it has a letter).

    Words are runs of letters, with a space before and behind; a group never holds
    parts of two words.
    """
    # An end behind each text; what a text itself has of that character is white space.
    joined = "".join([" " + t.lower().replace("\0", " ") + "\0" for t in texts])
    joined = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    ends = joined == 0
    letter = _letter_table()[joined]
    code = np.where(letter, joined, 0).astype(np.uint32)
    # Keep letters and one separator before each run of them.
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep |= ends
    owner = (np.cumsum(ends) - ends)[keep]
    code = code[keep]
    a, b = code[:-1], code[1:]
    mask = np.uint32(0xFFFFFFFF >> (32 - bits))
    shift = np.uint32(32 - bits)
    two = ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = ((two[:-1] + np.uint32(0x27D4EB2F)) ^ (code[2:] * np.uint32(0x165667B1)))
    three = three * np.uint32(0x9E3779B1)
    # A pair is of one word if its second place is a letter; a triple if the middle is
    # too. The last separator of a word is the first of the next.
    pair = b != 0
    triple = (code[1:-1] != 0)
    size = 1 << bits
    place = np.concatenate([
        owner[1:][pair] * size + ((two[pair] >> shift) & mask),
        owner[1:-1][triple] * size + ((three[triple] >> shift) & mask)])
    counts = np.bincount(place, minlength=len(texts) * size)
    counts = counts.reshape(len(texts), size)
    return counts.astype(np.float32), counts.any(axis=1)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(counts) * idf
    length = np.linalg.norm(weights, axis=1, keepdims=True)
    return weights / np.maximum(length, 1e-12)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows of a batch (text last), with about ``_LETTERS_EACH`` letters at a time."""
    texts = batch.column(batch.num_columns - 1)
    sizes = np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = int(np.searchsorted(sizes, before + _LETTERS_EACH))
        end = min(max(end, start + 1), start + 256, batch.num_rows)
        part = batch.slice(start, end - start)
        yield part, part.column(batch.num_columns - 1).to_pylist()
        start = end


@dataclass
class LanguageModel:
    """Inverse document frequencies, centroids, their languages, and least similarities."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray
    bits: int

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine of its nearest centroid, rejected) of each text."""
        counts, some = _groups(texts, self.bits)
        if not self.languages:
            none = np.zeros(len(texts))
            return [UNKNOWN] * len(texts), none, np.ones(len(texts), bool)
        near = _vectors(counts, self.idf) @ self.centroids.T
        best = near.argmax(axis=1)
        score = np.clip(near[np.arange(len(texts)), best], 0.0, 1.0) * some
        languages = [self.languages[i] if s else UNKNOWN for i, s in zip(best, some, strict=True)]
        bar = self.least[best] * _length_factor(counts.sum(axis=1))
        return languages, score.astype(float), ~some | (score < bar)


def _length_factor(groups: np.ndarray) -> np.ndarray:
    return np.sqrt(groups / (groups + HALF_GROUPS))


def clustered(vectors: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Centroids of length 1 by cosine; the first are the rows farthest from those before."""
    chosen = [int((vectors @ vectors.mean(axis=0)).argmax())]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(clusters, len(vectors)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        member = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, member, vectors)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 1e-9, sums / np.maximum(length, 1e-12), centroids)
    return centroids.astype(np.float32)


def train(
    labelled: DataFrame, bits: int = BITS, clusters: int = CLUSTERS,
    sample_rows: int = SAMPLE_ROWS, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
) -> LanguageModel:
    """A model of the rows with a language.

    Document frequencies count every row. The centroids and least similarities of a
    language come from about ``sample_rows`` of its rows, taken by hash of the id, of
    rows with the same id one. Each language is clustered in a task of its own; the
    driver gets the centroids, ``clusters`` per language, and some numbers per sampled
    row. Rows with a null language or text are left out; without any the model knows no
    language.
    """
    rows = labelled.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for _, texts in _parts(batch):
                counts, some = _groups(texts, bits)
                total += (counts > 0).sum(axis=0)
                docs += int(some.sum())
        used = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(total[used], docs))],
            ["place", "docs"])

    # At most one row per place of the vectors.
    found = rows.select("text").mapInArrow(frequencies, "place long, docs long").groupBy(
        "place").agg(F.sum("docs").alias("docs")).collect()
    seen = {r["place"]: r["docs"] for r in found}
    docs = seen.pop(-1, 0)
    frequency = np.zeros(1 << bits)
    frequency[list(seen)] = list(seen.values())
    idf = (np.log((1 + docs) / (1 + frequency)) + 1).astype(np.float32)

    counts = rows.groupBy("lang").agg(F.count("*").alias("of_lang"))
    shares = saved(counts.select("lang", (sample_rows / F.col("of_lang")).alias("share")))
    if shares.count() <= MAX_BROADCAST_LANGUAGES:  # else the texts would be shuffled by language
        shares = F.broadcast(shares)
    sample = rows.join(shares, "lang").filter(in_sample("doc_id", F.col("share"))).groupBy(
        "lang", "doc_id").agg(F.min("text").alias("text")).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch):
                found, some = _groups(texts, bits)
                rows_ = [v.tobytes() for v in _vectors(found, idf)[some].astype(np.float16)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).filter(pa.array(some)), pa.array(rows_, pa.binary()),
                    pa.array(_length_factor(found.sum(axis=1))[some].astype(float))],
                    ["lang", "vector", "factor"])

    kept = saved(sample.mapInArrow(vectors, "lang string, vector binary, factor double"))

    def clusters_of(table: pa.Table) -> pa.Table:
        rows_ = _stacked(sorted(table["vector"].to_pylist()))
        found = clustered(rows_, clusters)
        return pa.table({"lang": [table["lang"][0].as_py()] * len(found),
                         "centroid": pa.array([c.tobytes() for c in found], pa.binary())})

    made = sorted(kept.groupBy("lang").applyInArrow(
        clusters_of, "lang string, centroid binary").collect())
    owners = [r["lang"] for r in made]
    centroids = np.stack([np.frombuffer(r["centroid"], np.float32) for r in made]) if made else (
        np.zeros((0, 1 << bits), np.float32))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best = (_stacked(batch.column(1).to_pylist()) @ centroids.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best)], ["lang", "place"])

    met = kept.mapInArrow(nearest, "lang string, place long").groupBy("lang", "place").count()
    stays = supported(owners, [(r["lang"], r["place"], r["count"]) for r in met.collect()])
    centroids, owners = centroids[stays], [k for k, s in zip(owners, stays, strict=True) if s]

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(owners)
        for batch in batches:
            if not batch.num_rows:
                continue
            lang = np.array(batch.column(0).to_pylist())
            near = _stacked(batch.column(1).to_pylist()) @ centroids.T / (
                batch.column(2).to_numpy()[:, None])
            mine = names[None] == lang[:, None]
            own, others = np.where(mine, near, -1.0), np.where(mine, -1.0, near)
            other = others.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(own.max(axis=1)), pa.array(names[other].tolist()),
                pa.array(others.max(axis=1))], ["lang", "own", "other", "foreign"])

    measured = kept.mapInArrow(similar, "lang string, own double, other string, foreign double")
    # Four values per sampled row.
    least = least_similarities([tuple(r) for r in measured.collect()])
    return LanguageModel(idf, centroids, owners, np.array([least[k] for k in owners]), bits)


def _stacked(packed: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.float16) for v in packed]).astype(np.float32)


def supported(owners: list[str], met: list[tuple[str, int, int]]) -> np.ndarray:
    """Which centroids stay, of rows met (language, nearest centroid, how many rows).

    Some rows bear a wrong language, and together they make a cluster: a centroid
    stays only if of the rows nearest to it, each language counted by its share, most
    are of its own language, and if these are ``LEAST_SHARE`` of the language. A language
    keeps its most frequent centroid at least.
    """
    rows: dict[str, int] = {}
    for language, _, n in met:
        rows[language] = rows.get(language, 0) + n
    own, whole = np.zeros(len(owners)), np.zeros(len(owners))
    for language, place, n in met:
        whole[place] += n / rows[language]
        own[place] += n / rows[language] if owners[place] == language else 0
    stays = (own > 0.5 * whole) & (own >= LEAST_SHARE)
    for language in rows:
        members = np.array([i for i, k in enumerate(owners) if k == language])
        stays[members[own[members].argmax()]] = True
    return stays


def least_similarities(measured: list[tuple[str, float, str, float]]) -> dict[str, float]:
    """The bar of each language, from rows (language, similarity with its own centroids,
    the other language nearest, similarity with that), each as of a long text.

    Only rows that lie nearest to their own language tell what is usual: others may bear
    a wrong one.
    """
    right = [m for m in measured if m[1] >= m[3]]
    bars = {}
    for language in {m[0] for m in measured}:
        own = [m[1] for m in right if m[0] == language] or [
            m[1] for m in measured if m[0] == language]
        foreign = [m[3] for m in right if m[2] == language and m[0] != language]
        low = float(np.quantile(own, 0.01))
        high = max(0.0, float(np.quantile(foreign, 0.99))) if foreign else 0.0
        bars[language] = min(low, high + BAR * (low - high))
    return bars


def predicted(
    spark: SparkSession, docs: DataFrame, model: LanguageModel, text: str = "text",
    carried: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Rows of ``docs``, columns ``carried`` and lang_pred, score, rejected.

    ``lang_pred`` is one of the model's languages, or ``und`` for a null text or one
    without a letter, which is rejected with score 0. Ties go to the language first
    by name.
    """
    shared = spark.sparkContext.broadcast(model)
    whole = fresh(docs, "whole_text")
    read = docs.select(*[F.col(f"`{c}`") for c in carried], text_or_empty(text).alias(whole))
    new = {n: fresh(docs, n) for n in ("lang_pred", "score", "rejected")}
    schema = read.drop(whole)
    for (name, kind) in zip(new.values(), ("string", "double", "boolean"), strict=True):
        schema = schema.withColumn(name, F.lit(None).cast(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, texts in _parts(batch):
                languages, score, rejected = model.predict(texts)
                arrays = [part.column(i) for i in range(part.num_columns - 1)]
                arrays += [pa.array(languages, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(
                    arrays, [*part.schema.names[:-1], *new.values()])

    return read.mapInArrow(run, schema.schema)


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows a model may learn from: those whose remainder modulo 4 is not 2."""
    return docs.filter(id_remainder(doc_id, 4) != 2)


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected, by a
    model of its training rows. Repeated rows are judged each; an empty table gives an
    empty answer; further columns do not matter."""
    model = train(training_rows(docs))
    found = predicted(docs.sparkSession, docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"),
        "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``identify`` rejects, all columns as they are."""
    model = train(training_rows(docs))
    names = tuple(docs.columns)
    found = predicted(docs.sparkSession, docs, model, carried=names)
    rejected = found.columns[-1]
    return found.filter(~F.col(f"`{rejected}`")).select(*[F.col(f"`{c}`") for c in names])
