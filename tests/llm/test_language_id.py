import zlib

import numpy as np
import pytest

from cardlake.llm import language_id
from cardlake.llm.language_id import _groups, clustered


@pytest.fixture(scope="module")
def found(documents):
    return {r.doc_id: r for r in language_id.identify(documents).collect()}


def test_held_out_accuracy(documents, found):
    rows = documents.select("doc_id", "lang").collect()
    assert found.keys() == {r.doc_id for r in rows}
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and all(found[r.doc_id].held_out for r in held)
    assert sum(f.held_out for f in found.values()) == len(held)
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= f.score <= 1 for f in found.values())
    assert sum(f.rejected for f in found.values()) <= 0.01 * len(rows)


def test_groups_stay_within_words():
    one, some = _groups(["ab cd", "ab  CD!", "abcd", "", "12"], 12)
    assert (one[0] == one[1]).all() and not (one[0] == one[2]).all()
    assert some.tolist() == [True, True, True, False, False]
    # Of each word as many pairs as letters, the space before it included, and as many
    # triples, with what comes behind.
    assert one.sum(axis=1).tolist() == [8, 8, 8, 0, 0]


def test_clusters_are_unit_vectors_and_close():
    rng = np.random.default_rng(2)
    centres = np.eye(5, 40)
    rows = centres[rng.integers(0, 5, 300)] + 0.02 * rng.standard_normal((300, 40))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    made = clustered(rows.astype(np.float32), 5)
    assert np.allclose(np.linalg.norm(made, axis=1), 1, atol=1e-5)
    assert ((made @ centres.T).max(axis=0) > 0.95).all()


def test_mislabelled_rows_make_no_centroid():
    # Of "y" a tenth lies where "x" does; its third centroid has one row in a hundred.
    owners = ["x", "x", "y", "y", "y"]
    met = [("x", 0, 60), ("x", 1, 30), ("x", 3, 10), ("y", 2, 179), ("y", 3, 19), ("y", 4, 2)]
    assert language_id.supported(owners, met).tolist() == [True, True, True, False, False]
    assert language_id.supported(["x", "y"], [("x", 0, 5), ("y", 0, 5)]).tolist() == [True, True]


def test_bars_lie_between_own_and_other_languages():
    rows = [("x", 0.9, "y", 0.3)] * 99 + [("y", 0.8, "x", 0.2)] * 99 + [("x", 0.1, "y", 0.8)]
    bars = language_id.least_similarities(rows)
    assert abs(bars["x"] - (0.2 + 0.4 * 0.7)) < 1e-9 and abs(bars["y"] - (0.3 + 0.4 * 0.5)) < 1e-9
    assert abs(language_id.least_similarities([("x", 0.5, "x", -1.0)])["x"] - 0.2) < 1e-9


def _held_back(documents, language):
    """(rejected shares) of the rows of a language not learned, and of the others."""
    labelled = documents.filter("lang is not null and text is not null")
    model = language_id.train(language_id.training_rows(labelled.filter(f"lang != '{language}'")))
    found = {r.doc_id: r for r in language_id.predicted(
        documents.sparkSession, labelled.select("doc_id", "text"), model).collect()}
    langs = {r.doc_id: r.lang for r in labelled.select("doc_id", "lang").collect()}
    shares = [np.mean([found[i].rejected for i, k in langs.items() if (k == language) == is_held])
              for is_held in (True, False)]
    return shares


@pytest.mark.parametrize("language", ["en", "de", "fr", "es"])
def test_a_language_held_back_is_rejected(documents, language):
    held, others = _held_back(documents, language)
    assert held > 0.85 and others < 0.03


def test_prediction_against_numpy(documents, spark):
    """Counts, weights and nearest centroids in plain Python, for the model's own centroids."""
    model = language_id.train(language_id.training_rows(documents))
    rows = documents.select("doc_id", "text").limit(80).collect()
    found = {r.doc_id: r for r in language_id.predicted(
        spark, documents.select("doc_id", "text"), model).collect()}
    for row in rows:
        counts, some = _groups([row.text or ""], model.bits)
        weights = np.log1p(counts[0]) * model.idf
        cosines = model.centroids @ weights / max(np.linalg.norm(weights), 1e-12)
        best = int(cosines.argmax())
        assert found[row.doc_id].lang_pred == (model.languages[best] if some[0] else "und")
        assert abs(found[row.doc_id].score - max(0, cosines[best])) < 1e-4
        n = counts.sum()
        bar = model.least[best] * (n / (n + 100)) ** 0.5
        assert abs(cosines[best] - bar) < 1e-4 or found[row.doc_id].rejected == (
            not some[0] or bool(cosines[best] < bar))


def test_odd_rows(odd, none, make):
    rows = language_id.identify(odd).collect()
    by_text = list(zip([r.text for r in odd.collect()], rows, strict=True))
    for text, r in by_text:
        letters = any(c.isalpha() for c in text or "")
        assert r.lang_pred == ("en" if letters else "und")
        assert letters or (r.rejected and r.score == 0)
    assert language_id.identify(none).count() == 0
    unlabelled = make([(1, "some words"), (2, None)])
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_rejected_rows_go(make):
    docs = make([(i, f"some english words here {i} and there", "en", "s") for i in range(40)]
                + [(100, "ЖЖЖ ЮЮЮ ЩЩЩЩ", "en", "s"), (101, "12 34", "en", "s"), (102, None, "en", "s")])
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert {r.doc_id for r in kept.collect()} == set(range(40))
