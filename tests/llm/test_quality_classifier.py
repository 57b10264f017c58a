import zlib

import numpy as np
import pytest

from cardlake.llm.quality_classifier import calibrated, classify, evenly_cut

LABEL = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_held_out_accuracy(documents, labels):
    found = {r.doc_id: r for r in classify(documents, labels).collect()}
    assert len(found) == documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(found[r.doc_id].held_out for r in held)
    right = [found[r.doc_id].predicted == r.quality for r in held]
    bad = [found[r.doc_id].predicted == 0 for r in held if r.quality == 0]
    assert np.mean(right) > 0.9 and np.mean(bad) > 0.5


def test_line_is_a_probability():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 2))
    true = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))
    line = calibrated(x, (rng.random(4000) < true).astype(int))
    assert np.allclose(line, (2, -1, 0.5), atol=0.25)


def test_odd_rows(odd, none, labels, spark):
    rows = classify(odd, labels).collect()
    assert len(rows) == odd.count()
    empty = {r.score for r, d in zip(rows, odd.collect(), strict=True) if not d.text}
    assert len(empty) == 1 and 0 <= empty.pop() <= 1
    assert classify(none, labels).count() == 0
    nothing = spark.createDataFrame([], LABEL)
    assert {r.score for r in classify(odd, nothing).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (6, 1, 0), (None, 0, 0), (4, None, 0), (4, 7, 0)], LABEL)
    assert len({r.score for r in classify(odd, one).collect()}) == 1
    both = spark.createDataFrame([(2, 1, 0), (6, 0, 0), (4, 1, 0), (4, 1, 0), (8, 0, 0)], LABEL)
    assert classify(odd, both).count() == odd.count()


def test_a_very_long_labelled_text_pushes_no_other_out(make, spark):
    good = [(i, f"the river runs past the old mill and the fields number {i} " * 6) for i in range(80)]
    bad = [(100 + i, f"$$ buy now ## click {i} && win | free <b> " * 8) for i in range(80)]
    marks = [(i, int(i < 100), 0) for i, _ in good + bad]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    plain = {r.doc_id: r.score for r in classify(make(good + bad), labels).collect()}
    giant = [(1, "the river runs past the old mill and the fields " * 200_000), *good[2:]]
    found = {r.doc_id: r.score for r in classify(make(giant + bad), labels).collect()}
    assert min(found[i] for i, _ in giant) > max(found[i] for i, _ in bad)
    assert all(abs(found[i] - plain[i]) < 0.3 for i in found if i in plain)


def test_long_texts_are_cut_evenly(spark):
    text = "".join(chr(97 + n % 26) for n in range(100_000))
    rows = spark.createDataFrame([(text,), ("short",), (None,), ("é" * 8192,)], "t string")
    cut = [r[0] for r in rows.select(evenly_cut("t")).collect()]
    step = (100_000 - 2048) // 3
    assert cut == ["".join(text[n * step:n * step + 2048] for n in range(4)), "short", None, "é" * 8192]


def test_repeated_rows_of_one_id_are_one_example(make, spark):
    rows = [(7, "the same row again and again")] * 3000 + [(i, f"other text {i}") for i in range(20)]
    labels = spark.createDataFrame([(7, 1, 0)] + [(i, i % 2, 0) for i in range(20) if i != 7],
                                   "doc_id long, quality int, toxic int")
    found = classify(make(rows), labels).collect()
    assert len(found) == 3020 and all(0 <= r.score <= 1 for r in found)
