import glob
import os
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cardlake.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def test_one_query_for_each_operator():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(name, spark, sf_dir, oracle):
    found = QUERIES[name](spark, sf_dir)
    asked = oracle.execute(SQL[name])
    columns = [d[0] for d in asked.description]
    assert sorted(columns) == sorted(found.columns)
    rows = sorted(tuple(map(str, r)) for r in found.select(columns).collect())
    assert rows == sorted(tuple(map(str, r)) for r in asked.fetchall())


def test_pipeline_stage_by_stage(spark, sf_dir, documents):
    docs, ids = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == documents.dtypes
        before = {r.doc_id: r for r in docs.collect()}
        rows = out.collect()
        assert all(before[r.doc_id] == r for r in rows) and len(rows) == len({r.doc_id for r in rows})
        ids.append({r.doc_id for r in rows})
        docs = spark.createDataFrame(rows, documents.schema)
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False)) and len(ids[3]) < len(ids[0])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == ids[-1]
    assert all(len(r.ids) == r.length for r in packed)


def test_pipeline_run_agrees_with_its_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {"doc_id", "sequence_id", "offset", "ids"} <= set(rows[0].asDict())


def test_pipeline_on_an_empty_table(spark, documents, sf_dir):
    docs = spark.createDataFrame([], documents.schema)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0


def test_stages_on_odd_rows(spark, sf_dir, odd, documents):
    """Nulls, blanks, long texts, repeated rows and ids, and columns with clashing names."""
    def words(text):
        return tuple(re.findall(r"[^\x20\x09-\x0D]+", text or ""))

    rows = odd.collect()
    functions = dict(corpus_pipeline.STAGES)
    found = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf_dir)
        assert out.dtypes == odd.dtypes
        found[name] = out.collect()
        assert not Counter(found[name]) - Counter(rows)
    assert found["quality_rules"] == []  # short, or one word all along
    lettered = [r for r in rows if any(c.isalpha() for c in r.text or "")]
    assert {r.text for r in found["language_id"]} <= {r.text for r in lettered}
    assert any(r.doc_id == 6 for r in found["language_id"])

    def least(key):
        kept = {}
        for r in rows:
            old = kept.get(key(r))
            if old is None or (r.doc_id is None, r.doc_id or 0) < (old.doc_id is None, old.doc_id or 0):
                kept[key(r)] = r
        return sorted(str(r.doc_id) for r in kept.values())

    spaced = lambda r: re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
    assert sorted(str(r.doc_id) for r in found["exact_dedup"]) == least(spaced)
    assert sorted(str(r.doc_id) for r in found["near_dedup"]) == least(lambda r: words(r.text))
    packed = functions["packing"](spark, odd, sf_dir).collect()
    assert Counter(str(r.doc_id) for r in packed if r.start == 0) == Counter(str(r.doc_id) for r in rows)


def test_quality_stage_keeps_usual_texts_of_null_sources(spark, sf_dir, documents):
    usual = documents.filter("length(text) > 800").withColumn("source", F.lit(None).cast("string"))
    usual = usual.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.quality(spark, usual, sf_dir).count()
    assert 0.7 * usual.count() < kept < usual.count()
