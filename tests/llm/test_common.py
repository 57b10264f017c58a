import os
import random

import pytest

from cardlake.llm.common import forget, numbered, on_files, saved, without_rows
from cardlake.llm.exact_dedup import drop_duplicates, find_duplicates
from cardlake.llm.near_dedup import drop_near_duplicates, near_duplicates

PARALLELISM = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def files(spark, tmp_path):
    """Documents in several files of several row groups; every fifth text occurs twice."""
    words = [random.Random(n).choices("abcdefghijklmnopqrstuvwxyz", k=40) for n in range(2400)]
    rows = [(n, " ".join(words[n - n % 5 % 2])) for n in range(2400)]
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    docs.write.option("parquet.block.size", 16_000).parquet(path)
    return path


@pytest.fixture
def cores(spark):
    """Changes the number of cores that Spark counts on."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def set_(n):
        spark.conf.set(PARALLELISM, n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1 << 10)
    yield set_
    spark.conf.unset(PARALLELISM)
    spark.conf.unset("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_numbers_do_not_follow_the_cores(spark, files, cores):
    found = []
    for n in (2, 64):
        cores(n)
        docs = spark.read.parquet(files)
        found.append({r.doc_id: r.row for r in numbered(docs, "row").collect()})
        found.append(docs.rdd.getNumPartitions())
    assert found[0] == found[2] and len(set(found[0].values())) == 2400
    assert found[1] != found[3]


@pytest.mark.parametrize("find, drop", [
    (find_duplicates, drop_duplicates), (near_duplicates, drop_near_duplicates)])
def test_rows_numbered_with_some_cores_and_dropped_with_others(spark, files, cores, find, drop):
    cores(2)
    rows = saved(find(spark.read.parquet(files)))
    cores(64)
    docs = spark.read.parquet(files)
    left = {r.doc_id for r in without_rows(docs, rows.filter("not kept"), "row").collect()}
    expected = {r.doc_id for r in rows.filter("kept").collect()}
    assert left == expected and len(expected) < 2400
    assert {r.doc_id for r in drop(docs).collect()} == expected


def test_tables_in_memory_and_columns_named_like_metadata(spark):
    docs = spark.createDataFrame(
        [(1, "a", "x", 5), (2, "b", "y", 6)], "doc_id long, text string, _metadata string, row long")
    kept = on_files(docs)
    assert kept is not docs and on_files(kept) is kept
    assert on_files(kept.filter("doc_id = 1").select("doc_id", "text")) is not kept
    rows = numbered(kept, "number").collect()
    assert sorted((r.doc_id, r._metadata, r.row) for r in rows) == [(1, "x", 5), (2, "y", 6)]
    assert len({r.number for r in rows}) == 2
    assert numbered(on_files(docs.limit(0)), "number").count() == 0


def test_forgotten_tables_are_deleted(spark):
    kept = saved(spark.range(10))
    folder = kept._cardlake_folder
    assert os.path.isdir(folder)
    forget(kept, None, spark.range(3))
    forget(kept)
    assert not os.path.exists(os.path.dirname(folder))


def test_near_duplicates_leaves_few_files(spark, files):
    shared = spark.conf.get("spark.checkpoint.dir")
    before, settings = set(os.listdir(shared)), {
        "spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = near_duplicates(spark.read.parquet(files))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert found.filter("not kept").count() > 0
    new = set(os.listdir(shared)) - before
    written = sum(
        name.endswith(".parquet") for folder in new for _, _, names in os.walk(f"{shared}/{folder}")
        for name in names)
    assert len(new) <= 6 and written < 600
