"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept;
all but the last return the columns of ``documents``. Between stages the rows are
written as Parquet into the shared folder and read again, so a stage reads
files and a lost executor repeats one stage's tasks at most.

A null text counts as empty. Repeated rows are judged alike by the first two stages, and one of
them stays after the third. An empty table stays empty. Further columns of ``docs`` are kept
through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardlake.llm import exact_dedup, language_id, near_dedup, packing, quality_rules
from cardlake.llm.common import ship
from cardlake.llm.queries import tokenizer_path
from cardlake.plans.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents the quality rules reject: null, empty and short texts, and those
    far from what is usual in their language and source (null is a value of these)."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are in no language learned, or without a letter. A null
    language teaches nothing, but the text is judged."""
    ship(spark)
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the least id, a null one last; of rows with
    the same id the first in the table."""
    ship(spark)
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the least id, a null one last; texts
    without a word are one class."""
    ship(spark)
    return near_dedup.drop_near_duplicates(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, in sequences of 2048 tokens; an empty text is
    its end alone."""
    ship(spark)
    return packing.pack(docs, tokenizer_path(), capacity=2048, with_ids=True)


STAGES = [
    ("quality_rules", quality), ("language_id", language), ("exact_dedup", exact),
    ("near_dedup", near), ("packing", packed),
]
# Estimates, centroids and ids cannot be said in SQL: checked stage by stage in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark)
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
