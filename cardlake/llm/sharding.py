"""Contiguous shards of near-equal bytes, cut from global prefix sums of the sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import fresh, saved, shuffle_partitions, text_or_empty, with_row

# Rows that one task numbers, on average.
ROWS_EACH = 500_000


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, text: str = "text", doc_id: str = "doc_id",
    partitions: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The rows are put in order of id (nulls first, then by checksum, size and place in
    the table), dealt to range partitions, and given the bytes that come before them:
    the totals of the partitions before, and the rows before in their own. A row goes
    to the shard where its middle lies, so a shard is off its target by half a row at
    either end at most. Size is the UTF-8 bytes of the text plus 1; null counts as
    empty. ``slot`` counts from 0 in the order of the rows. An empty table gives an
    empty answer; with fewer rows than shards some shards stay empty. Further columns
    of ``docs`` do not matter.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    row = fresh(docs, "row")
    whole = F.encode(text_or_empty(text), "UTF-8")
    sized = saved(with_row(docs, row).select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(whole).cast("long") + 1).alias("size"),
        F.crc32(whole).alias("text_crc32"), F.col(row).alias("row")))
    spark = docs.sparkSession
    partitions = partitions or shuffle_partitions(spark, sized.count(), ROWS_EACH)
    order = ["doc_id", "text_crc32", "size", "row"]
    # The bounds of a range shuffle are sampled: kept, so that all readers see the same.
    dealt = saved(
        sized.repartitionByRange(partitions, *order)
        .withColumn("part", F.spark_partition_id()))
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole_table = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per partition, so small by the number of partitions.
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole_table).alias("all_bytes"))
    inside = Window.partitionBy("part").orderBy(*order)
    local = dealt.select(
        "*", F.row_number().over(inside).alias("n"),
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("up_to"))
    start = F.col("bytes_before") + F.col("up_to") - F.col("size")
    middle = 2 * start + F.col("size")
    placed = local.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32",
        F.expr(f"int({shards})").alias("shards"),
        (F.col("rows_before") + F.col("n") - 1).alias("rank"),
        middle.alias("middle"), "all_bytes",
    ).withColumn("shard", F.expr("int(middle * shards div (2 * all_bytes))"))
    # One row per shard.
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
