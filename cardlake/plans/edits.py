"""Edits to the stored customers that rewrite only the folders they touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.operators import updates
from cardlake.plans.etl import KEY_RANGE, KEYS_EACH, LAYOUT, key_range
from cardlake.sources import schemas, versions
from cardlake.sources.writers import write_table


def edit_customers(
    spark: SparkSession, root: str, changes: DataFrame, batch: str,
    updated_at: Column | None = None, title: bool = False, keys_each: int = KEYS_EACH,
    schema: str | None = None, keep: int = 2,
) -> dict[str, int]:
    """Normalise, check and apply a batch of edits to the customers stored below ``root``.

    Customers lie in folders by ranges of keys. Those with an accepted edit are read,
    edited and written anew, and become part of the table with all others as they are, in
    one switch. Refused edits go to ``root/quarantined/customer/batch=...`` with the reason;
    a batch that is run again replaces its own. ``keys_each`` is that of the load.
    Returns the number of accepted and refused edits, and of folders rewritten. A batch
    without an accepted edit publishes nothing.
    """
    stored = schema or f"{schemas.CUSTOMER}, {schemas.OTHER_FIELDS} MAP<STRING, STRING>"
    # No more rows than the batch has ranges: other folders are not even listed for reading.
    found = changes.select(key_range(F.col("SSN"), keys_each).alias("r")).distinct().collect()
    asked = {f"{KEY_RANGE}={r['r']}" for r in found if r["r"] is not None}
    stored = f"{stored}, {KEY_RANGE} BIGINT"
    customer = versions.read(spark, root, "customer", stored, only=asked)
    small = updates.small_batch(changes)
    checked = updates.validate_changes(
        updates.normalize_changes(changes, title), customer, small=small)
    aside = f"{root}/checked/customer/batch={batch}"
    write_table(checked, aside)  # once, for what is applied, refused and counted
    checked = spark.read.schema(checked.schema).parquet(aside)
    refused = updates.quarantined(checked)
    write_table(refused, f"{root}/quarantined/customer/batch={batch}")
    good = updates.accepted(checked).withColumn(KEY_RANGE, key_range(F.col("SSN"), keys_each))
    ranges = [r[0] for r in good.select(KEY_RANGE).distinct().collect()]
    if ranges:
        names = {f"{KEY_RANGE}={r}" for r in ranges}
        touched = versions.read(spark, root, "customer", stored, only=names)
        edited = updates.apply_updates(
            touched, good.drop(KEY_RANGE), updated_at, small=small)
        versions.publish(
            edited, root, "customer", "replace_partitions", [KEY_RANGE], **LAYOUT["customer"])
        versions.vacuum(spark, root, "customer", keep)
    return {"accepted": good.count(), "refused": refused.count(), "folders": len(ranges)}
