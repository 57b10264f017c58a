"""Batches of edits to customer details: normalise, validate, apply.

A batch has the columns ``SSN, field, new_value, seq``; ``seq`` orders the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import checks
from cardlake.functions.text import capitalize_first, format_phone, title_case
from cardlake.operators.lookups import distinct_for_join
from cardlake.operators.sizing import MAX_BROADCAST_BYTES, fits_broadcast

# The details that can be edited, with their check.
EDITABLE = {
    "FIRST_NAME": checks.valid_name,
    "LAST_NAME": checks.valid_name,
    "MIDDLE_NAME": checks.valid_name,
    "CUST_PHONE": checks.valid_phone,
    "CUST_EMAIL": checks.valid_email,
    "FULL_STREET_ADDRESS": checks.valid_street,
    "CUST_CITY": checks.valid_name,
    "CUST_STATE": checks.valid_state,
    "CUST_ZIP": checks.valid_zip,
    "CUST_COUNTRY": checks.valid_name,
}
CAPITALIZED = ["FIRST_NAME", "LAST_NAME", "CUST_CITY", "CUST_COUNTRY"]

UNKNOWN_FIELD = "unknown field"
UNKNOWN_SSN = "unknown SSN"
NO_VALUE = "no value"
BAD_VALUE = "bad value"


def normalize_changes(changes: DataFrame, title: bool = False) -> DataFrame:
    """Bring new values to the case their field is kept in.

    ``title`` capitalises every word, as the load does, not only the first.
    """
    field, value = F.col("field"), F.col("new_value")
    capitalize = title_case if title else capitalize_first
    return changes.withColumn(
        "new_value",
        F.when(field.isin(CAPITALIZED), capitalize(value))
        .when(field == "MIDDLE_NAME", F.lower(value))
        .when(field == "CUST_STATE", F.upper(value))
        .otherwise(value),
    )


def _value_is_valid() -> Column:
    field, value = F.col("field"), F.col("new_value")
    result = F.lit(False)
    for name, check in EDITABLE.items():
        result = F.when(field == name, check(value)).otherwise(result)
    return result


def small_batch(changes: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a raw batch may be broadcast, as its customers and as their new values.

    Counted once, before any checking, and given to ``validate_changes`` and
    ``apply_updates``: the customers asked for and the values accepted are no more than
    the batch has, each customer's as one row with a column for each detail.
    """
    wide = [F.lit(0).cast("bigint")] * len(EDITABLE)
    return fits_broadcast(changes.select("SSN", "new_value", *wide), max_broadcast_bytes)


def validate_changes(
    changes: DataFrame, customer: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Add ``reason``: null for a change that can be applied.

    Changes come normalised. An accepted phone number is formatted. ``small`` is the
    answer of ``small_batch``, asked here where it is not given.
    """
    asked = changes.select(F.col("SSN").alias("_ssn")).distinct()
    existing = customer.select(F.col("SSN").alias("_ssn"))
    if small_batch(changes, max_broadcast_bytes) if small is None else small:
        # A small batch goes to the customers, whose table then is not shuffled; the
        # customers found are no more than the asked ones, so they fit as well.
        found = existing.join(F.broadcast(asked), "_ssn", "left_semi")
        known = F.broadcast(found.distinct())
    else:
        known = distinct_for_join(existing, "_ssn", "_ssn")
    flagged = changes.join(known, F.col("SSN") == F.col("_ssn"), "left")
    reason = (
        F.when(~F.coalesce(F.col("field").isin(list(EDITABLE)), F.lit(False)), UNKNOWN_FIELD)
        .when(F.col("_ssn").isNull(), UNKNOWN_SSN)
        .when(F.col("new_value").isNull(), NO_VALUE)
        .when(~_value_is_valid(), BAD_VALUE)
    )
    phone = (F.col("field") == "CUST_PHONE") & F.col("reason").isNull()
    return (
        flagged.withColumn("reason", reason)
        .withColumn(
            "new_value",
            F.when(phone, format_phone(F.col("new_value"))).otherwise(F.col("new_value")),
        )
        .select("SSN", "field", "new_value", "seq", "reason")
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reason").isNull()).drop("reason")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reason").isNotNull())


def latest_values(changes: DataFrame) -> DataFrame:
    """One row per SSN with the last value for each field, null where there is none."""
    # The value settles edits with equal seq, so that reruns agree.
    edit = F.struct("seq", "new_value")
    return changes.groupBy("SSN").agg(
        *[
            F.max(F.when(F.col("field") == name, edit))["new_value"].alias(f"_{name}")
            for name in EDITABLE
        ]
    )


def apply_updates(
    customer: DataFrame, changes: DataFrame, updated_at: Column | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES, small: bool | None = None,
) -> DataFrame:
    """Customers with the accepted changes applied, the last one per field winning.

    Only changed customers get the new ``LAST_UPDATED``. ``small`` is the answer of
    ``small_batch`` for the raw batch: without it the accepted changes are run once
    more to measure them.
    """
    latest = latest_values(changes).withColumnRenamed("SSN", "_ssn")
    if small_batch(changes, max_broadcast_bytes) if small is None else small:
        latest = F.broadcast(latest)
    edited = customer.join(latest, customer["SSN"] == latest["_ssn"], "left")
    stamp = F.current_timestamp() if updated_at is None else updated_at
    values = {name: F.coalesce(F.col(f"_{name}"), F.col(name)) for name in EDITABLE}
    values["LAST_UPDATED"] = F.when(F.col("_ssn").isNotNull(), stamp).otherwise(
        F.col("LAST_UPDATED")
    )
    return edited.select(
        *[values[c].alias(c) if c in values else F.col(c) for c in customer.columns]
    )
