"""Totals and known values of the transactions, kept up to date month by month.

Each summary has a folder per month, of sums that can be added up over months. After a
load only the months whose folders changed are summed again, from the stored rows, and
replaced; months that are gone go. Questions over all time then read the summaries,
whose size follows cards and months and not the transactions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardlake.functions.dates import month_label
from cardlake.functions.text import mask_id
from cardlake.operators.reports import rounded
from cardlake.sources import schemas, versions

MONTH = "txn_month"
_SUMS = "n BIGINT, total DECIMAL(28,2)"
SCHEMAS = {
    "card_months": f"CUST_CC_NO STRING, {_SUMS}, {MONTH} STRING",
    "customer_months": f"CUST_SSN BIGINT, {_SUMS}, {MONTH} STRING",
    "known_values": f"field STRING, value STRING, n BIGINT, {MONTH} STRING",
}
# Fields of the transactions whose known values are kept.
FIELDS = ["TRANSACTION_TYPE", "CUST_CC_NO", "CUST_SSN", "BRANCH_CODE", "year"]


def _sums(credit: DataFrame, key: str) -> DataFrame:
    return credit.groupBy(key, MONTH).agg(
        F.count("TRANSACTION_VALUE").alias("n"),
        F.sum("TRANSACTION_VALUE").cast("decimal(28,2)").alias("total"))


def card_months(credit: DataFrame) -> DataFrame:
    return _sums(credit, "CUST_CC_NO")


def customer_months(credit: DataFrame) -> DataFrame:
    return _sums(credit, "CUST_SSN")


def known_values(credit: DataFrame) -> DataFrame:
    """How often each value of each field occurs in a month."""
    values = {name: F.col(name).cast("string") for name in FIELDS if name != "year"}
    values["year"] = F.substring("TIMEID", 1, 4)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("field"), values[name].alias("value")) for name in FIELDS]))
    return credit.select(MONTH, pairs.alias("pair")).groupBy(
        MONTH, F.col("pair.field").alias("field"), F.col("pair.value").alias("value")
    ).agg(F.count("*").alias("n"))


_MAKE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "card_months": card_months, "customer_months": customer_months, "known_values": known_values}


def _by_month(parts: list[str]) -> dict[str, set[str]]:
    """The folders of each month, by the month's partition folder."""
    months: dict[str, set[str]] = {}
    for part in parts:
        if "/" in part:
            months.setdefault(part.split("/", 1)[1], set()).add(part)
    return months


def _month(folder: str) -> str | None:
    value = folder.split("=", 1)[1]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def refresh(spark: SparkSession, root: str, before: list[str], keep: int = 2) -> list[str | None]:
    """Bring the summaries in line with the stored transactions; the months summed again.

    ``before``: the folders the transactions had when the summaries were in line. A
    month whose folders are the same is left alone. Where there are no summaries yet, or
    months are gone, all are made anew.
    """
    now = _by_month(versions.folders(spark, root, "credit") or [])
    old = _by_month(before)
    whole = bool(old.keys() - now.keys()) or not all(
        versions.versions(spark, root, name) for name in SCHEMAS)
    changed = sorted(month for month, parts in now.items() if whole or old.get(month) != parts)
    if not changed and not whole:
        return []
    months = [_month(folder) for folder in changed]
    credit = versions.read(spark, root, "credit", schemas.CREDIT)
    asked = F.col(MONTH).isin([m for m in months if m is not None])
    if None in months:
        asked = asked | F.col(MONTH).isNull()
    for name, make in _MAKE.items():
        fresh = make(credit if whole else credit.filter(asked)).select(_columns(name))
        versions.publish(
            fresh, root, name, "overwrite" if whole else "replace_partitions", [MONTH])
        versions.vacuum(spark, root, name, keep)
    return months


def _columns(name: str) -> list[str]:
    return StructType.fromDDL(SCHEMAS[name]).fieldNames()


def open_summary(spark: SparkSession, root: str, name: str) -> DataFrame:
    return versions.read(spark, root, name, SCHEMAS[name])


def monthly_bills(spark: SparkSession, root: str) -> DataFrame:
    """Bills of all cards and months, as :func:`cardlake.operators.reports.monthly_bills`."""
    return open_summary(spark, root, "card_months").select(
        "CUST_CC_NO", MONTH, F.col("n").alias("total_number"),
        rounded(F.col("total")).alias("total_bill"))


def customer_totals(spark: SparkSession, root: str) -> DataFrame:
    """Exact total per customer: columns ``CUST_SSN, total``."""
    return open_summary(spark, root, "customer_months").groupBy("CUST_SSN").agg(
        F.sum("total").alias("total"))


def top_customers(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    """The ``n`` customers with the largest totals, identifiers masked."""
    top = customer_totals(spark, root).orderBy(F.desc("total"), "CUST_SSN").limit(n)
    return top.select(
        mask_id(F.col("CUST_SSN")).alias("CUST_SSN"), rounded(F.col("total")).alias("total_amount"))


def month_counts(spark: SparkSession, root: str) -> DataFrame:
    """Number of transactions per month: columns ``month, total_number``."""
    return open_summary(spark, root, "customer_months").groupBy(F.col(MONTH).alias("month")).agg(
        F.sum("n").alias("total_number"))


def top_months(spark: SparkSession, root: str, n: int = 3) -> DataFrame:
    """The ``n`` months with most transactions, labelled ``MM/YYYY``."""
    top = month_counts(spark, root).orderBy(F.desc("total_number"), "month").limit(n)
    return top.select(month_label(F.col("month")).alias("month"), "total_number")


def domain(spark: SparkSession, root: str, field: str, kind: str = "string") -> DataFrame:
    """Known values of a field of the transactions (see ``FIELDS``), of the type ``kind``."""
    if field not in FIELDS:
        raise ValueError(f"the values of {field} are not kept")
    values = open_summary(spark, root, "known_values").filter(F.col("field") == field)
    return values.select(F.col("value").cast(kind).alias(field)).distinct()
