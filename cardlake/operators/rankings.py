"""Counts, totals, shares and top-n rankings.

Ranks follow the exact decimal sums, ties follow the key, and only the ranked
rows leave the cluster's partial results (``orderBy().limit()``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions.dates import month_key, month_label
from cardlake.functions.text import mask_id
from cardlake.operators.model import matched_totals
from cardlake.operators.reports import rounded
from cardlake.operators.sizing import MAX_BROADCAST_BYTES

# Fixed values.
HEALTHCARE = "Healthcare"


def type_counts(
    txn: DataFrame, type_col: str = "TRANSACTION_TYPE", value_col: str = "TRANSACTION_VALUE"
) -> DataFrame:
    """Number of transactions per type, most frequent first."""
    counts = txn.groupBy(type_col).agg(F.count(value_col).alias("total_number"))
    return counts.orderBy(F.desc("total_number"), type_col)


def state_customer_counts(customer: DataFrame, state_col: str = "CUST_STATE") -> DataFrame:
    """Number of customers per state, largest first; customers without state count 0."""
    counts = customer.groupBy(state_col).agg(F.count(state_col).alias("total_number"))
    return counts.orderBy(F.desc("total_number"), state_col)


def customer_totals(
    txn: DataFrame, ssn_col: str = "CUST_SSN", value_col: str = "TRANSACTION_VALUE"
) -> DataFrame:
    """Exact total per customer: columns ``ssn_col, total``."""
    return txn.groupBy(ssn_col).agg(F.sum(value_col).alias("total"))


def top_customers(
    txn: DataFrame, n: int = 10, ssn_col: str = "CUST_SSN", value_col: str = "TRANSACTION_VALUE"
) -> DataFrame:
    """The ``n`` customers with the largest totals, identifiers masked.

    Customers are told apart by the whole identifier; the mask comes last.
    """
    top = customer_totals(txn, ssn_col, value_col).orderBy(F.desc("total"), ssn_col).limit(n)
    return top.select(
        mask_id(F.col(ssn_col)).alias(ssn_col), rounded(F.col("total")).alias("total_amount")
    )


def with_share(df: DataFrame, value_col: str, name: str = "percentage", digits: int = 1):
    """Add the share of each row in the sum of ``value_col``, in percent.

    The sum is a scalar subquery: its partial sums are combined from all
    partitions, and the input is not gathered in one.
    """
    value = F.col(value_col).cast("double")
    whole = df.select(F.sum(value_col).cast("double")).scalar()
    return df.withColumn(name, F.round(F.try_divide(100 * value, whole), digits))


def top_customer_breakdown(
    txn: DataFrame, ssn_col: str = "CUST_SSN", type_col: str = "TRANSACTION_TYPE",
    value_col: str = "TRANSACTION_VALUE",
) -> DataFrame:
    """Totals and shares per type of the customer with the largest total.

    The best customer is found and used within one plan: its single row is
    broadcast to a second read of the transactions, which shuffles only the totals
    per type. Grouping by customer and type at once would read them a single time,
    but shuffle a total per customer and type of everyone.
    """
    best = (
        txn.groupBy(F.col(ssn_col).alias("_best")).agg(F.sum(value_col).alias("_whole"))
        .orderBy(F.desc("_whole"), "_best").limit(1)
    )
    rows = txn.join(F.broadcast(best), txn[ssn_col].eqNullSafe(best["_best"]))
    totals = rows.groupBy(type_col, "_whole").agg(F.sum(value_col).alias("total"))
    share = F.try_divide(100 * F.col("total").cast("double"), F.col("_whole").cast("double"))
    return totals.withColumn("_share", share).orderBy(F.desc("total"), type_col).select(
        type_col,
        rounded(F.col("total")).alias("total_amount"),
        F.round("_share", 1).alias("percentage"),
    )


def month_counts(
    txn: DataFrame, timeid_col: str = "TIMEID", value_col: str = "TRANSACTION_VALUE"
) -> DataFrame:
    """Number of transactions per month: columns ``month, total_number``."""
    return txn.groupBy(month_key(F.col(timeid_col)).alias("month")).agg(
        F.count(value_col).alias("total_number")
    )


def top_months(
    txn: DataFrame, n: int = 3, timeid_col: str = "TIMEID", value_col: str = "TRANSACTION_VALUE"
) -> DataFrame:
    """The ``n`` months with most transactions, labelled ``MM/YYYY``."""
    top = month_counts(txn, timeid_col, value_col).orderBy(F.desc("total_number"), "month")
    return top.limit(n).select(month_label(F.col("month")).alias("month"), "total_number")


def branch_totals_for_type(
    txn: DataFrame, customer: DataFrame, branch: DataFrame, transaction_type: str = HEALTHCARE,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Count and exact total per branch of the transactions of one type."""
    return matched_totals(
        txn, customer, branch, "BRANCH_CODE", F.col("TRANSACTION_TYPE") == transaction_type,
        max_broadcast_bytes=max_broadcast_bytes,
    )


def top_branches_for_type(
    txn: DataFrame, customer: DataFrame, branch: DataFrame, transaction_type: str = HEALTHCARE,
    n: int = 10, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The ``n`` branches with the largest totals for one type."""
    totals = branch_totals_for_type(txn, customer, branch, transaction_type, max_broadcast_bytes)
    return totals.orderBy(F.desc("total"), "BRANCH_CODE").limit(n).select(
        "BRANCH_CODE", rounded(F.col("total")).alias("total_amount")
    )
