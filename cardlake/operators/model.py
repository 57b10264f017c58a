"""Joins of transactions with customers and branches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.operators.sizing import MAX_BROADCAST_BYTES, broadcast_if_small, fit_broadcast


def join_customer(
    txn: DataFrame, customer: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Transactions with their customer; those of unknown customers fall out.

    ``small``, here and below, says whether the table may be broadcast, where the caller
    knows it (see ``fit_broadcast``); it is measured otherwise.
    """
    known = broadcast_if_small(customer, max_broadcast_bytes, small)
    return txn.join(known, txn["CUST_SSN"] == known["SSN"], "inner")


def join_branch(
    txn: DataFrame, branch: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Transactions with their branch; those of unknown branches fall out."""
    known = broadcast_if_small(branch, max_broadcast_bytes, small)
    return txn.withColumnRenamed("BRANCH_CODE", "CC_BRANCH_CODE").join(
        known, F.col("CC_BRANCH_CODE") == known["BRANCH_CODE"], "inner"
    )


def joined(
    txn: DataFrame, customer: DataFrame, branch: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES, small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """One row per transaction with customer and branch details, every column once.

    The key columns of the transaction side are dropped, and the two
    ``LAST_UPDATED`` columns get names of their own. ``small`` has the names
    ``customer`` and ``branch``; without it both are measured in one job.
    """
    if small is None:
        small = fit_broadcast({"customer": customer, "branch": branch}, max_broadcast_bytes)
    with_branch = join_branch(
        txn, branch.withColumnRenamed("LAST_UPDATED", "BRANCH_LAST_UPDATED"),
        max_broadcast_bytes, small["branch"],
    )
    both = join_customer(
        with_branch, customer.withColumnRenamed("LAST_UPDATED", "CUST_LAST_UPDATED"),
        max_broadcast_bytes, small["customer"],
    )
    return both.drop("CC_BRANCH_CODE", "CUST_CC_NO", "CUST_SSN")


def matched_totals(
    txn: DataFrame, customer: DataFrame, branch: DataFrame, by: str,
    where: Column | None = None, value_col: str = "TRANSACTION_VALUE",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES, customer_col: str = "CUST_SSN",
    branch_col: str = "BRANCH_CODE", customer_key: str = "SSN", branch_key: str = "BRANCH_CODE",
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """Count and exact total per value of ``by`` over transactions whose customer
    and branch are both known: columns ``by, n, total``.

    ``by`` is a column of the transactions or of the branches, and so are the
    columns of ``where``. Dimensions measured to be small are broadcast; ``small`` has
    them as ``customer`` and ``branch``. Customers too many for that are joined by one
    shuffle of the transactions as they are, in which adaptive execution splits a hot
    customer. Branches are few beside the transactions, so for a shuffle these are
    summed per branch and ``by`` first. The sums over the joined rows stay the same,
    also when a key occurs more than once in a dimension.
    """
    from_branch = by in branch.columns and by not in (branch_col, branch_key)
    if where is not None:
        if from_branch:
            branch = branch.filter(where)
        else:
            txn = txn.filter(where)
    known = {
        "customer": customer.select(F.col(customer_key).alias(customer_col)),
        "branch": branch.select(
            F.col(branch_key).alias(branch_col), *([by] if from_branch else [])),
    }
    if small is None:
        small = fit_broadcast(known, max_broadcast_bytes)
    fact_by = [] if from_branch or by in (customer_col, branch_col) else [by]
    rows = txn.select(
        customer_col, branch_col, *fact_by,
        F.when(F.col(value_col).isNotNull(), 1).otherwise(0).cast("bigint").alias("n"),
        F.col(value_col).alias("total"),
    )
    keys = {"customer": customer_col, "branch": branch_col}
    # Small ones first: they need no shuffle. Then the customers, then the branches.
    for name in sorted(known, key=lambda k: (not small[k], k == "branch")):
        side = known[name]
        if small[name]:
            side = F.broadcast(side)
        elif name == "branch":
            rows = _summed(rows, [c for c in rows.columns if c not in ("n", "total")])
        rows = rows.join(side, keys[name])
        if keys[name] != by:
            rows = rows.drop(keys[name])
    return _summed(rows, [by])


def _summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
