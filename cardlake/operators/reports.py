"""Answers about transactions and accounts, each a whole DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions.dates import between_dates, in_month
from cardlake.functions.text import ZIP_LENGTH
from cardlake.operators.model import join_customer, matched_totals
from cardlake.operators.ordering import in_order
from cardlake.operators.sizing import MAX_BROADCAST_BYTES, broadcast_if_small

# The columns each answer shows.
ZIP_MONTH_COLUMNS = [
    "CREDIT_CARD_NO", "TIMEID", "TRANSACTION_ID", "TRANSACTION_TYPE", "TRANSACTION_VALUE",
    "CUST_ZIP",
]
ACCOUNT_COLUMNS = [
    "CREDIT_CARD_NO", "FIRST_NAME", "LAST_NAME", "MIDDLE_NAME", "CUST_PHONE", "CUST_EMAIL",
    "FULL_STREET_ADDRESS", "CUST_CITY", "CUST_STATE", "CUST_ZIP",
]


def rounded(total: Column) -> Column:
    """Exact decimal total, rounded to cents, as double."""
    return F.round(total, 2).cast("double")


def transactions_by_zip_month(
    txn: DataFrame, customer: DataFrame, branch: DataFrame,
    zip_code: int | str, month: int | str, year: int | str,
    date_col: str | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    month_col: str | None = "txn_month",
) -> DataFrame:
    """Transactions in a month by customers living in a zip area, newest first.

    Month and zip cut both sides before they are joined. Stored zips are padded by
    the load, so the comparison is a plain one that reaches the scan.
    """
    wanted = str(zip_code).zfill(ZIP_LENGTH)
    living_there = customer.filter(F.col("CUST_ZIP") == wanted).select(
        "SSN", "CREDIT_CARD_NO", "CUST_ZIP"
    )
    rows = txn.filter(in_month(year, month, month_col, date_col)).select(
        "CUST_SSN", "BRANCH_CODE", "TIMEID", "TRANSACTION_ID", "TRANSACTION_TYPE",
        "TRANSACTION_VALUE",
    )
    rows = rows.join(
        broadcast_if_small(branch.select("BRANCH_CODE"), max_broadcast_bytes), "BRANCH_CODE"
    )
    rows = join_customer(rows, living_there, max_broadcast_bytes)
    return in_order(rows.select(*ZIP_MONTH_COLUMNS), F.desc("TIMEID"), "TRANSACTION_ID")


def _count_and_total(totals: DataFrame, by: str) -> DataFrame:
    return totals.orderBy(F.desc("total"), by).select(
        by, F.col("n").alias("total_number"), rounded(F.col("total")).alias("total_amount")
    )


def type_totals(
    txn: DataFrame, customer: DataFrame, branch: DataFrame, transaction_type: str | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Number and total value of transactions of one type, or of every type."""
    where = None
    if transaction_type is not None:
        where = F.col("TRANSACTION_TYPE") == transaction_type
    totals = matched_totals(
        txn, customer, branch, "TRANSACTION_TYPE", where, max_broadcast_bytes=max_broadcast_bytes
    )
    return _count_and_total(totals, "TRANSACTION_TYPE")


def branch_state_totals(
    txn: DataFrame, customer: DataFrame, branch: DataFrame, state: str | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Number and total value of transactions at the branches of one state, or of every state."""
    where = None if state is None else F.col("BRANCH_STATE") == state
    totals = matched_totals(
        txn, customer, branch, "BRANCH_STATE", where, max_broadcast_bytes=max_broadcast_bytes
    )
    return _count_and_total(totals, "BRANCH_STATE")


def account_details(customer: DataFrame, ssn: int | str) -> DataFrame:
    """Account details of one customer; the identifier itself is not shown."""
    return customer.filter(F.col("SSN") == int(ssn)).select(*ACCOUNT_COLUMNS)


def monthly_bill_lines(
    txn: DataFrame, card: int | str, month: int | str, year: int | str,
    date_col: str | None = None, month_col: str | None = "txn_month",
) -> DataFrame:
    """Transactions of one card in one month, oldest first.

    Here and below ``month_col`` is None for a table without that column.
    """
    rows = txn.filter(
        (F.col("CUST_CC_NO") == str(card)) & in_month(year, month, month_col, date_col)
    )
    return in_order(rows, "TIMEID", "TRANSACTION_ID")


def monthly_bill_total(
    txn: DataFrame, card: int | str, month: int | str, year: int | str,
    date_col: str | None = None, month_col: str | None = "txn_month",
) -> DataFrame:
    """Total of one bill, always one row; null when there are no transactions."""
    return txn.filter(
        (F.col("CUST_CC_NO") == str(card)) & in_month(year, month, month_col, date_col)
    ).agg(rounded(F.sum("TRANSACTION_VALUE")).alias("total_bill"))


def monthly_bills(
    txn: DataFrame, card_col: str = "CUST_CC_NO", month_col: str = "txn_month",
    value_col: str = "TRANSACTION_VALUE",
) -> DataFrame:
    """Bills of all cards and months, in one pass."""
    return txn.groupBy(card_col, month_col).agg(
        F.count(value_col).alias("total_number"),
        rounded(F.sum(value_col)).alias("total_bill"),
    )


def transactions_between_dates(
    txn: DataFrame, card: int | str, start: dt.date | str, end: dt.date | str,
    ascending: bool = True, date_col: str | None = None,
    month_col: str | None = "txn_month",
) -> DataFrame:
    """Transactions of one card from ``start`` to ``end``, both included."""
    day = F.col("TIMEID")
    rows = txn.filter(
        (F.col("CUST_CC_NO") == str(card)) & between_dates(start, end, month_col=month_col, date_col=date_col)
    )
    return in_order(rows, day.asc() if ascending else day.desc(), "TRANSACTION_ID")
