"""Global order of rows that are costly to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def in_order(rows: DataFrame, *order: str | Column) -> DataFrame:
    """``rows`` in global order, computed once.

    A global sort first samples its input to choose its ranges, so the scans and
    joins right below it would run twice. A shuffle in between keeps what is left
    after them, and evens it out.
    """
    return rows.hint("rebalance").orderBy(*order)
