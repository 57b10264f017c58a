"""Shares of application statuses within a segment of applicants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions.text import label_status


def self_employed() -> Column:
    return F.col("Self_Employed") == "Yes"


def married_men() -> Column:
    return (F.col("Gender") == "Male") & (F.col("Married") == "Yes")


def status_percentages(
    loan: DataFrame, predicate: Column, status_col: str = "Application_Status"
) -> DataFrame:
    """Statuses of the applications in a segment, with counts and percentages.

    Percentages are of the whole segment, so applications without status lower
    the others and show 0 themselves.
    """
    groups = loan.filter(predicate).groupBy(status_col).agg(
        F.count(status_col).alias("total_number"), F.count(F.lit(1)).alias("_rows")
    )
    segment = groups.select(F.sum("_rows")).scalar()
    return groups.select(
        label_status(F.col(status_col)).alias(status_col),
        "total_number",
        F.round(F.col("total_number") / segment * 100, 2).alias("percentage"),
    )
