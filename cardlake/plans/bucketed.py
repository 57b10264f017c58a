"""Transactions and customers laid out so that joining them shuffles neither.

Both are catalog tables in the same number of buckets by customer. A customer with more
transactions than a bucket holds on average would make one task of the join long; such
customers are at most as many as there are buckets, and their transactions are kept
apart, in a table without buckets that is joined with a broadcast of these few customers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.operators import model
from cardlake.operators.sizing import fit_broadcast
from cardlake.sources.writers import ensure_database, save_as_table

# Tables of the database.
SPREAD, HOT, CUSTOMER, HOT_CUSTOMER = (
    "credit_by_customer", "credit_of_hot_customers", "customer_by_key", "hot_customer")


def _name(database: str, table: str) -> str:
    return "`{}`.`{}`".format(database.replace("`", "``"), table)


def hot_customers(credit: DataFrame, buckets: int) -> DataFrame:
    """Customers with more transactions than a bucket holds on average: fewer than
    ``buckets`` of them."""
    average = credit.count() / buckets
    counts = credit.groupBy("CUST_SSN").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > average).select("CUST_SSN")


def store_bucketed(
    spark: SparkSession, credit: DataFrame, customer: DataFrame, database: str, buckets: int,
    location: str | None = None,
) -> None:
    """Write the four tables, for which the transactions are read four times."""
    ensure_database(spark, database, location)
    save_as_table(hot_customers(credit, buckets), _name(database, HOT_CUSTOMER))
    hot = F.broadcast(spark.table(_name(database, HOT_CUSTOMER)))
    spread = credit.join(hot, "CUST_SSN", "left_anti")
    _write(spread, _name(database, SPREAD), "CUST_SSN", buckets)
    _write(customer, _name(database, CUSTOMER), "SSN", buckets)
    save_as_table(credit.join(hot, "CUST_SSN", "left_semi"), _name(database, HOT))


def _write(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """One file per bucket: rows are brought together by bucket before they are written."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode(
        "overwrite").saveAsTable(name)


def _both(spark: SparkSession, database: str, join: Callable[[DataFrame, DataFrame, bool], DataFrame]):
    """``join`` of the spread transactions with all customers, which are in the same buckets,
    and of the hot customers' transactions with these."""
    customer = spark.table(_name(database, CUSTOMER))
    hot = spark.table(_name(database, HOT_CUSTOMER)).withColumnRenamed("CUST_SSN", "SSN")
    few = customer.join(F.broadcast(hot), "SSN", "left_semi")
    spread = join(spark.table(_name(database, SPREAD)), customer, False)
    return spread.unionByName(join(spark.table(_name(database, HOT)), few, True))


def join_customer(spark: SparkSession, database: str) -> DataFrame:
    """Transactions with their customer; those of unknown customers fall out."""
    return _both(spark, database, lambda credit, customer, small: model.join_customer(
        credit, customer, small=small))


def matched_totals(
    spark: SparkSession, database: str, branch: DataFrame, by: str, where: Column | None = None,
) -> DataFrame:
    """Count and exact total per value of ``by``, as :func:`cardlake.operators.model.matched_totals`."""
    small = fit_broadcast({"branch": branch})["branch"]

    def totals(credit: DataFrame, customer: DataFrame, few: bool) -> DataFrame:
        return model.matched_totals(
            credit, customer, branch, by, where, small={"customer": few, "branch": small})

    return _both(spark, database, totals).groupBy(by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
