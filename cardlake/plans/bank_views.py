"""The test tables, seen as the bank's raw and warehouse tables.

lineitem with orders are the card transactions, customer with nation and region
the customers, supplier with nation the branches, labels with documents the loan
applications.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions.dates import date_to_timeid, month_key
from cardlake.plans.etl import clean_branch, clean_customer

# Date known for every transaction, for pruning by the reports.
DATE_COL = "txn_date"


# Declared, so that opening a table runs no job to look at a file.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def in_utc(c: Column) -> Column:
    """Timestamp that shows as UTC in a session of any time zone."""
    return F.to_utc_timestamp(c, F.current_timezone())


def _updated(key: str) -> Column:
    """Update time as ISO text with an offset of four hours."""
    local = in_utc(F.timestamp_seconds(F.lit(1630829730) + F.col(key)))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-04:00"))


def _card(key: str) -> Column:
    return (F.lit(4000000000000000) + F.col(key)).cast("string")


def raw_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth zip is missing, and phones alternate between 10 and 7 digits."""
    key = F.col("s_suppkey")
    phone = F.when(key % 2 == 0, 1234000000 + key * 37).otherwise(1237000 + key)
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        key.alias("BRANCH_CODE"),
        F.col("s_name").alias("BRANCH_NAME"),
        F.concat(F.col("n_name"), F.lit(" Street")).alias("BRANCH_STREET"),
        F.col("n_name").alias("BRANCH_CITY"),
        F.col("n_name").alias("BRANCH_STATE"),
        F.when(key % 10 != 0, key % 10 * 1000 + key).cast("string").alias("BRANCH_ZIP"),
        phone.cast("string").alias("BRANCH_PHONE"),
        _updated("s_suppkey").alias("LAST_UPDATED"),
    )


def raw_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth apartment is missing; zips have lost their leading zeros."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        key.alias("SSN"),
        F.concat(F.lower("c_mktsegment"), F.lit("-"), F.col("n_name")).alias("FIRST_NAME"),
        F.upper("r_name").alias("MIDDLE_NAME"),
        F.concat(F.lit("o'"), F.lower("c_name")).alias("LAST_NAME"),
        _card("c_custkey").alias("CREDIT_CARD_NO"),
        F.when(key % 50 != 0, key % 50).cast("string").alias("APT_NO"),
        F.concat(F.col("c_name"), F.lit(" Road")).alias("STREET_NAME"),
        F.col("n_name").alias("CUST_CITY"),
        F.col("n_name").alias("CUST_STATE"),
        F.col("r_name").alias("CUST_COUNTRY"),
        (key % 100).cast("string").alias("CUST_ZIP"),
        (1234000000 + key * 37).cast("string").alias("CUST_PHONE"),
        F.concat(F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@x.com"))
        .alias("CUST_EMAIL"),
        _updated("c_custkey").alias("LAST_UPDATED"),
    )


def _paid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def raw_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paid_lines(spark, sf_dir).select(
        _card("o_custkey").alias("CREDIT_CARD_NO"),
        F.year("l_shipdate").alias("YEAR"),
        F.month("l_shipdate").alias("MONTH"),
        F.dayofmonth("l_shipdate").alias("DAY"),
        F.col("o_custkey").alias("CUST_SSN"),
        F.col("l_suppkey").alias("BRANCH_CODE"),
        F.col("l_orderkey").alias("TRANSACTION_ID"),
        F.col("o_orderpriority").alias("TRANSACTION_TYPE"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("TRANSACTION_VALUE"),
    )


def loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id"
    ).select(
        F.col("doc_id").alias("Application_ID"),
        F.when(F.col("quality") == 1, "Y").otherwise("N").alias("Application_Status"),
        F.when(F.col("toxic") == 1, "Yes").otherwise("No").alias("Self_Employed"),
        F.when(F.col("lang") == "en", "Male").otherwise("Female").alias("Gender"),
        F.when(F.col("source") == "src0", "Yes").otherwise("No").alias("Married"),
    )


def branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_branch(raw_branch(spark, sf_dir))


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_customer(raw_customer(spark, sf_dir))


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned transactions. The date is the shipping date itself, so that ranges
    over it reach the scan."""
    return _paid_lines(spark, sf_dir).select(
        _card("o_custkey").alias("CUST_CC_NO"),
        date_to_timeid(F.col("l_shipdate")).alias("TIMEID"),
        F.to_date("l_shipdate").alias(DATE_COL),
        F.col("o_custkey").alias("CUST_SSN"),
        F.col("l_suppkey").alias("BRANCH_CODE"),
        F.col("l_orderkey").alias("TRANSACTION_ID"),
        F.col("o_orderpriority").alias("TRANSACTION_TYPE"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("TRANSACTION_VALUE"),
        month_key(date_to_timeid(F.col("l_shipdate"))).alias("txn_month"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with two edits per customer: one of a field in turn, good or bad by
    the key, and one of the city; and one edit each of a customer not there and of
    a field that is not editable."""
    key = F.col("c_custkey")
    text_value = F.when(key % 20 < 10, "mary-jane DE").otherwise("o'brien")
    turn = key % 10
    field = F.lit("CUST_COUNTRY")
    for at, name in enumerate([
        "FIRST_NAME", "LAST_NAME", "MIDDLE_NAME", "CUST_PHONE", "CUST_EMAIL",
        "FULL_STREET_ADDRESS", "CUST_CITY", "CUST_STATE", "CUST_ZIP",
    ]):
        field = F.when(turn == at, name).otherwise(field)
    good = key % 20 < 10
    text = key.cast("string")
    value = (
        F.when(turn == 3, F.when(good, (1234000000 + key).cast("string")).otherwise(text))
        .when(turn == 4, F.when(good, F.concat(F.lit("user."), text, F.lit("@x.com")))
              .otherwise("bad@x"))
        .when(turn == 5, F.when(good, F.concat(text, F.lit(" Main St., Apt 4")))
              .otherwise(F.concat(F.lit("#"), text)))
        .when(turn == 7, F.when(good, "ny").otherwise("n1"))
        .when(turn == 8, F.when(good, F.lpad((key % 100000).cast("string"), 5, "0"))
              .otherwise(F.concat(text, F.lit("x"))))
        .otherwise(text_value)
    )
    edits = F.array(
        F.struct(key.alias("SSN"), field.alias("field"), value.alias("new_value"),
                 F.lit(1).cast("bigint").alias("seq")),
        F.struct(key.alias("SSN"), F.lit("CUST_CITY").alias("field"),
                 F.concat(F.lit("new "), F.col("c_mktsegment")).alias("new_value"),
                 F.lit(2).cast("bigint").alias("seq")),
        F.struct((-1 - key).alias("SSN"), F.lit("CUST_CITY").alias("field"),
                 F.lit("Nowhere").alias("new_value"), F.lit(3).cast("bigint").alias("seq")),
        F.struct(key.alias("SSN"), F.lit("SHOE_SIZE").alias("field"),
                 F.lit("44").alias("new_value"), F.lit(4).cast("bigint").alias("seq")),
    )
    return table(spark, sf_dir, "customer").select(F.inline(edits))
