"""Registered queries over the test tables, each with its SQL for the check.

A query takes ``(spark, sf_dir)`` and returns a DataFrame. The SQL is written for
the base tables on its own, as one statement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import checks, dates, text
from cardlake.operators import loans, lookups, model, rankings, reports, updates
from cardlake.plans import bank_views as bank
from cardlake.plans import bucketed, summaries
from cardlake.plans.edits import edit_customers as edit_stored
from cardlake.plans.etl import LAYOUT, load_table, open_table, path_sink, read_raw
from cardlake.plans.session import scratch_folder
from cardlake.sources import schemas, versions, writers
from cardlake.sources.readers import read_table, split_corrupt

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Arguments of the questions about one type, state, card, zip and so on.
TYPE, STATE, ZIP, SSN = "1-URGENT", "NATION_2", 7, 7
CARD = 4000000000000000 + 1378
YEAR, MONTH = 1998, 4
BUSY_TYPE = "5-LOW"

_TXN = """txn AS (
  SELECT CAST(4000000000000000 + o_custkey AS VARCHAR) AS CUST_CC_NO,
    strftime(l_shipdate, '%Y%m%d') AS TIMEID, strftime(l_shipdate, '%Y%m') AS txn_month,
    o_custkey AS CUST_SSN, l_suppkey AS BRANCH_CODE, l_orderkey AS TRANSACTION_ID,
    o_orderpriority AS TRANSACTION_TYPE, CAST(l_extendedprice AS DECIMAL(18,2)) AS v
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_CUST = """cust AS (
  SELECT c_custkey AS SSN,
    CAST(4000000000000000 + c_custkey AS VARCHAR) AS CREDIT_CARD_NO,
    lpad(CAST(c_custkey % 100 AS VARCHAR), 5, '0') AS CUST_ZIP,
    upper(substr(c_mktsegment,1,1)) || lower(substr(c_mktsegment,2)) || '-Nation_'
      || substr(n_name, 8) AS FIRST_NAME,
    lower(r_name) AS MIDDLE_NAME,
    'O''' || upper(substr(c_name,1,1)) || lower(substr(c_name,2)) AS LAST_NAME,
    '(' || substr(CAST(1234000000 + c_custkey*37 AS VARCHAR),1,3) || ')'
      || substr(CAST(1234000000 + c_custkey*37 AS VARCHAR),4,3) || '-'
      || substr(CAST(1234000000 + c_custkey*37 AS VARCHAR),7,5) AS CUST_PHONE,
    replace(lower(c_name),'#','.') || '@x.com' AS CUST_EMAIL,
    c_name || ' Road, ' || CAST(nullif(c_custkey % 50, 0) AS VARCHAR) AS FULL_STREET_ADDRESS,
    n_name AS CUST_CITY, n_name AS CUST_STATE, r_name AS CUST_COUNTRY,
    strftime(TIMESTAMP '2021-09-05 12:15:30' + to_seconds(c_custkey), '%Y-%m-%d %H:%M:%S')
      AS LAST_UPDATED
  FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""
_BRANCH = """branch AS (
  SELECT s_suppkey AS BRANCH_CODE, s_name AS BRANCH_NAME, n_name || ' Street' AS BRANCH_STREET,
    n_name AS BRANCH_CITY, n_name AS BRANCH_STATE,
    CASE WHEN s_suppkey % 10 = 0 THEN '00000'
      WHEN s_suppkey % 10 * 1000 + s_suppkey >= 10000
        THEN CAST(s_suppkey % 10 * 1000 + s_suppkey AS VARCHAR)
      ELSE lpad(CAST(s_suppkey % 10 * 1000 + s_suppkey AS VARCHAR), 5, '0') END AS BRANCH_ZIP,
    CASE WHEN s_suppkey % 2 = 0 THEN CAST(1234000000 + s_suppkey*37 AS VARCHAR)
      ELSE CAST(1237000 + s_suppkey AS VARCHAR) END AS phone,
    strftime(TIMESTAMP '2021-09-05 12:15:30' + to_seconds(s_suppkey), '%Y-%m-%d %H:%M:%S')
      AS LAST_UPDATED
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
_LOAN = """loan AS (
  SELECT l.doc_id AS Application_ID,
    CASE WHEN quality = 1 THEN 'Y' ELSE 'N' END AS Application_Status,
    CASE WHEN toxic = 1 THEN 'Yes' ELSE 'No' END AS Self_Employed,
    CASE WHEN lang = 'en' THEN 'Male' ELSE 'Female' END AS Gender,
    CASE WHEN source = 'src0' THEN 'Yes' ELSE 'No' END AS Married
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
_JOINED = f"""{_TXN}, {_CUST}, {_BRANCH}, joined AS (
  SELECT t.*, c.SSN, c.CREDIT_CARD_NO, c.CUST_ZIP, c.CUST_STATE, b.BRANCH_STATE
  FROM txn t JOIN cust c ON t.CUST_SSN = c.SSN JOIN branch b ON t.BRANCH_CODE = b.BRANCH_CODE)"""
_BRANCH_PHONE = "'(' || substr(phone,1,3) || ')' || substr(phone,4,3) || '-' || substr(phone,7,5)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function
    return register


def expression(name: str, table: str, key: str, value: Callable[[], Column], sql: str) -> None:
    """Register a column expression over a whole table, as ``key, value``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bank.table(spark, sf_dir, table).select(F.col(key), value().alias("value"))

    QUERIES[name] = run
    SQL[name] = f"SELECT {key}, {sql} AS value FROM {table}"


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and timestamps (in UTC) as text, for comparison."""

    def shown(name: str, kind: str) -> Column:
        column = F.col(name)
        if kind.startswith("decimal"):
            return column.cast("double").alias(name)
        if kind == "timestamp":
            return bank.in_utc(column).cast("string").alias(name)
        return column.cast("string").alias(name) if kind == "date" else column

    return df.select(*[shown(c, t) for c, t in df.dtypes])


# --- Joined facts -------------------------------------------------------------


@query("joined", f"""WITH {_TXN}, {_CUST}, {_BRANCH}
SELECT c.*EXCLUDE (LAST_UPDATED), c.LAST_UPDATED AS CUST_LAST_UPDATED, TIMEID,
  substr(TIMEID,1,4) || '-' || substr(TIMEID,5,2) || '-' || substr(TIMEID,7,2) AS txn_date,
  txn_month, TRANSACTION_ID, TRANSACTION_TYPE, CAST(v AS DOUBLE) AS TRANSACTION_VALUE,
  b.BRANCH_CODE, BRANCH_NAME, BRANCH_STREET, BRANCH_CITY, BRANCH_STATE, BRANCH_ZIP,
  {_BRANCH_PHONE} AS BRANCH_PHONE, b.LAST_UPDATED AS BRANCH_LAST_UPDATED
FROM txn t JOIN cust c ON t.CUST_SSN = c.SSN JOIN branch b ON t.BRANCH_CODE = b.BRANCH_CODE""")
def joined(spark, sf_dir):
    """All columns of the three tables."""
    return _plain(model.joined(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir)
    ))


@query("join_customer", f"""WITH {_TXN}, {_CUST}
SELECT TRANSACTION_ID, BRANCH_CODE, TIMEID, CAST(v AS DOUBLE) AS TRANSACTION_VALUE, SSN, LAST_NAME
FROM txn JOIN cust ON CUST_SSN = SSN""")
def join_customer(spark, sf_dir):
    rows = model.join_customer(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir).select("SSN", "LAST_NAME")
    )
    return _plain(rows.select(
        "TRANSACTION_ID", "BRANCH_CODE", "TIMEID", "TRANSACTION_VALUE", "SSN", "LAST_NAME"
    ))


@query("join_branch", f"""WITH {_TXN}, {_BRANCH}
SELECT TRANSACTION_ID, CUST_SSN, TIMEID, CAST(v AS DOUBLE) AS TRANSACTION_VALUE,
  b.BRANCH_CODE, BRANCH_NAME, BRANCH_ZIP
FROM txn t JOIN branch b ON t.BRANCH_CODE = b.BRANCH_CODE""")
def join_branch(spark, sf_dir):
    rows = model.join_branch(
        bank.txn(spark, sf_dir),
        bank.branch(spark, sf_dir).select("BRANCH_CODE", "BRANCH_NAME", "BRANCH_ZIP"),
    )
    return _plain(rows.select(
        "TRANSACTION_ID", "CUST_SSN", "TIMEID", "TRANSACTION_VALUE", "BRANCH_CODE", "BRANCH_NAME",
        "BRANCH_ZIP",
    ))


# --- Reports ------------------------------------------------------------------


@query("transactions_by_zip_month", f"""WITH {_JOINED}
SELECT CREDIT_CARD_NO, TIMEID, TRANSACTION_ID, TRANSACTION_TYPE,
  CAST(v AS DOUBLE) AS TRANSACTION_VALUE, CUST_ZIP
FROM joined WHERE CUST_ZIP = '00007' AND TIMEID LIKE '199804%'
ORDER BY TIMEID DESC, TRANSACTION_ID""")
def transactions_by_zip_month(spark, sf_dir):
    return _plain(reports.transactions_by_zip_month(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir),
        ZIP, MONTH, YEAR, date_col=bank.DATE_COL,
    ))


def _totals_sql(by: str, where: str = "") -> str:
    return f"""WITH {_JOINED}
SELECT {by}, count(v) AS total_number, CAST(round(sum(v), 2) AS DOUBLE) AS total_amount
FROM joined {where} GROUP BY {by}"""


@query("type_totals", _totals_sql("TRANSACTION_TYPE"))
def type_totals(spark, sf_dir):
    return reports.type_totals(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir)
    )


@query("type_totals_one", _totals_sql("TRANSACTION_TYPE", f"WHERE TRANSACTION_TYPE = '{TYPE}'"))
def type_totals_one(spark, sf_dir):
    return reports.type_totals(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir), TYPE
    )


@query("type_totals_large_dimensions", _totals_sql("TRANSACTION_TYPE"))
def type_totals_large_dimensions(spark, sf_dir):
    """The plan used when customers and branches do not fit a broadcast."""
    return reports.type_totals(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir),
        max_broadcast_bytes=0,
    )


@query("branch_state_totals", _totals_sql("BRANCH_STATE"))
def branch_state_totals(spark, sf_dir):
    return reports.branch_state_totals(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir)
    )


@query("branch_state_totals_one", _totals_sql("BRANCH_STATE", f"WHERE BRANCH_STATE = '{STATE}'"))
def branch_state_totals_one(spark, sf_dir):
    return reports.branch_state_totals(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir), STATE
    )


@query("branch_state_totals_large_dimensions", _totals_sql("BRANCH_STATE"))
def branch_state_totals_large_dimensions(spark, sf_dir):
    return reports.branch_state_totals(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir),
        max_broadcast_bytes=0,
    )


@query("account_details", f"""WITH {_CUST}
SELECT CREDIT_CARD_NO, FIRST_NAME, LAST_NAME, MIDDLE_NAME, CUST_PHONE, CUST_EMAIL,
  FULL_STREET_ADDRESS, CUST_CITY, CUST_STATE, CUST_ZIP
FROM cust WHERE SSN = {SSN}""")
def account_details(spark, sf_dir):
    return reports.account_details(bank.customer(spark, sf_dir), SSN)


_TXN_COLUMNS = """CUST_CC_NO, TIMEID, CUST_SSN, BRANCH_CODE, TRANSACTION_ID, TRANSACTION_TYPE,
  CAST(v AS DOUBLE) AS TRANSACTION_VALUE, txn_month"""


def _txn_rows(rows: DataFrame) -> DataFrame:
    return _plain(rows.drop(bank.DATE_COL))


@query("monthly_bill_lines", f"""WITH {_TXN}
SELECT {_TXN_COLUMNS} FROM txn
WHERE CUST_CC_NO = '{CARD}' AND TIMEID LIKE '199804%' ORDER BY TIMEID, TRANSACTION_ID""")
def monthly_bill_lines(spark, sf_dir):
    return _txn_rows(reports.monthly_bill_lines(
        bank.txn(spark, sf_dir), CARD, MONTH, YEAR, date_col=bank.DATE_COL
    ))


@query("monthly_bill_total", f"""WITH {_TXN}
SELECT CAST(round(sum(v), 2) AS DOUBLE) AS total_bill FROM txn
WHERE CUST_CC_NO = '{CARD}' AND TIMEID LIKE '199804%'""")
def monthly_bill_total(spark, sf_dir):
    return reports.monthly_bill_total(
        bank.txn(spark, sf_dir), CARD, MONTH, YEAR, date_col=bank.DATE_COL
    )


def _no_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as a table without month and date columns."""
    return bank.txn(spark, sf_dir).drop("txn_month", bank.DATE_COL)


_BARE_COLUMNS = _TXN_COLUMNS.removesuffix(", txn_month")


@query("monthly_bill_lines_no_month", f"""WITH {_TXN}
SELECT {_BARE_COLUMNS} FROM txn
WHERE CUST_CC_NO = '{CARD}' AND TIMEID LIKE '199804%' ORDER BY TIMEID, TRANSACTION_ID""")
def monthly_bill_lines_no_month(spark, sf_dir):
    return _plain(reports.monthly_bill_lines(
        _no_month(spark, sf_dir), CARD, MONTH, YEAR, month_col=None
    ))


@query("monthly_bill_total_no_month", f"""WITH {_TXN}
SELECT CAST(round(sum(v), 2) AS DOUBLE) AS total_bill FROM txn
WHERE CUST_CC_NO = '{CARD}' AND TIMEID LIKE '199804%'""")
def monthly_bill_total_no_month(spark, sf_dir):
    return reports.monthly_bill_total(
        _no_month(spark, sf_dir), CARD, MONTH, YEAR, month_col=None
    )


@query("transactions_between_dates_no_month", f"""WITH {_TXN}
SELECT {_BARE_COLUMNS} FROM txn
WHERE CUST_CC_NO = '{CARD}' AND TIMEID >= '19970201' AND TIMEID <= '19981231'
ORDER BY TIMEID, TRANSACTION_ID""")
def transactions_between_dates_no_month(spark, sf_dir):
    return _plain(reports.transactions_between_dates(
        _no_month(spark, sf_dir), CARD, "2/1/1997", "1998-12-31", month_col=None
    ))


@query("transactions_by_zip_month_no_month", f"""WITH {_JOINED}
SELECT CREDIT_CARD_NO, TIMEID, TRANSACTION_ID, TRANSACTION_TYPE,
  CAST(v AS DOUBLE) AS TRANSACTION_VALUE, CUST_ZIP
FROM joined WHERE CUST_ZIP = '00007' AND TIMEID LIKE '199804%'
ORDER BY TIMEID DESC, TRANSACTION_ID""")
def transactions_by_zip_month_no_month(spark, sf_dir):
    return _plain(reports.transactions_by_zip_month(
        _no_month(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir),
        ZIP, MONTH, YEAR, month_col=None,
    ))


@query("monthly_bills", f"""WITH {_TXN}
SELECT CUST_CC_NO, txn_month, count(v) AS total_number,
  CAST(round(sum(v), 2) AS DOUBLE) AS total_bill
FROM txn GROUP BY CUST_CC_NO, txn_month""")
def monthly_bills(spark, sf_dir):
    return reports.monthly_bills(bank.txn(spark, sf_dir))


@query("transactions_between_dates", f"""WITH {_TXN}
SELECT {_TXN_COLUMNS} FROM txn
WHERE CUST_CC_NO = '{CARD}' AND TIMEID >= '19970201' AND TIMEID <= '19981231'
ORDER BY TIMEID, TRANSACTION_ID""")
def transactions_between_dates(spark, sf_dir):
    return _txn_rows(reports.transactions_between_dates(
        bank.txn(spark, sf_dir), CARD, "2/1/1997", "1998-12-31", date_col=bank.DATE_COL
    ))


# --- Rankings and shares ------------------------------------------------------


@query("type_counts", f"""WITH {_TXN}
SELECT TRANSACTION_TYPE, count(v) AS total_number FROM txn GROUP BY TRANSACTION_TYPE""")
def type_counts(spark, sf_dir):
    return rankings.type_counts(bank.txn(spark, sf_dir))


@query("state_customer_counts", f"""WITH {_CUST}
SELECT CUST_STATE, count(CUST_STATE) AS total_number FROM cust GROUP BY CUST_STATE""")
def state_customer_counts(spark, sf_dir):
    return rankings.state_customer_counts(bank.customer(spark, sf_dir))


@query("customer_totals", f"""WITH {_TXN}
SELECT CUST_SSN, CAST(sum(v) AS DOUBLE) AS total FROM txn GROUP BY CUST_SSN""")
def customer_totals(spark, sf_dir):
    return _plain(rankings.customer_totals(bank.txn(spark, sf_dir)))


@query("top_customers", f"""WITH {_TXN}
SELECT 'XXX-XX-' || right(lpad(CAST(CUST_SSN AS VARCHAR), 9, '0'), 4) AS CUST_SSN,
  CAST(round(sum(v), 2) AS DOUBLE) AS total_amount
FROM txn GROUP BY txn.CUST_SSN ORDER BY sum(v) DESC, txn.CUST_SSN LIMIT 10""")
def top_customers(spark, sf_dir):
    return rankings.top_customers(bank.txn(spark, sf_dir))


@query("top_customer_breakdown", f"""WITH {_TXN}, best AS (
  SELECT CUST_SSN AS s FROM txn GROUP BY CUST_SSN ORDER BY sum(v) DESC, CUST_SSN LIMIT 1)
SELECT TRANSACTION_TYPE, CAST(round(sum(v), 2) AS DOUBLE) AS total_amount,
  round(100 * CAST(sum(v) AS DOUBLE) / CAST(sum(sum(v)) OVER () AS DOUBLE), 1) AS percentage
FROM txn JOIN best ON CUST_SSN = s GROUP BY TRANSACTION_TYPE""")
def top_customer_breakdown(spark, sf_dir):
    return rankings.top_customer_breakdown(bank.txn(spark, sf_dir))


@query("type_shares", f"""WITH {_TXN}
SELECT TRANSACTION_TYPE, count(v) AS total_number,
  round(100 * CAST(count(v) AS DOUBLE) / CAST(sum(count(v)) OVER () AS DOUBLE), 1) AS percentage
FROM txn GROUP BY TRANSACTION_TYPE""")
def type_shares(spark, sf_dir):
    return rankings.with_share(rankings.type_counts(bank.txn(spark, sf_dir)), "total_number")


@query("month_counts", f"""WITH {_TXN}
SELECT txn_month AS month, count(v) AS total_number FROM txn GROUP BY txn_month""")
def month_counts(spark, sf_dir):
    return rankings.month_counts(bank.txn(spark, sf_dir))


@query("top_months", f"""WITH {_TXN}
SELECT substr(txn_month, 5, 2) || '/' || substr(txn_month, 1, 4) AS month,
  count(v) AS total_number
FROM txn GROUP BY txn_month ORDER BY count(v) DESC, txn_month LIMIT 3""")
def top_months(spark, sf_dir):
    return rankings.top_months(bank.txn(spark, sf_dir))


@query("branch_totals_for_type", f"""WITH {_JOINED}
SELECT BRANCH_CODE, count(v) AS n, CAST(sum(v) AS DOUBLE) AS total
FROM joined WHERE TRANSACTION_TYPE = '{BUSY_TYPE}' GROUP BY BRANCH_CODE""")
def branch_totals_for_type(spark, sf_dir):
    return _plain(rankings.branch_totals_for_type(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir),
        BUSY_TYPE,
    ))


_TOP_BRANCHES = f"""WITH {_JOINED}
SELECT BRANCH_CODE, CAST(round(sum(v), 2) AS DOUBLE) AS total_amount
FROM joined WHERE TRANSACTION_TYPE = '{BUSY_TYPE}'
GROUP BY BRANCH_CODE ORDER BY sum(v) DESC, BRANCH_CODE LIMIT 10"""


@query("top_branches_for_type", _TOP_BRANCHES)
def top_branches_for_type(spark, sf_dir):
    return rankings.top_branches_for_type(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir),
        BUSY_TYPE,
    )


@query("top_branches_for_type_large_dimensions", _TOP_BRANCHES)
def top_branches_for_type_large_dimensions(spark, sf_dir):
    return rankings.top_branches_for_type(
        bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), bank.branch(spark, sf_dir),
        BUSY_TYPE, max_broadcast_bytes=0,
    )


# --- Loans --------------------------------------------------------------------


def _loan_sql(where: str) -> str:
    return f"""WITH {_LOAN}
SELECT CASE Application_Status WHEN 'Y' THEN 'Approved' WHEN 'N' THEN 'Not Approved' END
    AS Application_Status,
  count(*) AS total_number,
  round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 2) AS percentage
FROM loan WHERE {where} GROUP BY loan.Application_Status"""


@query("status_percentages_self_employed", _loan_sql("Self_Employed = 'Yes'"))
def status_percentages_self_employed(spark, sf_dir):
    return loans.status_percentages(bank.loan(spark, sf_dir), loans.self_employed())


@query("status_percentages_married_men", _loan_sql("Gender = 'Male' AND Married = 'Yes'"))
def status_percentages_married_men(spark, sf_dir):
    return loans.status_percentages(bank.loan(spark, sf_dir), loans.married_men())


# --- Domains and membership ---------------------------------------------------


@query("domain_zip", f"WITH {_CUST} SELECT DISTINCT CUST_ZIP AS zip FROM cust")
def domain_zip(spark, sf_dir):
    return lookups.domain(
        bank.raw_customer(spark, sf_dir), text.padded_zip(F.col("CUST_ZIP")), "zip"
    )


@query("domain_year", f"WITH {_TXN} SELECT DISTINCT substr(TIMEID, 1, 4) AS year FROM txn")
def domain_year(spark, sf_dir):
    return lookups.domain(bank.txn(spark, sf_dir), dates.year_key(F.col("TIMEID")), "year")


@query("domain_card", f"WITH {_CUST} SELECT DISTINCT CREDIT_CARD_NO FROM cust")
def domain_card(spark, sf_dir):
    return lookups.domain(bank.customer(spark, sf_dir), "CREDIT_CARD_NO")


@query("domain_type", f"WITH {_TXN} SELECT DISTINCT TRANSACTION_TYPE FROM txn")
def domain_type(spark, sf_dir):
    return lookups.domain(bank.txn(spark, sf_dir), "TRANSACTION_TYPE")


@query("domain_state", f"WITH {_BRANCH} SELECT DISTINCT BRANCH_STATE FROM branch")
def domain_state(spark, sf_dir):
    return lookups.domain(bank.branch(spark, sf_dir), "BRANCH_STATE")


@query("domain_ssn", f"WITH {_CUST} SELECT DISTINCT SSN FROM cust")
def domain_ssn(spark, sf_dir):
    return lookups.domain(bank.customer(spark, sf_dir), "SSN")


def _membership(operator, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by whether their customer is one with a positive balance."""
    known = bank.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    requests = bank.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("nullif(o_custkey, o_orderkey % 100)").alias("o_custkey")
    )
    return operator(requests, "o_custkey", known, "c_custkey")


_REQUESTS = """WITH asked AS (
  SELECT o_orderkey, nullif(o_custkey, o_orderkey % 100) AS o_custkey FROM orders)
SELECT o_orderkey, o_custkey FROM asked
"""


@query("known_keys", _REQUESTS + """
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def known_keys(spark, sf_dir):
    return _membership(lookups.known_keys, spark, sf_dir)


@query("unknown_keys", _REQUESTS + """
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal > 0 AND c_custkey = o_custkey)""")
def unknown_keys(spark, sf_dir):
    return _membership(lookups.unknown_keys, spark, sf_dir)


@query("in_month", f"WITH {_TXN} SELECT {_TXN_COLUMNS} FROM txn WHERE TIMEID LIKE '199804%'")
def in_month(spark, sf_dir):
    return _txn_rows(bank.txn(spark, sf_dir).filter(
        dates.in_month(YEAR, MONTH, date_col=bank.DATE_COL)
    ))


@query("between_dates", f"""WITH {_TXN} SELECT {_TXN_COLUMNS} FROM txn
WHERE TIMEID >= '19980215' AND TIMEID <= '19990105'""")
def between_dates(spark, sf_dir):
    return _txn_rows(bank.txn(spark, sf_dir).filter(
        dates.between_dates("1998/2/15", "01-05-1999", date_col=bank.DATE_COL)
    ))


# --- Column expressions -------------------------------------------------------

_WORDS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def _title_sql(column: str) -> str:
    # "ß" has no upper case of its own; as the start of a word it becomes "Ss"
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({column}), '{_WORDS}'), "
        "lambda x: CASE WHEN x[1] = 'ß' THEN 'Ss' ELSE upper(x[1]) END || x[2:]), '')"
    )


expression(
    "title_case", "documents", "doc_id", lambda: text.title_case(F.col("text")),
    _title_sql("text"),
)
expression(
    "title_case_types", "orders", "o_orderkey", lambda: text.title_case(F.col("o_orderpriority")),
    _title_sql("o_orderpriority"),
)
expression(
    "capitalize_first", "documents", "doc_id", lambda: text.capitalize_first(F.col("text")),
    "upper(substr(text, 1, 1)) || lower(substr(text, 2))",
)
expression("lower_case", "documents", "doc_id", lambda: F.lower("text"), "lower(text)")
expression("upper_case", "customer", "c_custkey", lambda: F.upper("c_name"), "upper(c_name)")


def _phone() -> Column:
    key = F.col("c_custkey")
    return F.when(key % 2 == 0, 1234000000 + key * 37).otherwise(1237000 + key)


_PHONE_SQL = (
    "CAST(CASE WHEN c_custkey % 2 = 0 THEN 1234000000 + c_custkey*37 "
    "ELSE 1237000 + c_custkey END AS VARCHAR)"
)
expression(
    "format_phone", "customer", "c_custkey", lambda: text.format_phone(_phone()),
    f"'(' || substr({_PHONE_SQL},1,3) || ')' || substr({_PHONE_SQL},4,3) || '-' "
    f"|| substr({_PHONE_SQL},7,5)",
)
expression(
    "default_zip", "customer", "c_custkey",
    lambda: text.default_zip(F.expr("nullif(c_custkey % 10, 0) * 1000 + c_custkey")),
    "CASE WHEN c_custkey % 10 = 0 THEN '00000' "
    "WHEN c_custkey % 10 * 1000 + c_custkey > 9999 "
    "THEN CAST(c_custkey % 10 * 1000 + c_custkey AS VARCHAR) "
    "ELSE lpad(CAST(c_custkey % 10 * 1000 + c_custkey AS VARCHAR), 5, '0') END",
)
expression(
    "zip_number", "customer", "c_custkey",
    lambda: text.zip_number(F.when(
        F.col("c_custkey") % 4 != 0, F.substring(F.col("c_name"), 14, 5)
    ).otherwise(F.substring(F.col("c_name"), 7, 5))),
    "CASE WHEN c_custkey % 4 <> 0 THEN TRY_CAST(substr(c_name, 14, 5) AS INTEGER) "
    "ELSE TRY_CAST(substr(c_name, 7, 5) AS INTEGER) END",
)
expression(
    "zero_pad", "orders", "o_orderkey", lambda: text.zero_pad(F.col("o_custkey") % 1000, 2),
    "CASE WHEN o_custkey % 1000 < 10 THEN '0' ELSE '' END || CAST(o_custkey % 1000 AS VARCHAR)",
)
expression(
    "mask_id", "orders", "o_orderkey", lambda: text.mask_id(F.col("o_orderkey") + 100000000),
    "'XXX-XX-' || right(CAST(o_orderkey + 100000000 AS VARCHAR), 4)",
)
expression(
    "label_status", "orders", "o_orderkey",
    lambda: text.label_status(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"}),
    "CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END",
)
def _timeid_parts() -> list[Column]:
    """Year, month and day of an order, some of them out of range."""
    key = F.col("o_orderkey")
    return [
        F.when(key % 11 == 0, 18).otherwise(F.year("o_orderdate")),
        F.when(key % 7 == 0, F.month("o_orderdate") + 111).when(key % 13 == 0, 0)
        .when(key % 19 == 0, 13).otherwise(F.month("o_orderdate")),
        F.when(key % 17 == 0, 234).when(key % 23 == 0, 0).otherwise(F.dayofmonth("o_orderdate")),
    ]


expression(
    "compose_timeid", "orders", "o_orderkey", lambda: dates.compose_timeid(*_timeid_parts()),
    "CASE WHEN NOT (o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR "
    "o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 23 = 0) "
    "THEN strftime(o_orderdate, '%Y%m%d') END",
)
expression(
    "timeid_date", "orders", "o_orderkey",
    lambda: dates.timeid_date(
        dates.compose_timeid(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(30))
    ).cast("string"),
    "CASE WHEN month(o_orderdate) <> 2 THEN strftime(o_orderdate, '%Y-%m-30') END",
)
expression(
    "date_to_timeid", "orders", "o_orderkey",
    lambda: dates.date_to_timeid(F.to_date("o_orderdate")),
    "strftime(o_orderdate, '%Y%m%d')",
)


def _order_day() -> Column:
    return dates.date_to_timeid(F.col("o_orderdate"))


expression(
    "month_key", "orders", "o_orderkey", lambda: dates.month_key(_order_day()),
    "strftime(o_orderdate, '%Y%m')",
)
expression(
    "year_key", "orders", "o_orderkey", lambda: dates.year_key(_order_day()),
    "strftime(o_orderdate, '%Y')",
)
expression(
    "month_label", "orders", "o_orderkey",
    lambda: dates.month_label(dates.month_key(_order_day())),
    "strftime(o_orderdate, '%m/%Y')",
)
expression(
    "parse_timestamp", "events", "event_id",
    lambda: F.date_format(
        bank.in_utc(dates.parse_timestamp(
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-04:00"))
        )),
        "yyyy-MM-dd HH:mm:ss.SSS",
    ),
    "strftime(ts + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S.%g')",
)


def _date_text() -> Column:
    return (
        F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "MM-dd-yyyy"))
        .when(F.col("o_orderkey") % 5 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 5 == 2, F.date_format("o_orderdate", "M/d/yyyy"))
        .when(F.col("o_orderkey") % 5 == 3, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise("n/a")
    )


expression(
    "parse_date_multi", "orders", "o_orderkey",
    lambda: dates.parse_date_multi(_date_text()).cast("string"),
    "CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END",
)
expression(
    "valid_date", "orders", "o_orderkey", lambda: dates.valid_date(_date_text()),
    "o_orderkey % 5 = 1",
)
expression(
    "valid_range", "lineitem", "l_orderkey",
    lambda: dates.valid_range(
        F.date_format("l_shipdate", "M/d/yyyy"),
        F.concat((1994 + F.col("l_linenumber")).cast("string"), F.lit("-7-1")),
    ),
    "CAST(l_shipdate AS DATE) <= make_date(1994 + l_linenumber, 7, 1)",
)
expression(
    "full_address", "customer", "c_custkey",
    lambda: text.full_address(F.col("c_name"), F.expr("nullif(c_mktsegment, 'BUILDING')")),
    "c_name || ', ' || nullif(c_mktsegment, 'BUILDING')",
)
expression(
    "valid_name", "orders", "o_orderkey",
    lambda: checks.valid_name(F.substr("o_orderpriority", F.col("o_custkey").cast("int") % 2 + 1)),
    r"regexp_full_match(substr(o_orderpriority, o_custkey % 2 + 1), '[\p{L}\- ]*')",
)
expression(
    "valid_name_text", "documents", "doc_id", lambda: checks.valid_name(F.col("text")),
    r"regexp_full_match(text, '[\p{L}\- ]*')",
)
expression(
    "valid_street", "documents", "doc_id", lambda: checks.valid_street(F.col("text")),
    r"regexp_full_match(text, '[\p{L}\p{N}_\s\-.,]+')",
)


def _email() -> Column:
    return F.concat(
        F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")),
        F.when(F.col("c_custkey") % 3 == 0, "@x.com").when(F.col("c_custkey") % 3 == 1, "@x.c")
        .otherwise(""),
    )


expression(
    "valid_email", "customer", "c_custkey", lambda: checks.valid_email(_email()),
    "c_custkey % 3 = 0",
)
expression(
    "valid_phone", "customer", "c_custkey", lambda: checks.valid_phone(_phone().cast("string")),
    f"regexp_full_match({_PHONE_SQL}, '[0-9]{{10}}')",
)
expression(
    "valid_state", "customer", "c_custkey",
    lambda: checks.valid_state(
        F.upper(F.substr("c_name", F.col("c_custkey").cast("int") % 9 + 1, F.lit(2)))
    ),
    r"regexp_full_match(upper(substr(c_name, c_custkey % 9 + 1, 2)), '\p{L}{2}')",
)
expression(
    "valid_zip", "customer", "c_custkey",
    lambda: checks.valid_zip(F.substr("c_name", F.col("c_custkey").cast("int") % 9 + 6, F.lit(5))),
    "regexp_full_match(substr(c_name, c_custkey % 9 + 6, 5), '[0-9]{5}')",
)


# --- Updates ------------------------------------------------------------------

_CHANGES = """ch AS (
  SELECT c_custkey AS SSN,
    CASE c_custkey % 10 WHEN 0 THEN 'FIRST_NAME' WHEN 1 THEN 'LAST_NAME' WHEN 2 THEN 'MIDDLE_NAME'
      WHEN 3 THEN 'CUST_PHONE' WHEN 4 THEN 'CUST_EMAIL' WHEN 5 THEN 'FULL_STREET_ADDRESS'
      WHEN 6 THEN 'CUST_CITY' WHEN 7 THEN 'CUST_STATE' WHEN 8 THEN 'CUST_ZIP'
      ELSE 'CUST_COUNTRY' END AS field,
    CASE c_custkey % 20
      WHEN 3 THEN CAST(1234000000 + c_custkey AS VARCHAR) WHEN 13 THEN CAST(c_custkey AS VARCHAR)
      WHEN 4 THEN 'user.' || CAST(c_custkey AS VARCHAR) || '@x.com' WHEN 14 THEN 'bad@x'
      WHEN 5 THEN CAST(c_custkey AS VARCHAR) || ' Main St., Apt 4'
      WHEN 15 THEN '#' || CAST(c_custkey AS VARCHAR)
      WHEN 7 THEN 'ny' WHEN 17 THEN 'n1'
      WHEN 8 THEN lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')
      WHEN 18 THEN CAST(c_custkey AS VARCHAR) || 'x'
      ELSE CASE WHEN c_custkey % 20 < 10 THEN 'mary-jane DE' ELSE 'o''brien' END END AS new_value,
    CAST(1 AS BIGINT) AS seq
  FROM customer
  UNION ALL SELECT c_custkey, 'CUST_CITY', 'new ' || c_mktsegment, 2 FROM customer
  UNION ALL SELECT -1 - c_custkey, 'CUST_CITY', 'Nowhere', 3 FROM customer
  UNION ALL SELECT c_custkey, 'SHOE_SIZE', '44', 4 FROM customer),
norm AS (SELECT SSN, field, seq,
  CASE WHEN field IN ('FIRST_NAME','LAST_NAME','CUST_CITY','CUST_COUNTRY')
      THEN upper(substr(new_value,1,1)) || lower(substr(new_value,2))
    WHEN field = 'MIDDLE_NAME' THEN lower(new_value)
    WHEN field = 'CUST_STATE' THEN upper(new_value) ELSE new_value END AS new_value FROM ch)"""
_VALIDATED = _CHANGES + r""",
val AS (SELECT SSN, field, seq, new_value AS nv,
  CASE WHEN field = 'SHOE_SIZE' THEN 'unknown field'
    WHEN SSN NOT IN (SELECT c_custkey FROM customer) THEN 'unknown SSN'
    WHEN NOT CASE
      WHEN field IN ('FIRST_NAME','LAST_NAME','MIDDLE_NAME','CUST_CITY','CUST_COUNTRY')
        THEN regexp_full_match(new_value, '[\p{L}\- ]*')
      WHEN field = 'CUST_PHONE' THEN regexp_full_match(new_value, '[0-9]{10}')
      WHEN field = 'CUST_EMAIL' THEN
        regexp_full_match(new_value, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')
      WHEN field = 'FULL_STREET_ADDRESS' THEN
        regexp_full_match(new_value, '[\p{L}\p{N}_\s\-.,]+')
      WHEN field = 'CUST_STATE' THEN regexp_full_match(new_value, '\p{L}{2}')
      ELSE regexp_full_match(new_value, '[0-9]{5}') END THEN 'bad value' END AS reason FROM norm),
validated AS (SELECT SSN, field, seq, reason,
  CASE WHEN field = 'CUST_PHONE' AND reason IS NULL
    THEN '(' || substr(nv,1,3) || ')' || substr(nv,4,3) || '-' || substr(nv,7,5)
    ELSE nv END AS new_value FROM val)"""


def _validated(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return updates.validate_changes(
        updates.normalize_changes(bank.changes(spark, sf_dir)), bank.customer(spark, sf_dir),
        **options,
    )


@query("normalize_changes", f"WITH {_CHANGES} SELECT SSN, field, seq, new_value FROM norm")
def normalize_changes(spark, sf_dir):
    return updates.normalize_changes(bank.changes(spark, sf_dir))


@query("accepted_changes", f"""WITH {_VALIDATED}
SELECT SSN, field, seq, new_value FROM validated WHERE reason IS NULL""")
def accepted_changes(spark, sf_dir):
    return updates.accepted(_validated(spark, sf_dir))


@query("quarantined_changes", f"""WITH {_VALIDATED}
SELECT SSN, field, seq, new_value, reason FROM validated WHERE reason IS NOT NULL""")
def quarantined_changes(spark, sf_dir):
    return updates.quarantined(_validated(spark, sf_dir))


_CUSTOMER_COLUMNS = [
    "SSN", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "CREDIT_CARD_NO", "FULL_STREET_ADDRESS",
    "CUST_CITY", "CUST_STATE", "CUST_COUNTRY", "CUST_ZIP", "CUST_PHONE", "CUST_EMAIL",
]
_EDITED = [c for c in _CUSTOMER_COLUMNS if c in updates.EDITABLE]
_UPDATED = f"""WITH {_VALIDATED}, {_CUST},
ed AS (SELECT SSN, {', '.join(
    f"max_by(new_value, seq) FILTER (WHERE field = '{c}') AS u_{c}" for c in _EDITED
)} FROM validated WHERE reason IS NULL GROUP BY SSN)
SELECT {', '.join(
    f"coalesce(u_{c}, {c}) AS {c}" if c in _EDITED else f"cust.{c} AS {c}"
    for c in _CUSTOMER_COLUMNS
)}, CASE WHEN ed.SSN IS NOT NULL THEN '2024-01-01 00:00:00' ELSE LAST_UPDATED END AS LAST_UPDATED
FROM cust LEFT JOIN ed ON cust.SSN = ed.SSN"""


def _updated_customers(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    stamp = F.lit("2024-01-01T00:00:00Z").cast("timestamp")
    options["small"] = updates.small_batch(bank.changes(spark, sf_dir), **options)
    changes = updates.accepted(_validated(spark, sf_dir, **options))
    return updates.apply_updates(bank.customer(spark, sf_dir), changes, stamp, **options)


@query("apply_updates", _UPDATED)
def apply_updates(spark, sf_dir):
    return _plain(_updated_customers(spark, sf_dir))


@query("apply_updates_large_batch", _UPDATED)
def apply_updates_large_batch(spark, sf_dir):
    """The plan used when the batch does not fit a broadcast."""
    return _plain(_updated_customers(spark, sf_dir, max_broadcast_bytes=0))


@query("publish_version", _UPDATED)
def publish_version(spark, sf_dir):
    """Customers published, edited from that version, and published again."""
    root = scratch_folder(spark)
    writers.publish_version(bank.customer(spark, sf_dir), root, "customer")
    before = writers.read_latest(spark, root, "customer", schemas.CUSTOMER)
    small = updates.small_batch(bank.changes(spark, sf_dir))
    valid = updates.validate_changes(
        updates.normalize_changes(bank.changes(spark, sf_dir)), before, small=small
    )
    stamp = F.lit("2024-01-01T00:00:00Z").cast("timestamp")
    edited = updates.apply_updates(before, updates.accepted(valid), stamp, small=small)
    writers.publish_version(edited, root, "customer")
    return _plain(writers.read_latest(spark, root, "customer", schemas.CUSTOMER))


# --- Sources, sinks and the load ----------------------------------------------


_LOAN_SCHEMA = f"Application_ID BIGINT, {schemas.RAW_LOAN}"


def _good(raw: DataFrame) -> DataFrame:
    """Records that parsed, of files without further fields."""
    return split_corrupt(raw)[0].drop(schemas.OTHER_FIELDS)


def _staged(spark: SparkSession, df: DataFrame) -> str:
    path = f"{scratch_folder(spark)}/raw"
    df.write.json(path)
    return path


def _staged_arrays(spark: SparkSession, df: DataFrame, key: str, per_file: int = 100_000) -> str:
    """Stage files that hold one array each, of a bounded number of records."""
    path = f"{scratch_folder(spark)}/raw"
    arrays = df.groupBy(F.floor(F.col(key) / per_file).alias("file")).agg(
        F.concat(
            F.lit("[\n"),
            F.array_join(F.collect_list(F.to_json(F.struct(*df.columns))), ",\n"),
            F.lit("\n]"),
        ).alias("value")
    )
    arrays.write.partitionBy("file").text(path)
    return f"{path}/*"


def _loaded(spark: SparkSession, table: str, path: str) -> DataFrame:
    root = f"{scratch_folder(spark)}/warehouse"
    load_table(spark, table, path, root)
    return open_table(spark, root, table)


_RAW_BRANCH_SQL = f"""WITH {_BRANCH}
SELECT BRANCH_CODE, BRANCH_NAME, BRANCH_STREET, BRANCH_CITY, BRANCH_STATE,
  CASE WHEN s.k % 10 <> 0 THEN CAST(s.k % 10 * 1000 + s.k AS VARCHAR) END AS BRANCH_ZIP,
  phone AS BRANCH_PHONE,
  strftime(CAST(LAST_UPDATED AS TIMESTAMP) - INTERVAL 4 HOUR, '%Y-%m-%dT%H:%M:%S')
    || '.000-04:00' AS LAST_UPDATED
FROM branch JOIN (SELECT s_suppkey AS k FROM supplier) s ON s.k = BRANCH_CODE"""


@query("read_branch_json", _RAW_BRANCH_SQL)
def read_branch_json(spark, sf_dir):
    return _good(read_raw(spark, "branch", _staged(spark, bank.raw_branch(spark, sf_dir))))


@query("read_credit_json", f"""WITH {_TXN}
SELECT CUST_CC_NO AS CREDIT_CARD_NO, CAST(substr(TIMEID,1,4) AS INTEGER) AS YEAR,
  CAST(substr(TIMEID,5,2) AS INTEGER) AS MONTH, CAST(substr(TIMEID,7,2) AS INTEGER) AS DAY,
  CUST_SSN, BRANCH_CODE, TRANSACTION_ID, TRANSACTION_TYPE, CAST(v AS DOUBLE) AS TRANSACTION_VALUE
FROM txn""")
def read_credit_json(spark, sf_dir):
    raw = read_raw(spark, "credit", _staged(spark, bank.raw_credit(spark, sf_dir)))
    return _plain(_good(raw))


@query("read_customer_json", """
SELECT c_custkey AS SSN, lower(c_mktsegment) || '-' || n_name AS FIRST_NAME,
  upper(r_name) AS MIDDLE_NAME, 'o''' || lower(c_name) AS LAST_NAME,
  CAST(4000000000000000 + c_custkey AS VARCHAR) AS CREDIT_CARD_NO,
  CAST(nullif(c_custkey % 50, 0) AS VARCHAR) AS APT_NO, c_name || ' Road' AS STREET_NAME,
  n_name AS CUST_CITY, n_name AS CUST_STATE, r_name AS CUST_COUNTRY,
  CAST(c_custkey % 100 AS VARCHAR) AS CUST_ZIP,
  CAST(1234000000 + c_custkey*37 AS VARCHAR) AS CUST_PHONE,
  replace(lower(c_name),'#','.') || '@x.com' AS CUST_EMAIL,
  strftime(TIMESTAMP '2021-09-05 08:15:30' + to_seconds(c_custkey), '%Y-%m-%dT%H:%M:%S')
    || '.000-04:00' AS LAST_UPDATED
FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""")
def read_customer_json(spark, sf_dir):
    return _good(read_raw(spark, "customer", _staged(spark, bank.raw_customer(spark, sf_dir))))


_LOAN_ROWS = f"""WITH {_LOAN}
SELECT Application_ID, Application_Status, Self_Employed, Gender, Married FROM loan"""


@query("read_loan_json", _LOAN_ROWS)
def read_loan_json(spark, sf_dir):
    path = _staged_arrays(spark, bank.loan(spark, sf_dir), "Application_ID")
    return _good(read_raw(spark, "loan", path, _LOAN_SCHEMA))


@query("etl_branch", f"""WITH {_BRANCH}
SELECT BRANCH_CODE, BRANCH_NAME, BRANCH_STREET, BRANCH_CITY, BRANCH_STATE, BRANCH_ZIP,
  {_BRANCH_PHONE} AS BRANCH_PHONE, LAST_UPDATED FROM branch""")
def etl_branch(spark, sf_dir):
    path = _staged(spark, bank.raw_branch(spark, sf_dir))
    return _plain(_loaded(spark, "branch", path))


@query("etl_credit", f"""WITH {_TXN} SELECT {_TXN_COLUMNS},
  substr(TIMEID,1,4) || '-' || substr(TIMEID,5,2) || '-' || substr(TIMEID,7,2) AS txn_date
FROM txn""")
def etl_credit(spark, sf_dir):
    path = _staged(spark, bank.raw_credit(spark, sf_dir))
    return _plain(_loaded(spark, "credit", path))


@query("etl_customer", f"""WITH {_CUST}
SELECT {', '.join(_CUSTOMER_COLUMNS)}, LAST_UPDATED FROM cust""")
def etl_customer(spark, sf_dir):
    path = _staged(spark, bank.raw_customer(spark, sf_dir))
    return _plain(_loaded(spark, "customer", path))


@query("etl_loan", _LOAN_ROWS)
def etl_loan(spark, sf_dir):
    """With the usual schema: the identifier comes among the other fields."""
    path = _staged_arrays(spark, bank.loan(spark, sf_dir), "Application_ID")
    stored = _loaded(spark, "loan", path)
    number = F.col(schemas.OTHER_FIELDS)["Application_ID"].cast("bigint")
    return stored.withColumn("Application_ID", number).drop(schemas.OTHER_FIELDS)


@query("stored_month", f"""WITH {_TXN}
SELECT {_TXN_COLUMNS} FROM txn WHERE TIMEID LIKE '199804%'""")
def stored_month(spark, sf_dir):
    """One month of the transactions stored by month: only its folder is read."""
    path = f"{scratch_folder(spark)}/credit"
    writers.write_table(bank.txn(spark, sf_dir), path, **LAYOUT["credit"])
    stored = read_table(spark, path, schemas.CREDIT)
    return _txn_rows(stored.filter(dates.in_month(YEAR, MONTH)))


@query("catalog_table", f"""WITH {_BRANCH}
SELECT BRANCH_CODE, BRANCH_NAME, BRANCH_STREET, BRANCH_CITY, BRANCH_STATE, BRANCH_ZIP,
  {_BRANCH_PHONE} AS BRANCH_PHONE, LAST_UPDATED FROM branch""")
def catalog_table(spark, sf_dir):
    """Branches kept as a table of a database that is created when absent."""
    location = scratch_folder(spark)
    database = location.rsplit("/", 1)[1].replace("-", "_")
    writers.ensure_database(spark, database, location)
    writers.ensure_database(spark, database, location)
    writers.save_as_table(bank.branch(spark, sf_dir), f"{database}.branch")
    return _plain(spark.table(f"{database}.branch"))


@query("stored_result", SQL["monthly_bills"])
def stored_result(spark, sf_dir):
    """A whole result kept as Parquet."""
    path = f"{scratch_folder(spark)}/bills"
    writers.write_result(reports.monthly_bills(bank.txn(spark, sf_dir)), path)
    return read_table(spark, path)


# --- Tables kept up to date ----------------------------------------------------


def _edited(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the customers loaded in ranges of 100 keys, and the batch applied."""
    root = f"{scratch_folder(spark)}/warehouse"
    path = _staged(spark, bank.raw_customer(spark, sf_dir))
    load_table(spark, "customer", path, root, sink=path_sink(root, keys_each=100))
    stamp = F.lit("2024-01-01T00:00:00Z").cast("timestamp")
    edit_stored(spark, root, bank.changes(spark, sf_dir), "one", stamp, keys_each=100)
    return root


@query("edit_stored_customers", _UPDATED)
def edit_stored_customers(spark, sf_dir):
    """The batch applied to stored customers: only folders with an edited one change."""
    return _plain(open_table(spark, _edited(spark, sf_dir), "customer"))


@query("customers_before_edits", f"""WITH {_CUST}
SELECT {', '.join(_CUSTOMER_COLUMNS)}, LAST_UPDATED FROM cust""")
def customers_before_edits(spark, sf_dir):
    """The version before the edits."""
    before = versions.read(spark, _edited(spark, sf_dir), "customer", schemas.CUSTOMER, version=1)
    return _plain(before.drop("key_range"))


@query("refused_edits", SQL["quarantined_changes"])
def refused_edits(spark, sf_dir):
    """What the edits of stored customers left out, with the reason."""
    refused = read_table(spark, f"{_edited(spark, sf_dir)}/quarantined/customer")
    return refused.drop("batch")


def _summarized(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the transactions and their summaries; one month is stored twice
    over, the second time alone, so that its sums are made anew."""
    root = f"{scratch_folder(spark)}/warehouse"
    txn = bank.txn(spark, sf_dir)
    store = path_sink(root, summarize=True)
    store(txn, "credit", "overwrite")
    store(txn.filter(F.col("txn_month") == "199804"), "credit", "replace_partitions")
    return root


@query("summary_monthly_bills", SQL["monthly_bills"])
def summary_monthly_bills(spark, sf_dir):
    return summaries.monthly_bills(spark, _summarized(spark, sf_dir))


@query("summary_top_customers", SQL["top_customers"])
def summary_top_customers(spark, sf_dir):
    return summaries.top_customers(spark, _summarized(spark, sf_dir))


@query("summary_top_months", SQL["top_months"])
def summary_top_months(spark, sf_dir):
    return summaries.top_months(spark, _summarized(spark, sf_dir))


@query("summary_domains", f"""WITH {_TXN}
SELECT DISTINCT 'TRANSACTION_TYPE' AS field, TRANSACTION_TYPE AS value FROM txn
UNION ALL SELECT DISTINCT 'year', substr(TIMEID, 1, 4) FROM txn
UNION ALL SELECT DISTINCT 'BRANCH_CODE', CAST(BRANCH_CODE AS VARCHAR) FROM txn
UNION ALL SELECT DISTINCT 'CUST_SSN', CAST(CUST_SSN AS VARCHAR) FROM txn
UNION ALL SELECT DISTINCT 'CUST_CC_NO', CUST_CC_NO FROM txn""")
def summary_domains(spark, sf_dir):
    """All known values of the transactions, without a scan of these."""
    known = summaries.open_summary(spark, _summarized(spark, sf_dir), "known_values")
    return known.select("field", "value").distinct()


def _bucketed(spark: SparkSession, sf_dir: str) -> str:
    location = scratch_folder(spark)
    database = location.rsplit("/", 1)[1].replace("-", "_")
    bucketed.store_bucketed(
        spark, bank.txn(spark, sf_dir), bank.customer(spark, sf_dir), database, 16, location)
    return database


@query("branch_state_totals_bucketed", SQL["branch_state_totals"])
def branch_state_totals_bucketed(spark, sf_dir):
    """Customers too many for a broadcast, but in the buckets of the transactions."""
    totals = bucketed.matched_totals(
        spark, _bucketed(spark, sf_dir), bank.branch(spark, sf_dir), "BRANCH_STATE")
    return totals.select(
        "BRANCH_STATE", F.col("n").alias("total_number"),
        reports.rounded(F.col("total")).alias("total_amount"))


@query("join_customer_bucketed", SQL["join_customer"])
def join_customer_bucketed(spark, sf_dir):
    """Every transaction with its customer, neither side shuffled."""
    rows = bucketed.join_customer(spark, _bucketed(spark, sf_dir))
    return _plain(rows.select(
        "TRANSACTION_ID", "BRANCH_CODE", "TIMEID", "TRANSACTION_VALUE", "SSN", "LAST_NAME"))


@query("stored_transaction", f"""WITH {_TXN}
SELECT {_TXN_COLUMNS} FROM txn WHERE TRANSACTION_ID = 1378""")
def stored_transaction(spark, sf_dir):
    """Rows of one transaction number, by which the files are not ordered: row groups
    whose Bloom filter does not hold it are passed over."""
    path = f"{scratch_folder(spark)}/credit"
    writers.write_table(
        bank.txn(spark, sf_dir), path, **LAYOUT["credit"], bloom={"TRANSACTION_ID": 10_000})
    return _txn_rows(read_table(spark, path, schemas.CREDIT).filter(F.col("TRANSACTION_ID") == 1378))
