"""Declared table schemas, so that no read spends a pass on inference."""

from __future__ import annotations

# Raw files. Zip and phone may be numbers or text in the file; both read as text.
RAW_BRANCH = (
    "BRANCH_CODE BIGINT, BRANCH_NAME STRING, BRANCH_STREET STRING, BRANCH_CITY STRING, "
    "BRANCH_STATE STRING, BRANCH_ZIP STRING, BRANCH_PHONE STRING, LAST_UPDATED STRING"
)
RAW_CREDIT = (
    "CREDIT_CARD_NO STRING, YEAR INT, MONTH INT, DAY INT, CUST_SSN BIGINT, BRANCH_CODE BIGINT, "
    "TRANSACTION_ID BIGINT, TRANSACTION_TYPE STRING, TRANSACTION_VALUE DECIMAL(18,2)"
)
RAW_CUSTOMER = (
    "SSN BIGINT, FIRST_NAME STRING, MIDDLE_NAME STRING, LAST_NAME STRING, CREDIT_CARD_NO STRING, "
    "APT_NO STRING, STREET_NAME STRING, CUST_CITY STRING, CUST_STATE STRING, CUST_COUNTRY STRING, "
    "CUST_ZIP STRING, CUST_PHONE STRING, CUST_EMAIL STRING, LAST_UPDATED STRING"
)

# The columns the questions need; others of the files come as ``OTHER_FIELDS``.
RAW_LOAN = (
    "Application_Status STRING, Self_Employed STRING, Gender STRING, Married STRING"
)

# Warehouse tables, without ``OTHER_FIELDS``.
BRANCH = (
    "BRANCH_CODE BIGINT, BRANCH_NAME STRING, BRANCH_STREET STRING, BRANCH_CITY STRING, "
    "BRANCH_STATE STRING, BRANCH_ZIP STRING, BRANCH_PHONE STRING, LAST_UPDATED TIMESTAMP"
)
CREDIT = (
    "CUST_CC_NO STRING, TIMEID STRING, txn_date DATE, CUST_SSN BIGINT, BRANCH_CODE BIGINT, "
    "TRANSACTION_ID BIGINT, TRANSACTION_TYPE STRING, TRANSACTION_VALUE DECIMAL(18,2), "
    "txn_month STRING"
)
CUSTOMER = (
    "SSN BIGINT, FIRST_NAME STRING, MIDDLE_NAME STRING, LAST_NAME STRING, CREDIT_CARD_NO STRING, "
    "FULL_STREET_ADDRESS STRING, CUST_CITY STRING, CUST_STATE STRING, CUST_COUNTRY STRING, "
    "CUST_ZIP STRING, CUST_PHONE STRING, CUST_EMAIL STRING, LAST_UPDATED TIMESTAMP"
)
CHANGES = "SSN BIGINT, field STRING, new_value STRING, seq BIGINT"

CORRUPT_COLUMN = "_corrupt_record"
# Map of the fields of a record that its schema does not name.
OTHER_FIELDS = "other_fields"
