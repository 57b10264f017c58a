"""Validity checks for customer details. Null in, null out."""

from __future__ import annotations

from pyspark.sql import Column

# What each kind of field may hold, over the whole text.
NAME_PATTERN = r"^[\p{L}\- ]*\z"
PHONE_PATTERN = r"^[0-9]{10}\z"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
STREET_PATTERN = r"^[\p{L}\p{N}_\s\-.,]+\z"
STATE_PATTERN = r"^\p{L}{2}\z"
ZIP_PATTERN = r"^[0-9]{5}\z"


def valid_name(c: Column) -> Column:
    """Letters, dashes and spaces."""
    return c.rlike(NAME_PATTERN)


def valid_phone(c: Column) -> Column:
    return c.rlike(PHONE_PATTERN)


def valid_email(c: Column) -> Column:
    return c.rlike(EMAIL_PATTERN)


def valid_street(c: Column) -> Column:
    return c.rlike(STREET_PATTERN)


def valid_state(c: Column) -> Column:
    return c.rlike(STATE_PATTERN)


def valid_zip(c: Column) -> Column:
    return c.rlike(ZIP_PATTERN)
