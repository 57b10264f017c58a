"""Day keys (``YYYYMMDD`` text), month keys and date parsing."""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlake.functions.text import zero_pad

# Accepted date patterns, in order of trial.
DATE_PATTERNS = ["M-d-yyyy", "yyyy-M-d", "M/d/yyyy", "yyyy/M/d"]
ISO_PATTERN = "yyyy-M-d"
DAY_KEY_PATTERN = "yyyyMMdd"

_DATE_ARGUMENT = re.compile(
    r"(?P<m1>\d{1,2})(?P<s1>[-/])(?P<d1>\d{1,2})(?P=s1)(?P<y1>\d{4})"
    r"|(?P<y2>\d{4})(?P<s2>[-/])(?P<m2>\d{1,2})(?P=s2)(?P<d2>\d{1,2})"
)


def compose_timeid(year: Column, month: Column, day: Column) -> Column:
    """Day key; null where year, month or day is out of range, as a longer or shorter
    one would be taken for another month's."""
    in_range = year.between(1000, 9999) & month.between(1, 12) & day.between(1, 31)
    return F.when(in_range, F.concat(year.cast("string"), zero_pad(month, 2), zero_pad(day, 2)))


def timeid_date(timeid: Column) -> Column:
    """Date of a day key; null for impossible days."""
    return F.try_to_date(timeid, DAY_KEY_PATTERN)


def date_to_timeid(c: Column) -> Column:
    # by arithmetic: several times cheaper than a date formatter
    return zero_pad(F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c), 8)


def month_key(timeid: Column) -> Column:
    return F.substring(timeid, 1, 6)


def year_key(timeid: Column) -> Column:
    return F.substring(timeid, 1, 4)


def month_label(month: Column) -> Column:
    """``YYYYMM`` as ``MM/YYYY``."""
    return F.concat(F.right(month, F.lit(2)), F.lit("/"), F.left(month, F.lit(4)))


def parse_timestamp(c: Column) -> Column:
    """ISO text (with or without offset) as timestamp; null when malformed."""
    return F.try_to_timestamp(c)


def parse_date_multi(c: Column) -> Column:
    """Date from text in the first of the accepted patterns that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(p)).cast("date") for p in DATE_PATTERNS])


def valid_date(c: Column) -> Column:
    """True for an existing year-month-day date."""
    return F.try_to_timestamp(c, F.lit(ISO_PATTERN)).isNotNull()


def valid_range(start: Column, end: Column) -> Column:
    """True when both texts are dates and the start is not after the end."""
    return F.coalesce(parse_date_multi(start) <= parse_date_multi(end), F.lit(False))


def month_argument(year: int | str, month: int | str) -> str:
    """Month key for a year and month given by the caller."""
    y, m = int(year), int(month)
    if not 1 <= m <= 12 or not 1 <= y <= 9999:
        raise ValueError(f"not a month: {year}-{month}")
    return f"{y:04d}{m:02d}"


def date_argument(value: dt.date | str) -> dt.date:
    """Date given by the caller, as ``date`` or as text in an accepted pattern."""
    if isinstance(value, dt.date):
        return value
    found = _DATE_ARGUMENT.fullmatch(value)
    if not found:
        raise ValueError(f"not a date in an accepted pattern: {value!r}")
    g = found.groupdict()
    return dt.date(int(g["y1"] or g["y2"]), int(g["m1"] or g["m2"]), int(g["d1"] or g["d2"]))


def in_month(
    year: int | str, month: int | str,
    month_col: str | None = "txn_month", date_col: str | None = None,
    timeid_col: str = "TIMEID",
) -> Column:
    """Rows of one month.

    On a table partitioned by ``month_col`` this prunes folders. Without one the
    month is the beginning of the day key ``timeid_col``. ``date_col``
    names a date that is known for every row; its range is added so that the
    scan of an unpartitioned table can skip row groups too.
    """
    key = month_argument(year, month)
    rows = F.col(month_col) == key if month_col else F.col(timeid_col).startswith(key)
    if date_col:
        first = dt.date(int(key[:4]), int(key[4:]), 1)
        last = first.replace(day=calendar.monthrange(first.year, first.month)[1])
        rows = F.col(date_col).between(F.lit(first), F.lit(last)) & rows
    return rows


def between_dates(
    start: dt.date | str, end: dt.date | str,
    timeid_col: str = "TIMEID", month_col: str | None = "txn_month", date_col: str | None = None,
) -> Column:
    """Rows from ``start`` to ``end``, both included.

    ``month_col`` adds a range over the partition column, ``date_col`` (a date
    known for every row) one over the date, both for pruning only.
    """
    first, last = date_argument(start), date_argument(end)
    low, high = f"{first:%Y%m%d}".zfill(8), f"{last:%Y%m%d}".zfill(8)
    rows = F.col(timeid_col).between(low, high)
    if month_col:
        rows = F.col(month_col).between(low[:6], high[:6]) & rows
    if date_col:
        rows = F.col(date_col).between(F.lit(first), F.lit(last)) & rows
    return rows
