"""Text cleaning expressions.

Everything here stays inside whole-stage code generation: no UDF and no
higher-order function over arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and labels the results must show.
DEFAULT_ZIP = "00000"
ZIP_LENGTH = 5
ID_LENGTH = 9
MASK_PREFIX = "XXX-XX-"
STATUS_LABELS = {"Y": "Approved", "N": "Not Approved"}

# Letters with case. Other letters (for example CJK) do not continue a word.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
# U+FFFF is a noncharacter; where a text has it all the same, a dot is set behind it, so
# that it is never taken for the mark.
_MARK = "\uffff"
_WORD_MARK = _MARK + " "
_OWN_MARK = _MARK + "."


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` starts a word only after a space, so every other word start gets a
    marked space first, which is taken out again afterwards.
    """
    kept = F.replace(c, F.lit(_MARK), F.lit(_OWN_MARK))
    marked = F.regexp_replace(kept, f"([^{_CASED} ])(?=[{_CASED}])", "$1" + _WORD_MARK)
    titled = F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))
    return F.replace(titled, F.lit(_OWN_MARK), F.lit(_MARK))


def capitalize_first(c: Column) -> Column:
    """First character in title case, the rest lower case.

    The whole text is lowered and then cut, as the form of a letter can depend on those
    before it.
    """
    first = F.substring(c, 1, 1)
    rest = F.substr(F.lower(c), F.length(F.lower(first)) + 1)
    return F.concat(F.initcap(first), rest)


def zero_pad(c: Column, width: int) -> Column:
    """Pad with zeros on the left; unlike ``lpad``, longer values are kept whole."""
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def padded_zip(c: Column) -> Column:
    """Zip code as text, with lost leading zeros put back; null and empty give null."""
    return zero_pad(F.nullif(c.cast("string"), F.lit("")), ZIP_LENGTH)


def default_zip(c: Column) -> Column:
    """Zip code as text, with a default for a missing one."""
    return F.coalesce(padded_zip(c), F.lit(DEFAULT_ZIP))


def zip_number(c: Column) -> Column:
    """Zip code as integer; text that is no number gives null."""
    return c.try_cast("int")


def format_phone(c: Column) -> Column:
    """``(XXX)XXX-XXXX``; null stays null, short numbers are formatted as they are."""
    text = c.cast("string")
    return F.concat(
        F.lit("("), F.substring(text, 1, 3), F.lit(")"),
        F.substring(text, 4, 3), F.lit("-"), F.substring(text, 7, 5),
    )


def full_address(street: Column, apartment: Column) -> Column:
    """Street and apartment in one field; null when either is null."""
    return F.concat(street, F.lit(", "), apartment)


def mask_id(c: Column) -> Column:
    """Hide all but the last four digits of a nine-digit identifier."""
    return F.concat(F.lit(MASK_PREFIX), F.right(zero_pad(c, ID_LENGTH), F.lit(4)))


def label_status(c: Column, labels: dict[str, str] | None = None) -> Column:
    """Replace status codes by their labels; other values pass."""
    result = c
    for code, label in (labels or STATUS_LABELS).items():
        result = F.when(c == code, F.lit(label)).otherwise(result)
    return result
