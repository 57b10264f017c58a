"""Column expressions on edge cases, and against the Python built-ins they mirror."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardlake.functions import checks, dates, text

# Letters with and without case, separators, digits, spaces of several kinds.
NAMES = st.lists(
    st.text(alphabet="abzÄéñßõÿabc日本'-. \t\n019_ABZXÉ", max_size=14), min_size=1, max_size=60
)
FEW = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def values(spark, expression, rows, kind="string"):
    """``expression`` of column ``c`` for each of ``rows``, in order."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i INT, c {kind}")
    found = {r["i"]: r["v"] for r in df.select("i", expression.alias("v")).collect()}
    return [found[i] for i in range(len(rows))]


C = "c"


@pytest.fixture
def c(spark):
    return F.col(C)


def test_title_case(spark, c):
    rows = ["o'brien", "MARY-JANE", "de la cruz", "élodie ÀÉ'ê", "a1b", "x\ty\nz", "ǆo", "", None]
    assert values(spark, text.title_case(c), rows) == [
        None if r is None else r.title() for r in rows
    ]


@FEW
@given(names=NAMES)
def test_title_case_is_pythons(spark, names):
    assert values(spark, text.title_case(F.col(C)), names) == [n.title() for n in names]


@FEW
@given(names=NAMES)
def test_capitalize_first_is_pythons(spark, names):
    assert values(spark, text.capitalize_first(F.col(C)), names) == [
        n.capitalize() for n in names
    ]


@FEW
@given(names=NAMES)
def test_valid_name_is_pythons(spark, names):
    assert values(spark, checks.valid_name(F.col(C)), names) == [
        all(x.isalpha() or x in "- " for x in n) for n in names
    ]


def test_zips(spark, c):
    rows = [None, "3068", "40217", "", "123456"]
    assert values(spark, text.default_zip(c), rows) == [
        "00000", "03068", "40217", "00000", "123456"
    ]
    assert values(spark, text.padded_zip(c), [None, "3068", ""]) == [None, "03068", None]
    assert values(spark, text.zip_number(c), ["03068", "x", None]) == [3068, None, None]


@FEW
@given(numbers=st.lists(st.integers(0, 10**7).map(str), min_size=1, max_size=60))
def test_zero_pad_is_zfill(spark, numbers):
    assert values(spark, text.zero_pad(F.col(C), 5), numbers) == [n.zfill(5) for n in numbers]


def test_format_phone(spark, c):
    rows = ["9075551234", "9075558", "12345678901", None]
    assert values(spark, text.format_phone(c), rows) == [
        "(907)555-1234", "(907)555-8", "(123)456-78901", None
    ]
    assert values(spark, text.format_phone(c), [9075551234], "bigint") == ["(907)555-1234"]


def test_full_address_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("Main St", "4"), ("Main St", None), (None, "4")], "s string, a string")
    found = df.select(text.full_address(F.col("s"), F.col("a")).alias("v")).collect()
    assert [r["v"] for r in found] == ["Main St, 4", None, None]


def test_mask_id(spark, c):
    assert values(spark, text.mask_id(c), [123456789, 42, None], "bigint") == [
        "XXX-XX-6789", "XXX-XX-0042", None
    ]


def test_label_status(spark, c):
    assert values(spark, text.label_status(c), ["Y", "N", "P", None]) == [
        "Approved", "Not Approved", "P", None
    ]


def test_day_keys(spark):
    df = spark.createDataFrame([(2018, 2, 3), (2018, 12, 30), (2018, 2, 30), (None, 1, 1)],
                               "y int, m int, d int")
    key = dates.compose_timeid(F.col("y"), F.col("m"), F.col("d"))
    found = df.select(
        key.alias("k"), dates.timeid_date(key).alias("t"), dates.month_key(key).alias("mk"),
        dates.year_key(key).alias("yk"), dates.month_label(dates.month_key(key)).alias("l"),
    ).collect()
    assert [tuple(r) for r in found] == [
        ("20180203", dt.date(2018, 2, 3), "201802", "2018", "02/2018"),
        ("20181230", dt.date(2018, 12, 30), "201812", "2018", "12/2018"),
        ("20180230", None, "201802", "2018", "02/2018"),
        (None, None, None, None, None),
    ]


def test_date_to_timeid(spark, c):
    rows = [dt.date(2018, 2, 3), dt.date(987, 11, 30), None]
    assert values(spark, dates.date_to_timeid(c), rows, "date") == ["20180203", "09871130", None]


PYTHON_PATTERNS = ["%m-%d-%Y", "%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d"]


def python_date(value):
    for pattern in PYTHON_PATTERNS:
        try:
            return dt.datetime.strptime(value, pattern).date()
        except ValueError:
            pass
    return None


@FEW
@given(texts=st.lists(st.builds(
    lambda y, m, d, s, front, pad: (
        f"{y}{s}{m:0{pad}d}{s}{d:0{pad}d}" if front else f"{m:0{pad}d}{s}{d:0{pad}d}{s}{y}"
    ),
    st.integers(1900, 2100), st.integers(0, 13), st.integers(0, 32), st.sampled_from("-/."),
    st.booleans(), st.integers(1, 2),
), min_size=1, max_size=80))
def test_parse_date_multi_is_pythons(spark, texts):
    expected = [python_date(t) for t in texts]
    assert values(spark, dates.parse_date_multi(F.col(C)), texts) == expected
    for value, date in zip(texts, expected):
        if date is None:
            with pytest.raises(ValueError):
                dates.date_argument(value)
        else:
            assert dates.date_argument(value) == date


def test_valid_date_and_range(spark, c):
    rows = ["2018-02-03", "2018-2-3", "2018-02-30", "02/03/2018", "", None]
    assert values(spark, dates.valid_date(c), rows) == [True, True, False, False, False, False]
    assert values(spark, dates.valid_range(c, F.lit("2018-10-1")), ["2018-2-1", "10/2/2018", "x"]) \
        == [True, False, False]


def test_parse_timestamp(spark, c):
    moments = values(
        spark, F.date_format(dates.parse_timestamp(c), "yyyy-MM-dd HH:mm:ss"),
        ["2021-09-05T08:15:30.000-04:00", "2021-09-05 12:15:30", "soon", None],
    )
    assert moments == ["2021-09-05 12:15:30", "2021-09-05 12:15:30", None, None]


@pytest.mark.parametrize("check, good, bad", [
    (checks.valid_name, ["Mary-Jane de", "", "Ñandú"], ["O'Brien", "a1", "a\n"]),
    (checks.valid_phone, ["1234567890"], ["123456789", "12345678901", "123456789x", "1234567890\n"]),
    (checks.valid_email, ["a.b+c@x-y.com"], ["a@x", "a@x.c", "@x.com", "a b@x.com", "a@x.com\n"]),
    (checks.valid_street, ["12 Main St., Apt-4", "Calle Ñandú_1"], ["", "#4", "a;b"]),
    (checks.valid_state, ["NY", "ÄB"], ["N", "NYC", "N1", "NY\n"]),
    (checks.valid_zip, ["03068"], ["3068", "030681", "0750a", "03068\n"]),
])
def test_checks(spark, c, check, good, bad):
    assert values(spark, check(c), good + bad + [None]) == \
        [True] * len(good) + [False] * len(bad) + [None]


def test_arguments():
    assert dates.month_argument("2018", "3") == "201803"
    for year, month in [(2018, 13), (2018, 0), ("x", 1)]:
        with pytest.raises(ValueError):
            dates.month_argument(year, month)
    assert dates.date_argument(dt.date(2018, 1, 2)) == dt.date(2018, 1, 2)


def test_marks_of_a_text_are_kept(spark, c):
    rows = ["x\uffff y", "\uffff.a b", "\uffff\uffff ab", "ab\uffffcd"]
    assert values(spark, text.title_case(c), rows) == [r.title() for r in rows]


def test_capitalize_looks_at_the_whole_text(spark, c):
    rows = ["\u0391\u03a3 \u039f\u0394\u039f\u03a3", "\u0130STANBUL", "", "ab"]
    assert values(spark, text.capitalize_first(c), rows) == [r.capitalize() for r in rows]


def test_day_keys_out_of_range_are_null(spark):
    parts = [(2018, 2, 3), (2018, 0, 1), (2018, 13, 1), (2018, 123, 1), (2018, 1, 234),
             (2018, 1, 0), (18, 1, 5), (20180, 1, 5), (None, 1, 1)]
    df = spark.createDataFrame(parts, "y int, m int, d int")
    key = dates.compose_timeid(F.col("y"), F.col("m"), F.col("d"))
    assert [r.v for r in df.select(key.alias("v")).collect()] == ["20180203"] + [None] * 8
