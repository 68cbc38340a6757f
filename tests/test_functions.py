from datetime import date
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlens import functions as fn


def test_key_text_trims_control_characters_and_blanks_null(column):
    values = [" a ", "\tnation\n", "\x00 b\x1f", " \t x \t ", "a\tb", "", "   ", "\t", None, "é "]
    expected = ["A", "NATION", "B", "X", "A\tB", "", "", "", "", "É"]
    assert column(fn.key_text, values) == expected


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="\x00\t\n !aZ~é", max_size=6), min_size=20, max_size=40))
def test_key_text_equals_a_character_by_character_trim(column, values):
    blanks = "".join(map(chr, range(0x21)))
    assert column(fn.key_text, values) == [v.strip(blanks).upper() for v in values]


def test_label_and_trimmed_keep_null_and_tabs(column):
    values = [" a ", "\tb", None, "  "]
    assert column(fn.label_text, values) == ["A", "\tB", None, ""]
    assert column(fn.trimmed, values) == ["a", "\tb", None, ""]


def test_lenient_numbers(column):
    values = ["12", " 12 ", "-1", "0", "", "abc", "12.0", "12.7", None]
    assert column(fn.parse_int, values) == [12, 12, -1, 0, None, None, None, None, None]
    assert column(fn.parse_id, values) == [12, 12, -1, 0, None, None, None, None, None]
    doubles = [12.0, 12.0, -1.0, 0.0, None, None, 12.0, 12.7, None]
    assert column(fn.parse_double, values) == doubles


def test_money_is_exact_and_drops_what_it_cannot_hold(column):
    values = ["0.1", "12.345", "1e2", "NaN", "Infinity", "1e300", "x", ""]
    expected = [Decimal("0.10"), Decimal("12.35"), Decimal("100.00"), *[None] * 5]
    assert column(fn.money, values) == expected


def test_dates(column):
    values = [
        "04-30-22", " 04-30-22 ", "4-30-22", "13-45-22", "02-30-22", "04-30-2022", "", "04-30-99",
        None,
    ]
    day = date(2022, 4, 30)
    expected = [day, day, None, None, None, None, None, date(2099, 4, 30), None]
    assert column(fn.parse_date, values) == expected


def test_clamped_dates(column):
    values = ["02-30-22", "02-29-24", "02-31-24", "04-31-22", "04-32-22", "13-30-22", "\t04-30-22"]
    expected = [
        date(2022, 2, 28), date(2024, 2, 29), date(2024, 2, 29), date(2022, 4, 30), None, None,
        date(2022, 4, 30),
    ]
    assert column(fn.parse_date_clamped, values) == expected


def test_month_and_following_days(column):
    days = [date(2022, 12, 30), None]
    assert column(fn.month_of, days, "date") == ["2022-12", None]
    assert column(lambda x: fn.following_days(x, F.lit(3)), days, "date") == [
        [date(2022, 12, 31), date(2023, 1, 1), date(2023, 1, 2)],
        None,
    ]


def test_sizes(column):
    values = ["XL", "XXL", "6XL", "FREE", "7XL", "", None]
    assert column(fn.size_rank, values) == [4, 5, 9, None, None, None, None]
    assert column(lambda x: fn.at_least_size(x, "XXL"), values) == [False, True, True, *[False] * 4]


def test_code_lists(column):
    values = [None, "", "  ", ",,", " A , B", "A,A", "A, ,b,"]
    expected = [[], [], [], [], ["A", "B"], ["A", "A"], ["A", "b"]]
    assert column(fn.codes, values) == expected
    assert column(fn.code_count, values) == [len(codes) for codes in expected]


def variance_of(spark, amounts):
    frame = spark.createDataFrame([(Decimal(a),) for a in amounts], f"a {fn.MONEY}")
    sums = fn.square_sums(F.col("a"))
    return frame.agg(fn.population_variance(F.count("a"), sums)).first()[0]


@pytest.mark.parametrize(
    "amounts, expected",
    [(["0.10"] * 3, 0.0), (["1", "2", "3", "4"], 1.25), (["5.55"], 0.0), ([], None)],
)
def test_population_variance(spark, amounts, expected):
    assert variance_of(spark, amounts) == expected


@pytest.mark.parametrize(
    "amounts",
    [
        ["9000000000000000.01"] * 150 + ["9000000000000000.00"] * 150,
        ["9999999.99", "10000000.00"] * 20,
        ["-9000000000000000", "9000000000000000", "0.01", "-0.01"],
        ["-3.50", "2.25", "-10000000.01"],
        ["9999999999999999.99", "-9999999999999999.99"] * 200,
    ],
)
def test_population_variance_of_large_amounts(spark, amounts):
    exact = [Fraction(a) for a in amounts]
    mean = sum(exact) / len(exact)
    expected = sum((a - mean) ** 2 for a in exact) / len(exact)
    assert variance_of(spark, amounts) == pytest.approx(float(expected), rel=1e-14)


def test_population_variance_of_very_large_groups(spark):
    """10^12 amounts of 99999999.00 and as many of 99999999.02, by their sums."""
    n, units = 10**12, (9999999900, 9999999902)
    parts = [divmod(u, 10**9) for u in units]
    sums = [n * sum(f(h, low) for h, low in parts) for f in (
        lambda h, low: h, lambda h, low: low, lambda h, low: h * h, lambda h, low: h * low, lambda h, low: low * low)]
    row = spark.createDataFrame(
        [(2 * n, *map(Decimal, sums))], "n bigint, " + ", ".join(f"{c} decimal(38,0)" for c in fn.SQUARE_SUMS)
    )
    variance = fn.population_variance(F.col("n"), {c: F.col(c) for c in fn.SQUARE_SUMS})
    assert row.select(variance).first()[0] == pytest.approx(0.0001, rel=1e-12)


def test_money_says_what_it_changes(column):
    values = ["1.00", "1.005", "1e17", "abc", "", None, "nan", "-2.5", "12345678901234567"]
    expected = [None, "rounded", "out_of_range", "malformed", "missing", "missing", "malformed", None, "out_of_range"]
    assert column(fn.money_fault, values) == expected
    assert column(lambda c: fn.money_fault(c, 3), ["1.005"]) == [None]
