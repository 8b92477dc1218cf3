import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from edge_rows import rows
from orderloom.functions import dates, numbers, predicates, text


def values(spark, cells, expression, dtype="string"):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {dtype}")
    return [row[0] for row in frame.orderBy("i").select(expression(F.col("c"))).collect()]


def test_strip_takes_every_white_space(spark):
    cells = [" a ", "\ta\n", " a b　", "\x1ca\x85", "", "  ", None]
    assert values(spark, cells, text.strip) == ["a", "a", "a b", "a", "", "", None]


def test_white_space_is_complete():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_null_tokens_match_whole_untrimmed_cells(spark):
    cells = ["NA", "nan", "", "NULL", " NA ", "Nan", "x", None]
    assert values(spark, cells, text.null_if_token) == [None] * 4 + [" NA ", "Nan", "x", None]


def test_full_name_is_null_if_a_part_is(spark):
    frame = spark.createDataFrame([(" Ann", "Lee\t"), ("Ann", None), (None, "Lee")], "a string, b string")
    assert rows(frame.select(text.full_name(F.col("a"), F.col("b")))) == [("Ann Lee",), (None,), (None,)]


def test_shown_decimal_drops_padding(spark):
    cells = [Decimal("0"), Decimal("-10"), Decimal("-1.5"), Decimal("100.25"), None]
    assert values(spark, cells, text.shown_decimal, "decimal(18,4)") == ["0", "-10", "-1.5", "100.25", "nan"]


def test_whole_numbers(spark):
    cells = ["5", " 7 ", "5.0", "5.5", "1e3", "x", "", None, "99999999999999999999", "-0"]
    assert values(spark, cells, numbers.to_whole) == [5, 7, 5, None, 1000, None, None, None, None, 0]


def test_line_amount_cases(spark):
    frame = spark.createDataFrame(
        [(True, Decimal("10.5"), 2), (True, None, 2), (False, None, 2), (False, None, None), (True, Decimal("1"), None)],
        "m boolean, p decimal(18,4), q bigint",
    )
    found = rows(frame.select(numbers.line_amount(F.col("m"), F.col("p"), F.col("q"))))
    assert found == [(Decimal("21.0000"),), (None,), (Decimal("0.0000"),), (None,), (None,)]


def test_rounding_is_half_away_from_zero(spark):
    cells = [Decimal("1.005"), Decimal("-1.005"), Decimal("2.675"), None]
    assert values(spark, cells, numbers.rounded, "decimal(18,4)") == [1.01, -1.01, 2.68, None]


def test_percent(spark):
    frame = spark.createDataFrame([(8, 20), (1, 6), (333, 2000), (1, 3)], "n bigint, t bigint")
    assert rows(frame.select(numbers.percent_of(F.col("n"), F.col("t")))) == [(40.0,), (16.7,), (16.7,), (33.3,)]


def test_parse_date(spark):
    cells = ["2021-01-05", "2021-1-5", " 2021-01-05\t", "2021-02-30", "2021-13-01", "x", "", None]
    day = datetime.date(2021, 1, 5)
    found = values(spark, cells, lambda c: dates.parse_date(c, ["yyyy-M-d"]))
    assert found == [day, day, day] + [None] * 5


def test_times_of_day_are_dropped(spark):
    cells = ["2021-01-05 10:00:00", "2021-1-5T23:59", "2021-01-05T10:00:00.123Z", "2021-01-05 00:00:00+09:00"]
    found = values(spark, cells, lambda c: dates.parse_date(c, ["yyyy-M-d"]))
    assert found == [datetime.date(2021, 1, 5)] * 4


def test_far_dates_are_dates(spark):
    cells = ["1677-09-21", "2262-04-12", "9999-12-31", "0001-01-01"]
    found = values(spark, cells, lambda c: dates.parse_date(c, ["yyyy-M-d"]))
    assert found == [datetime.date.fromisoformat(cell) for cell in cells]


def test_a_line_too_large_has_no_amount(spark):
    frame = spark.sql("SELECT CAST(99999999999999 AS DECIMAL(18,4)) AS price, 9000000000000000000L AS quantity")
    assert rows(frame.select(numbers.line_amount(F.lit(True), F.col("price"), F.col("quantity")))) == [(None,)]


def test_more_date_formats(spark):
    cells = ["2021-01-05", "05/01/2021", "2021-01-05 10:11:12"]
    formats = ["yyyy-M-d", "d/M/yyyy", "yyyy-M-d HH:mm:ss"]
    found = values(spark, cells, lambda c: dates.parse_date(c, formats))
    assert found == [datetime.date(2021, 1, 5)] * 3


def test_date_parts(spark):
    frame = spark.sql("SELECT DATE'2021-01-27' AS d")
    assert rows(frame.select(*dates.date_parts(F.col("d")))) == [
        (20210127, datetime.date(2021, 1, 27), 2021, 1, 27, 1, "January", "Wednesday")
    ]


@pytest.mark.parametrize(
    "predicate, dtype, cells, expected",
    [
        (predicates.is_blank, "string", ["", " \t", None, "x"], [True, True, True, False]),
        (predicates.is_empty, "string", ["", " ", None, "x"], [True, False, True, False]),
        (predicates.not_positive, "int", [0, -1, None, 1], [True, True, True, False]),
        (predicates.negative_or_null, "int", [0, -1, None, 1], [False, True, True, False]),
        (lambda c: predicates.not_listed_or_null(c, ["a"]), "string", ["a", "b", None], [False, True, True]),
        (lambda c: predicates.not_listed(c, ["a"]), "string", ["a", "b", None], [False, True, False]),
    ],
)
def test_predicates(spark, predicate, dtype, cells, expected):
    assert values(spark, cells, predicate, dtype) == expected


def test_whole_numbers_of_odd_texts(spark):
    cells = ["many", "2.5", "5.0", "1e3", "+7", " 8\t", "1-", "--1", "0x5", "5d", "1 2", "٣", "9" * 30, " -4 ", "."]
    wanted = [None, None, 5, 1000, 7, 8, None, None, None, None, None, 3, None, -4, None]
    assert values(spark, cells, numbers.to_whole) == wanted


def test_a_format_reads_only_texts_with_its_marks(spark):
    cells = ["1995-03-04", "03/04/1995", "1995-3-4 10:11", "4.3.1995", "no-date", "19950304", None]
    formats = ["yyyy-M-d", "M/d/yyyy", "yyyyMMdd"]
    found = values(spark, cells, lambda c: dates.parse_date(c, formats))
    day, other = datetime.date(1995, 3, 4), None
    assert found == [day, day, day, other, other, day, None]
