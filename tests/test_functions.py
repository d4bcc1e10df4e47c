from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.functions import datetime as dt
from clickloom.functions import text
from clickloom.functions.predicates import any_of, equals, number_in
from clickloom.functions.sql import register_sql_functions
from clickloom.operators.counters import count_by_key


@pytest.fixture(scope="module")
def evaluate(spark):
    return lambda column: spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "time, expected",
    [
        ("2017-10-31 20:27:53", datetime.datetime(2017, 10, 31, 20, 27, 53)),
        ("2017-11-10 3:04:05", datetime.datetime(2017, 11, 10, 3, 4, 5)),
        ("2017-11-31 03:04:05", None),
        ("12:30:00", None),
        ("2017-11-10", None),
        ("", None),
        (None, None),
    ],
)
def test_both_parsers(evaluate, time, expected):
    column = F.lit(time).cast("string")
    assert evaluate(dt.parse_time(column).cast("timestamp_ntz")) == expected
    assert evaluate(dt.parse_log_time(column).cast("timestamp_ntz")) == expected


def test_today_and_yesterday_are_the_clocks(evaluate):
    while True:
        day = datetime.datetime.now(datetime.timezone.utc).date()
        found = evaluate(dt.today()), evaluate(dt.yesterday())
        if day == datetime.datetime.now(datetime.timezone.utc).date():  # not over midnight
            break
    assert found == (str(day), str(day - datetime.timedelta(days=1)))


def test_time_arithmetic(evaluate):
    early, late = F.lit("2017-11-10 9:59:58"), F.lit("2017-11-10 10:00:03")
    assert evaluate(dt.before(early, late)) and not evaluate(dt.before(late, late))
    assert evaluate(dt.after(late, early)) and not evaluate(dt.after(late, late))
    assert evaluate(dt.minus_seconds(late, early)) == 5
    assert evaluate(dt.minus_seconds(early, late)) == -5
    assert evaluate(dt.date_hour(early)) == "2017-11-10_09"


@pytest.mark.parametrize(
    "value, expected", [("a", False), ("", True), (None, True)]
)
def test_is_empty(evaluate, value, expected):
    column = F.lit(value).cast("string")
    assert evaluate(text.is_empty(column)) is expected
    assert evaluate(text.is_not_empty(column)) is not expected


@pytest.mark.parametrize(
    "value, expected", [("a,b,", "a,b"), (",a", "a"), (",a,", "a"), ("a,b", "a,b"), (",", "")]
)
def test_trim_comma(evaluate, value, expected):
    assert evaluate(text.trim_comma(F.lit(value))) == expected


@pytest.mark.parametrize("value, expected", [("5", "05"), ("15", "15"), ("0", "00")])
def test_two_digits(evaluate, value, expected):
    assert evaluate(text.two_digits(F.lit(value))) == expected


@pytest.mark.parametrize(
    "field, expected", [("a", "1"), ("b", None), ("c", "x,y"), ("d", None), ("e", None)]
)
def test_packed_field(evaluate, field, expected):
    assert evaluate(text.packed_field(F.lit("a=1|b=|c=x,y|e=1=2"), field)) == expected


def test_with_packed_field(evaluate):
    packed = F.lit("a=1|ab=2")
    assert evaluate(text.with_packed_field(packed, "a", F.lit("9"))) == "a=9|ab=2"
    assert evaluate(text.with_packed_field(packed, "z", F.lit("9"))) == "a=1|ab=2"


def test_json_field_takes_a_bare_name(evaluate):
    assert evaluate(text.json_field(F.lit('{"product_status": 0}'), "product_status")) == "0"


@pytest.mark.parametrize("n, total, expected", [(29, 200, 0.15), (1, 3, 0.33), (5, 1000, 0.01)])
def test_rounds_half_up(evaluate, n, total, expected):
    assert evaluate(text.round_half_up(F.lit(n) / F.lit(total))) == expected


@pytest.mark.parametrize(
    "value, wanted, expected",
    [
        ("a", [], True),
        ("a", ["a", "b"], True),
        ("a,b", ["b"], True),
        ("ab", ["a"], False),
        ("-1", ["-1"], False),
        ("-1,a", ["-1"], True),
    ],
)
def test_any_of(evaluate, value, wanted, expected):
    assert evaluate(any_of(F.lit(value), wanted)) is expected


def test_number_and_text_predicates(evaluate):
    assert evaluate(number_in(F.lit(20), 20, 50)) and evaluate(number_in(F.lit(50), 20, 50))
    assert not evaluate(number_in(F.lit(51), 20, 50))
    assert evaluate(number_in(F.lit(51), 20, None))
    assert evaluate(equals(F.lit("male"), "")) and not evaluate(equals(F.lit("male"), "female"))


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        """SELECT concat_long_string(7L, 'x', ':') AS a, json_field('{"k": 1}', 'k') AS b"""
    ).first()
    assert tuple(row) == ("7:x", "1")


def test_keyed_counter(spark):
    keys = ["pear"] * 5 + ["fig"] + ["", "plum", "pear", ""]
    frame = spark.createDataFrame([(key,) for key in keys], "k string")
    got = {row.key: row["count"] for row in count_by_key(frame, "k").collect()}
    assert got == {"pear": 6, "fig": 1, "": 2, "plum": 1}
