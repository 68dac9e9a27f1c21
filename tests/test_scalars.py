"""Scalar rules: zero padding, strict dates, strict integers, rounding."""

import datetime as dt


from skytally.functions import cause_minutes, half_up_percent, pad2, strict_date, strict_int


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_pad2(spark):
    assert one(spark, pad2("s"), [("1",), ("01",), ("123",), ("",)], "s string") == ["01", "01", "123", ""]


def test_strict_date(spark):
    data = [("2015", "1", "2"), ("2015", "01", "02"), ("2015", "2", "30"), ("2015", "123", "1"),
            ("20150", "1", "1"), ("2015", "1", ""), ("2016", "2", "29"), ("2015", " 1", "1")]
    got = one(spark, strict_date("y", "m", "d"), data, "y string, m string, d string")
    assert got == [dt.date(2015, 1, 2), dt.date(2015, 1, 2), None, None, None, None, dt.date(2016, 2, 29), None]


def test_strict_int_matches_java_parse_int(spark):
    data = [("5",), ("+5",), ("-5",), ("007",), (" 5",), ("5 ",), ("5.0",), ("abc",),
            ("2147483647",), ("2147483648",), ("-2147483648",), ("1e3",), ("\t5",)]
    got = one(spark, strict_int("s"), data, "s string")
    assert got == [5, 5, -5, 7, None, None, None, None, 2147483647, None, -2147483648, None, None]


def test_cause_minutes(spark):
    got = one(spark, cause_minutes("s", "x"), [("",), ("0",), ("15",)], "s string")
    assert got == [0, 0, 15]


def test_half_up_percent(spark):
    data = [(1, 3), (2, 3), (0, 0), (5, 0), (1, 8), (1, 200), (1, 400)]
    got = one(spark, half_up_percent("p", "t"), data, "p bigint, t bigint")
    assert got == [33.33, 66.67, 0.0, 0.0, 12.5, 0.5, 0.25]


def test_date_literal_before_1900(spark):
    from skytally.functions import date_lit
    assert spark.range(1).select(date_lit(dt.date(1, 1, 1))).first()[0] == dt.date(1, 1, 1)
