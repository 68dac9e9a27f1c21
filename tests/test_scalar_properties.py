"""Property tests: the strict text rules against a plain-Python model.

The model follows the original job's parsing: ``Integer.parseInt`` (optional
sign, ASCII digits, 32-bit range) for delay minutes, and an ISO
``yyyy-MM-dd`` date after zero-padding one-character month and day.
"""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from skytally.functions import strict_date, strict_int

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def parse_int_model(s: str):
    if not re.fullmatch(r"[+-]?[0-9]+", s):
        return None
    v = int(s)
    return v if INT_MIN <= v <= INT_MAX else None


def date_model(y: str, m: str, d: str):
    m = "0" + m if len(m) == 1 else m
    d = "0" + d if len(d) == 1 else d
    text = f"{y}-{m}-{d}"
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", text):
        return None
    try:
        return dt.date(int(text[:4]), int(text[5:7]), int(text[8:]))
    except ValueError:
        return None


int_text = st.one_of(
    st.integers(min_value=-(2 ** 33), max_value=2 ** 33).map(str),
    st.integers(min_value=0, max_value=10 ** 6).map(lambda v: "+" + str(v)),
    st.integers(min_value=0, max_value=999).map(lambda v: "00" + str(v)),
    st.text(alphabet="0123456789+-. eE\t", max_size=6),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(int_text, min_size=1, max_size=40))
def test_strict_int(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(strict_int("s")).collect()]
    assert got == [parse_int_model(v) for v in values]


part = st.one_of(
    st.integers(min_value=0, max_value=40).map(str),
    st.integers(min_value=0, max_value=9).map(lambda v: "0" + str(v)),
    st.text(alphabet="0123456789 -", max_size=3),
)
year = st.one_of(st.integers(min_value=1000, max_value=9999).map(str), st.text(alphabet="0123456789", max_size=5))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(year, part, part), min_size=1, max_size=40))
def test_strict_date(spark, triples):
    triples = [t for t in triples if not t[0].startswith("0") or len(t[0]) != 4]  # year 0xxx: calendar edge
    if not triples:
        return
    df = spark.createDataFrame(triples, "y string, m string, d string")
    got = [r[0] for r in df.select(strict_date("y", "m", "d")).collect()]
    assert got == [date_model(*t) for t in triples]
