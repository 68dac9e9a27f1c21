"""Column expressions for the scalar rules of the job.

Everything here returns a built-in ``Column`` so it stays inside
whole-stage codegen; there is no Python UDF anywhere in the package.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ON_TIME


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pad2(col: Column | str) -> Column:
    """Prefix a single character with '0'; anything else is left alone.

    Deliberately not ``lpad``: ``lpad('123', 2, '0')`` truncates to '12'.
    """
    c = _c(col)
    return F.when(F.length(c) == 1, F.concat(F.lit("0"), c)).otherwise(c)


def strict_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """``yyyy-MM-dd`` built from three text fields, NULL when not a real date.

    ``try_to_date`` with an explicit pattern rejects short or long fields,
    five-digit years and impossible days such as 2015-02-30; a plain cast
    would accept '2015' or '2015-1-1'.
    """
    text = F.concat_ws("-", _c(year), pad2(month), pad2(day))
    return F.try_to_date(text, "yyyy-MM-dd")


def date_lit(value: _dt.date) -> Column:
    """A DATE literal (also for years before 1900, which ``lit(date)`` rejects)."""
    return F.lit(value.isoformat()).cast("date")


# The rules below are written as SQL expression text over a column name and
# turned into a Column with one ``F.expr`` call: the package builds large
# expressions (the one-pass tally), and composing them call by call through
# the Python API costs thousands of driver round trips per query.

def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def is_on_time_sql(col: str) -> str:
    return f"({_ident(col)} = '{ON_TIME}')"


def is_blank_or_zero_sql(col: str) -> str:
    return f"({_ident(col)} IN ('', '{ON_TIME}'))"


def cause_present_sql(col: str) -> str:
    return f"CASE WHEN {is_blank_or_zero_sql(col)} THEN 0 ELSE 1 END"


def parse_int_sql(expr: str) -> str:
    """SQL: the 32-bit integer written in the text ``expr`` (an SQL
    expression), NULL unless it is an optional sign and ASCII digits."""
    return f"CASE WHEN ({expr}) RLIKE '^[+-]?[0-9]+$' THEN try_cast(({expr}) AS INT) END"


def strict_int_sql(col: str) -> str:
    return parse_int_sql(_ident(col))


def cause_minutes_sql(col: str, what: str) -> str:
    c, parsed = _ident(col), strict_int_sql(col)
    return (
        f"CASE WHEN {is_blank_or_zero_sql(col)} THEN 0 "
        f"WHEN ({parsed}) IS NULL THEN raise_error(concat('not a number of minutes in {what}: [', {c}, ']')) "
        f"ELSE {parsed} END"
    )


def strict_int(col: str) -> Column:
    """Integer text as Java's ``Integer.parseInt`` reads it, else NULL.

    Optional sign and digits only (no blanks, no decimal point), and the
    value must fit in 32 bits.  Independent of the session's ANSI flag.
    """
    return F.expr(strict_int_sql(col))


def cause_minutes(col: str, what: str) -> Column:
    """Minutes of one delay cause: '' and '0' are 0, other text must be an
    integer or the query fails (the job aborts on such a value)."""
    return F.expr(cause_minutes_sql(col, what))


def half_up_percent_sql(part: str, total: str) -> str:
    """SQL of ``part`` as a percentage of ``total`` (both SQL expressions)."""
    return (f"CASE WHEN ({total}) = 0 THEN CAST(0.0 AS DOUBLE) "
            f"ELSE floor(CAST(10000.0 AS DOUBLE) * ({part}) / ({total}) + CAST(0.5 AS DOUBLE)) "
            f"/ CAST(100.0 AS DOUBLE) END")


def half_up_percent(part: str, total: str) -> Column:
    """``part`` as a percentage of ``total`` with two decimals, half up;
    0.0 when the total is 0 (plain division raises under ANSI).
    ``part`` and ``total`` are column names or SQL expressions."""
    return F.expr(half_up_percent_sql(part, total))
