from .scalars import (
    cause_minutes,
    cause_minutes_sql,
    cause_present_sql,
    date_lit,
    half_up_percent,
    half_up_percent_sql,
    is_blank_or_zero_sql,
    is_on_time_sql,
    pad2,
    parse_int_sql,
    strict_date,
    strict_int,
    strict_int_sql,
)

__all__ = [
    "cause_minutes",
    "cause_minutes_sql",
    "cause_present_sql",
    "date_lit",
    "half_up_percent",
    "half_up_percent_sql",
    "is_blank_or_zero_sql",
    "is_on_time_sql",
    "pad2",
    "parse_int_sql",
    "strict_date",
    "strict_int",
    "strict_int_sql",
]
