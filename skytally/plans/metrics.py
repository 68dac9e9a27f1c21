"""The seven metrics, each built from counts of the form ``(k1, k2, n)``.

The counts may come straight from flights (``metric_counts``) or from the
cumulative state (``slice_metric``); the metric code is the same.  Names
are looked up after the cut, with an inner join, so an unknown code
removes its row and a ranking can return fewer than k rows; ranks keep
their gaps.  Grouping is always by code, never by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DELAY_REASONS,
    DEPARTURES_BY_ORIGIN,
    ONTIME_ARRIVALS_BY_WEEKDAY,
    ONTIME_BY_AIRLINE,
    ONTIME_BY_ORIGIN_AIRLINE,
    ONTIME_BY_ORIGIN_DEST,
    TOP_K,
)
from ..functions import half_up_percent_sql
from ..operators import lookup_name, rank_all, reason_rows, reasons_from_counts, slice_metric, top_k, top_k_per_group


def top_airports(origin_counts: DataFrame, airports: DataFrame, ascending: bool = False,
                 k: int = TOP_K) -> DataFrame:
    """M1: airports by number of departures (origin only); default descending.

    Output ``rank, airport_code, airport, flights``.
    """
    c = origin_counts.select(F.col("k1").alias("airport_code"), F.col("n").alias("flights"))
    ranked = top_k(c, "flights", "airport_code", k, ascending)
    out = lookup_name(ranked, airports, "airport_code", "airport")
    return out.select("rank", "airport_code", "airport", "flights")


def top_airlines(airline_counts: DataFrame, airlines: DataFrame, ascending: bool = True,
                 k: int = TOP_K) -> DataFrame:
    """M2: airlines by flights with departure and arrival delay both '0';
    default ascending.  Output ``rank, airline_code, airline, ontime_flights``."""
    c = airline_counts.select(F.col("k1").alias("airline_code"), F.col("n").alias("ontime_flights"))
    ranked = top_k(c, "ontime_flights", "airline_code", k, ascending)
    out = lookup_name(ranked, airlines, "airline_code", "airline")
    return out.select("rank", "airline_code", "airline", "ontime_flights")


def top_carriers_per_origin(pair_counts: DataFrame, airports: DataFrame, airlines: DataFrame,
                            ascending: bool = True, k: int = TOP_K) -> DataFrame:
    """M3: per origin airport, airlines by departures with delay '0';
    default ascending.  Output ``origin_code, origin, rank, airline_code,
    airline, ontime_departures``."""
    c = pair_counts.select(
        F.col("k1").alias("origin_code"), F.col("k2").alias("airline_code"),
        F.col("n").alias("ontime_departures"),
    )
    ranked = top_k_per_group(c, "origin_code", "ontime_departures", "airline_code", k, ascending)
    named = lookup_name(lookup_name(ranked, airports, "origin_code", "origin"), airlines, "airline_code", "airline")
    return named.select("origin_code", "origin", "rank", "airline_code", "airline", "ontime_departures")


def top_destinations_per_origin(pair_counts: DataFrame, airports: DataFrame, ascending: bool = True,
                                k: int = TOP_K) -> DataFrame:
    """M4: per origin airport, destinations by departures with delay '0';
    default ascending.  The airport dictionary is used in both roles.
    Output ``origin_code, origin, rank, destination_code, destination,
    ontime_departures``."""
    c = pair_counts.select(
        F.col("k1").alias("origin_code"), F.col("k2").alias("destination_code"),
        F.col("n").alias("ontime_departures"),
    )
    ranked = top_k_per_group(c, "origin_code", "ontime_departures", "destination_code", k, ascending)
    named = lookup_name(
        lookup_name(ranked, airports, "origin_code", "origin"), airports, "destination_code", "destination"
    )
    return named.select("origin_code", "origin", "rank", "destination_code", "destination", "ontime_departures")


def weekdays_by_ontime(weekday_counts: DataFrame, folder: str | None = None) -> DataFrame:
    """M5: week days by number of arrivals with delay '0', most first; the
    code is not translated and days without any are absent.  ``folder``: where
    the ordered rows are written (see ``rank_all``).
    Output ``rank, week_day, ontime_arrivals``."""
    c = weekday_counts.select(F.col("k1").alias("week_day"), F.col("n").alias("ontime_arrivals"))
    return rank_all(c, "ontime_arrivals", "week_day", ascending=False, folder=folder).select(
        "rank", "week_day", "ontime_arrivals"
    )


def delay_reason_counts(totals: DataFrame) -> DataFrame:
    """M6: per cause, flights where it is neither '' nor '0'.
    ``totals`` is the one-row frame of ``reason_totals``/``reasons_from_counts``.
    Output ``reason_id, reason, flights`` in the fixed cause order."""
    return reason_rows(totals, "c_", "flights")


def delay_reason_minutes(totals: DataFrame) -> DataFrame:
    """M7 (minutes): per cause, total minutes.  Output ``reason_id, reason, minutes``."""
    return reason_rows(totals, "m_", "minutes")


def delay_reason_percent(totals: DataFrame) -> DataFrame:
    """M7: per cause, its share of all cause minutes in percent, two
    decimals rounded half up; 0.0 everywhere when there are no minutes.
    The five values need not add up to 100.  Output ``reason_id, reason, percent``."""
    total = " + ".join(f"m_{col}" for col, _ in DELAY_REASONS)
    shares = totals.selectExpr(*[
        f"{half_up_percent_sql(f'm_{col}', total)} AS p_{col}" for col, _ in DELAY_REASONS
    ])
    return reason_rows(shares, "p_", "percent", value_type="DOUBLE")


# ---------------------------------------------------------------------------
# All tables of a run at once
# ---------------------------------------------------------------------------

#: Of each ranking: the counts it ranks, whether it ranks within k1, the dictionary and the published
#: columns (code, name) of k1 and k2, and the published column of the count.
_RANKINGS = {
    "top_airports": (DEPARTURES_BY_ORIGIN, False, ("airports", "airport_code", "airport"), None, "flights"),
    "top_airlines": (ONTIME_BY_AIRLINE, False, ("airlines", "airline_code", "airline"), None, "ontime_flights"),
    "top_carriers_per_origin": (ONTIME_BY_ORIGIN_AIRLINE, True, ("airports", "origin_code", "origin"),
                                ("airlines", "airline_code", "airline"), "ontime_departures"),
    "top_destinations_per_origin": (ONTIME_BY_ORIGIN_DEST, True, ("airports", "origin_code", "origin"),
                                    ("airports", "destination_code", "destination"), "ontime_departures"),
}


def _choose(column: str, cases: dict[str, str]) -> str:
    """SQL: the value that ``cases`` has for ``column``, NULL if none."""
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in cases.items()) + " END"


def ranking_rows(state: DataFrame, dictionaries: DataFrame, ascending: dict[str, bool], k: int = TOP_K) -> DataFrame:
    """M1 to M4 as one frame ``metric, rank, <the columns of all four>``.

    One window over all rankings (its key is the ranking and, where it ranks per
    origin, the origin), with the partial top-k before its shuffle, and one look-up of
    ``dictionaries`` (kind, code, name) per key column for all of them.
    """
    names = {counts: table for table, (counts, *_) in _RANKINGS.items()}
    rows = state.where(F.col("metric").isin(*names)).selectExpr(f"{_choose('metric', {c: repr(t) for c, t in names.items()})} AS metric", "k1", "k2", "n")
    per_k1 = ", ".join(repr(t) for t, r in _RANKINGS.items() if r[1])
    up = ", ".join(repr(t) for t in _RANKINGS if ascending[t]) or "''"
    rows = rows.selectExpr("*", f"CASE WHEN metric IN ({per_k1}) THEN k1 ELSE '' END AS grp",
                           f"CASE WHEN metric IN ({per_k1}) THEN k2 ELSE k1 END AS tie", f"CASE WHEN metric IN ({up}) THEN n ELSE -n END AS score")
    best = top_k_per_group(rows, ["metric", "grp"], "score", "tie", k, True)
    best = best.selectExpr("metric", "rank", "k1", "k2", "n", *[
        f"{_choose('metric', {t: repr(r[i][0]) for t, r in _RANKINGS.items() if r[i]})} AS {kind}" for i, kind in ((2, "kind1"), (3, "kind2"))])
    d = dictionaries.select("kind", "code", "name")
    first, second = (d.select(F.col("kind").alias(f"kind{i}"), F.col("code").alias(f"k{i}"), F.col("name").alias(f"name{i}")) for i in (1, 2))
    named = best.join(first, ["kind1", "k1"]).join(second, ["kind2", "k2"], "left").where("kind2 IS NULL OR name2 IS NOT NULL")
    columns: dict[str, dict[str, str]] = {}
    for t, (_, _, one, two, value) in _RANKINGS.items():
        for i, key in ((1, one), (2, two)):
            if key:
                columns.setdefault(key[1], {})[t] = f"k{i}"
                columns.setdefault(key[2], {})[t] = f"name{i}"
        columns.setdefault(value, {})[t] = "n"
    return named.selectExpr("metric", "rank", *[f"{_choose('metric', cases)} AS {c}" for c, cases in columns.items()])


def published_rows(state: DataFrame, dictionaries: DataFrame, ascending: dict[str, bool], k: int, folder: str) -> DataFrame:
    """All published tables of a run as one frame, told apart by ``metric`` (NULL where a table lacks a column).

    ``state`` is read three times (rankings, week days, causes), each time with its own few shuffles of
    groups; ``folder`` takes the ordered week days.
    """
    totals = reasons_from_counts(state)
    parts = [
        ranking_rows(state, dictionaries, ascending, k),
        weekdays_by_ontime(slice_metric(state, ONTIME_ARRIVALS_BY_WEEKDAY), folder).select(F.lit("weekdays_by_ontime").alias("metric"), "*"),
    ]
    counts, minutes, percent = delay_reason_counts(totals), delay_reason_minutes(totals), delay_reason_percent(totals)
    for name, df in (("delay_reason_counts", counts), ("delay_reason_minutes", minutes), ("delay_reason_percent", percent)):
        parts.append(df.select(F.lit(name).alias("metric"), "*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
