"""Independent SQL (DuckDB dialect) for every named query of ``catalogue``.

Written from the rules of the job, not from the Spark code: each text
starts from the same flights view over the provided tables and computes
the expected result directly (one-shot counts stand in for the results
of incremental runs).
"""

from __future__ import annotations

from ..constants import DELAY_REASONS

MARK = "DATE '1999-12-31'"
LATE_FROM = "DATE '1999-07-01'"
AFTER_ALL = "DATE '2100-01-01'"

_BASE = """flights AS (
  SELECT CAST(l_shipdate AS DATE) AS flight_date,
    CAST(isodow(l_shipdate) AS VARCHAR) AS week_day,
    CAST(l_suppkey AS VARCHAR) AS airline,
    CAST(c_nationkey AS VARCHAR) AS origin_airport,
    CAST(s_nationkey AS VARCHAR) AS destination_airport,
    CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(CAST(l_quantity AS INT) % 4 - 1 AS VARCHAR) END AS departure_delay,
    CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey % 3 - 1 AS VARCHAR) END AS arrival_delay,
    CASE WHEN l_returnflag <> 'R' THEN '' ELSE CAST(l_partkey % 4 * 5 AS VARCHAR) END AS air_system_delay,
    CASE WHEN l_returnflag <> 'R' THEN '' ELSE CAST(CASE WHEN l_partkey % 10 = 0 THEN 7 ELSE 0 END AS VARCHAR) END AS security_delay,
    CASE WHEN l_returnflag <> 'R' THEN '' ELSE CAST(l_suppkey % 3 * 4 AS VARCHAR) END AS airline_delay,
    CASE WHEN l_returnflag <> 'R' THEN '' ELSE CAST(CAST(l_quantity AS INT) % 6 AS VARCHAR) END AS late_aircraft_delay,
    CASE WHEN l_returnflag <> 'R' OR l_linestatus = 'O' THEN '' ELSE CAST(l_partkey % 2 * 9 AS VARCHAR) END AS weather_delay
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
airports_d AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation WHERE n_regionkey <> 4),
airlines_d AS (SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name FROM supplier WHERE s_suppkey % 10 <> 3),
clean AS (
  SELECT * FROM flights
  WHERE origin_airport IN (SELECT code FROM airports_d)
    AND destination_airport IN (SELECT code FROM airports_d))"""


# Dates leave the cross-engine checks as ISO text (see catalogue._dates_as_text).
_AS_TEXT = "* REPLACE (CAST(flight_date AS VARCHAR) AS flight_date)"


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join([_BASE, *ctes]) + "\n" + body


def _minutes(c: str) -> str:
    return f"CASE WHEN {c} IN ('', '0') THEN 0 ELSE CAST({c} AS INTEGER) END"


def _totals(where: str = "TRUE") -> str:
    cols = []
    for i, (c, _) in enumerate(DELAY_REASONS, 1):
        cols.append(f"CAST(count(*) FILTER (WHERE {c} NOT IN ('', '0')) AS BIGINT) AS c{i}")
        cols.append(f"CAST(coalesce(sum({_minutes(c)}), 0) AS BIGINT) AS m{i}")
    return f"t AS (SELECT {', '.join(cols)} FROM clean WHERE {where})"


def _reason_rows(value: str, name: str) -> str:
    """UNION ALL of five rows from ``t``; ``value`` uses {i} for the cause number."""
    parts = [
        f"SELECT {i} AS reason_id, '{label}' AS reason, {value.format(i=i)} AS {name} FROM t"
        for i, (_, label) in enumerate(DELAY_REASONS, 1)
    ]
    return "\nUNION ALL ".join(parts)


_TOTAL = "(m1 + m2 + m3 + m4 + m5)"
_PERCENT = (f"CAST(CASE WHEN {_TOTAL} = 0 THEN 0.0 "
            f"ELSE floor(CAST(10000.0 AS DOUBLE) * m{{i}} / {_TOTAL} + 0.5) / 100.0 END AS DOUBLE)")


def _long_counts(where: str = "TRUE") -> str:
    """One-shot counts of every metric in the state layout (metric, k1, k2, n)."""
    c = f"FROM clean WHERE {where}"
    parts = [
        f"SELECT 'departures_by_origin' AS metric, origin_airport AS k1, '' AS k2, count(*) AS n {c} GROUP BY 2",
        f"SELECT 'ontime_by_airline', airline, '', count(*) {c} AND departure_delay = '0' AND arrival_delay = '0' GROUP BY 2",
        f"SELECT 'ontime_by_origin_airline', origin_airport, airline, count(*) {c} AND departure_delay = '0' GROUP BY 2, 3",
        f"SELECT 'ontime_by_origin_destination', origin_airport, destination_airport, count(*) {c} AND departure_delay = '0' GROUP BY 2, 3",
        f"SELECT 'ontime_arrivals_by_weekday', week_day, '', count(*) {c} AND arrival_delay = '0' GROUP BY 2",
    ]
    for col, label in DELAY_REASONS:
        parts.append(f"SELECT 'delay_reason_count', '{label}', '', count(*) FILTER (WHERE {col} NOT IN ('', '0')) {c}")
    for col, label in DELAY_REASONS:
        parts.append(f"SELECT 'delay_reason_minutes', '{label}', '', CAST(coalesce(sum({_minutes(col)}), 0) AS BIGINT) {c}")
    return "\nUNION ALL ".join(parts)


def _top_global(count_sql: str, key: str, value: str, dictionary: str, name: str, desc: bool,
                p: str = "") -> tuple[list[str], str]:
    """CTEs and body of a global top-10 with names looked up after the cut."""
    order = f"{value} {'DESC' if desc else 'ASC'}, {key}"
    ctes = [f"{p}c AS ({count_sql})",
            f"{p}r AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM {p}c)"]
    body = (f"SELECT r.rank, r.{key}, d.name AS {name}, r.{value} FROM {p}r r "
            f"JOIN {dictionary} d ON d.code = r.{key} WHERE r.rank <= 10")
    return ctes, body


def _top_airports(desc: bool, p: str = "") -> tuple[list[str], str]:
    return _top_global("SELECT origin_airport AS airport_code, count(*) AS flights FROM clean GROUP BY 1",
                       "airport_code", "flights", "airports_d", "airport", desc, p)


def _top_airlines(desc: bool, p: str = "") -> tuple[list[str], str]:
    return _top_global("SELECT airline AS airline_code, count(*) AS ontime_flights FROM clean "
                       "WHERE departure_delay = '0' AND arrival_delay = '0' GROUP BY 1",
                       "airline_code", "ontime_flights", "airlines_d", "airline", desc, p)


def _top_per_origin(partner: str, partner_col: str, dictionary: str, desc: bool, p: str = "",
                    select: str | None = None) -> tuple[list[str], str]:
    """CTEs and body of a per-origin top-10 (origin and partner names looked up after the cut)."""
    order = f"ontime_departures {'DESC' if desc else 'ASC'}, {partner}_code"
    ctes = [
        f"{p}c AS (SELECT origin_airport AS origin_code, {partner_col} AS {partner}_code, "
        f"count(*) AS ontime_departures FROM clean WHERE departure_delay = '0' GROUP BY 1, 2)",
        f"{p}r AS (SELECT *, row_number() OVER (PARTITION BY origin_code ORDER BY {order}) AS rank FROM {p}c)",
    ]
    cols = select or (f"r.origin_code, o.name AS origin, r.rank, r.{partner}_code, p.name AS {partner}, "
                      f"r.ontime_departures")
    body = (f"SELECT {cols} FROM {p}r r JOIN airports_d o ON o.code = r.origin_code "
            f"JOIN {dictionary} p ON p.code = r.{partner}_code WHERE r.rank <= 10")
    return ctes, body


def _weekdays(p: str = "") -> tuple[list[str], str]:
    ctes = [
        f"{p}c AS (SELECT week_day, count(*) AS ontime_arrivals FROM clean WHERE arrival_delay = '0' GROUP BY 1)",
        f"{p}r AS (SELECT *, row_number() OVER (ORDER BY ontime_arrivals DESC, week_day) AS rank FROM {p}c)",
    ]
    return ctes, f"SELECT r.rank, r.week_day, r.ontime_arrivals FROM {p}r r"


def _query(parts: tuple[list[str], str]) -> str:
    ctes, body = parts
    return _with(*ctes, body=body)


def _runs_log() -> str:
    b1 = f"b1 AS (SELECT min(flight_date) AS f, max(flight_date) AS l, count(*) AS n FROM clean WHERE flight_date <= {MARK})"
    b2 = f"b2 AS (SELECT min(flight_date) AS f, max(flight_date) AS l, count(*) AS n FROM clean WHERE flight_date > {MARK})"
    rows = []
    for seq, b in ((1, "b1"), (2, "b2")):
        rows.append(f"SELECT CAST({seq} AS BIGINT) AS seq, 'collected' AS status, "
                    f"'flights from ' || strftime(f, '%Y-%m-%d') || ' to ' || strftime(l, '%Y-%m-%d') AS detail FROM {b}")
        rows.append(f"SELECT CAST({seq} AS BIGINT), 'processed', CAST(n AS VARCHAR) || ' flights' FROM {b}")
    rows.append("SELECT CAST(0 AS BIGINT), 'no_new_data', 'no flights after ' || strftime(l, '%Y-%m-%d') FROM b2")
    return _with(b1, b2, body="\nUNION ALL ".join(rows))


_STACKED = "metric, CAST(rank AS BIGINT) AS rank, key, CAST(n AS BIGINT) AS n"
_LINES = "metric, replace(key, '|', ',') || ',' || CAST(n AS VARCHAR) AS line"


def _full_run_metrics(reverse: bool = False, select: str = _STACKED) -> str:
    """All metric tables of a run, stacked as (metric, rank, key, n); ``reverse``: the four rankings the other way round."""
    metrics = {
        "m1": _top_airports(not reverse, "m1_"),
        "m2": _top_airlines(reverse, "m2_"),
        "m3": _top_per_origin("airline", "airline", "airlines_d", reverse, "m3_"),
        "m4": _top_per_origin("destination", "destination_airport", "airports_d", reverse, "m4_"),
        "m5": _weekdays("m5_"),
    }
    ctes = []
    for name, (parts, body) in metrics.items():
        ctes += parts
        ctes.append(f"{name} AS ({body})")
    ctes.append(_totals())
    rows = [
        "SELECT 'top_airports' AS metric, rank, airport AS key, flights AS n FROM m1",
        "SELECT 'top_airlines', rank, airline, ontime_flights FROM m2",
        "SELECT 'top_carriers_per_origin', rank, origin || '|' || airline, ontime_departures FROM m3",
        "SELECT 'top_destinations_per_origin', rank, origin || '|' || destination, ontime_departures FROM m4",
        "SELECT 'weekdays_by_ontime', rank, week_day, ontime_arrivals FROM m5",
    ]
    for i, (_, label) in enumerate(DELAY_REASONS, 1):
        rows.append(f"SELECT 'delay_reason_counts', {i}, '{label}', c{i} FROM t")
        rows.append(f"SELECT 'delay_reason_minutes', {i}, '{label}', m{i} FROM t")
        rows.append(f"SELECT 'delay_reason_percent', {i}, '{label}', "
                    f"CAST(round({_PERCENT.format(i=i)} * 100) AS BIGINT) FROM t")
    union = "\nUNION ALL ".join(rows)
    return _with(*ctes, body=f"SELECT {select} FROM (\n{union}) x")


def _state_with_batch() -> str:
    rows = _long_counts()
    rows += "\nUNION ALL SELECT '__batch__', 'rows', '', count(*) FROM clean"
    rows += ("\nUNION ALL SELECT '__batch__', 'first_day', '', "
             "CAST(date_diff('day', DATE '1970-01-01', min(flight_date)) AS BIGINT) FROM clean")
    rows += ("\nUNION ALL SELECT '__batch__', 'last_day', '', "
             "CAST(date_diff('day', DATE '1970-01-01', max(flight_date)) AS BIGINT) FROM clean")
    return _with(body=f"SELECT metric, k1, k2, CAST(n AS BIGINT) AS n FROM (\n{rows}) x")


def _long(where: str = "TRUE") -> str:
    return _with(body=f"SELECT metric, k1, k2, CAST(n AS BIGINT) AS n FROM (\n{_long_counts(where)}) x")


ORACLE: dict[str, str] = {
    "clean_flights": _with(body=f"SELECT {_AS_TEXT} FROM clean"),
    "ontime_departures": _with(
        body="SELECT airline, origin_airport, destination_airport FROM clean WHERE departure_delay = '0'"),
    "incremental_filter": _with(body=f"SELECT {_AS_TEXT} FROM clean WHERE flight_date > {MARK}"),
    "batch_date_range": _with(
        body=(f"SELECT CAST(min(flight_date) AS VARCHAR) AS first_date, CAST(max(flight_date) AS VARCHAR) "
              f"AS last_date, count(*) AS flights FROM clean WHERE flight_date > {MARK}")),
    "departures_by_origin": _with(
        body="SELECT origin_airport, count(*) AS flights FROM clean GROUP BY origin_airport"),
    "ontime_count_by_airline": _with(
        body=("SELECT airline, count(*) AS ontime_flights FROM clean "
              "WHERE departure_delay = '0' AND arrival_delay = '0' GROUP BY airline")),
    "ontime_count_by_weekday": _with(
        body="SELECT week_day, count(*) AS ontime_arrivals FROM clean WHERE arrival_delay = '0' GROUP BY week_day"),
    "ontime_by_origin_airline": _with(
        body=("SELECT origin_airport, airline, count(*) AS ontime_departures FROM clean "
              "WHERE departure_delay = '0' GROUP BY origin_airport, airline")),
    "ontime_by_origin_destination": _with(
        body=("SELECT origin_airport, destination_airport, count(*) AS ontime_departures FROM clean "
              "WHERE departure_delay = '0' GROUP BY origin_airport, destination_airport")),
    "top_airports_desc": _query(_top_airports(True)),
    "top_airports_asc": _query(_top_airports(False)),
    "top_airlines_asc": _query(_top_airlines(False)),
    "top_airlines_desc": _query(_top_airlines(True)),
    "top_carriers_per_origin_asc": _query(_top_per_origin("airline", "airline", "airlines_d", False)),
    "top_carriers_per_origin_desc": _query(_top_per_origin("airline", "airline", "airlines_d", True)),
    "top_destinations_per_origin_asc": _query(
        _top_per_origin("destination", "destination_airport", "airports_d", False)),
    "top_destinations_per_origin_desc": _query(
        _top_per_origin("destination", "destination_airport", "airports_d", True)),
    "weekdays_by_ontime": _query(_weekdays()),
    "delay_reason_counts": _with(_totals(), body=_reason_rows("c{i}", "flights")),
    "delay_reason_minutes": _with(_totals(), body=_reason_rows("m{i}", "minutes")),
    "delay_reason_percent": _with(_totals(), body=_reason_rows(_PERCENT, "percent")),
    "delay_percent_empty": _with(_totals(f"flight_date > {AFTER_ALL}"), body=_reason_rows(_PERCENT, "percent")),
    "merge_counts": _long(),
    "merge_reason_totals": _with(
        _totals(),
        body="\nUNION ALL ".join(
            f"SELECT {i} AS reason_id, '{label}' AS reason, c{i} AS flights, m{i} AS minutes FROM t"
            for i, (_, label) in enumerate(DELAY_REASONS, 1))),
    "dictionary_last_wins": (
        "SELECT CAST(n_nationkey AS VARCHAR) AS code, "
        "CASE WHEN n_regionkey = 0 THEN lower(n_name) ELSE n_name END AS name "
        "FROM nation"),
    "dictionary_last_wins_airlines": (
        "SELECT CAST(s_suppkey AS VARCHAR) AS code, "
        "CASE WHEN s_suppkey % 7 = 0 THEN lower(s_name) ELSE s_name END AS name "
        "FROM supplier"),
    "csv_scan_roundtrip": _with(body=f"SELECT {_AS_TEXT} FROM clean"),
    "state_roundtrip": _state_with_batch(),
    "text_state_roundtrip": _long(),
    "metrics_sink_roundtrip": _query(_top_per_origin(
        "airline", "airline", "airlines_d", False,
        select="o.name AS origin, p.name AS airline, r.ontime_departures, r.rank")),
    "incremental_two_batches": _long(),
    "incremental_late_rows_ignored": _long(),
    "incremental_hwm": _with(body=(
        f"SELECT CAST(1 AS BIGINT) AS seq, CAST(min(flight_date) AS VARCHAR) AS first_date, "
        f"CAST(max(flight_date) AS VARCHAR) AS last_date, count(*) AS flights "
        f"FROM clean WHERE flight_date <= {MARK}\n"
        f"UNION ALL SELECT CAST(2 AS BIGINT), CAST(min(flight_date) AS VARCHAR), "
        f"CAST(max(flight_date) AS VARCHAR), count(*) FROM clean WHERE flight_date > {MARK}")),
    "incremental_no_new_data": _long(),
    "publish_ignores_uncommitted": _long(f"flight_date <= {MARK}"),
    "run_log": _runs_log(),
    "full_run_metrics": _full_run_metrics(),
    "full_run_from_text": _full_run_metrics(),
    "full_run_reversed": _full_run_metrics(reverse=True),
    "repeated_dictionary_codes": _full_run_metrics(),
    "metric_lines_all": _full_run_metrics(select=_LINES),
    "stream_two_arrivals": _long(),
    "current_metrics": _full_run_metrics(),
    "exclusive_commit": _long(f"flight_date <= {MARK}"),
    "merge_in_buckets": _long(),
    "reuse_one_scan": f"""SELECT held, metric, k1, k2, n FROM ({_state_with_batch()}) s CROSS JOIN (VALUES ('counts'), ('state')) h(held)""",
    "all_airlines_ranked": _with(
        body=("SELECT row_number() OVER (ORDER BY n DESC, airline) AS rank, airline AS airline_code, n AS ontime_flights FROM ("
              "SELECT airline, count(*) AS n FROM clean WHERE departure_delay = '0' AND arrival_delay = '0' GROUP BY airline)")),
    "unknown_metric_rejected": _with(
        body=("SELECT 'flights_by_airline' AS metric, 'rejected' AS outcome, count(DISTINCT airline) AS n_rows FROM clean "
              "WHERE departure_delay = '0' AND arrival_delay = '0'\n"
              f"UNION ALL SELECT 'delay_reason_counts', 'published', CAST({len(DELAY_REASONS)} AS BIGINT)\n"
              "UNION ALL SELECT 'top_airports', 'published', least(10, count(DISTINCT origin_airport)) FROM clean\n"
              "UNION ALL SELECT 'unknown metric flights_by_airline', 'logged', CAST(1 AS BIGINT)")),
}
