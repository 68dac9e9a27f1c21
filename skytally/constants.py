"""Names and fixed values shared by the whole package."""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as they are for results to match the
# original job: the raw flight line layout (zero-based field positions after
# splitting on ','), the delay-cause labels and their output order, and the
# mark used when nothing was processed yet.
# ---------------------------------------------------------------------------
MIN_FIELDS = 31
FIELD_POSITIONS = {
    "year": 0,
    "month": 1,
    "day": 2,
    "week_day": 3,
    "airline": 4,
    "origin_airport": 7,
    "destination_airport": 8,
    "departure_delay": 11,
    "arrival_delay": 22,
    "air_system_delay": 26,
    "security_delay": 27,
    "airline_delay": 28,
    "late_aircraft_delay": 29,
    "weather_delay": 30,
}
DELAY_REASONS = [
    ("air_system_delay", "AIR_SYSTEM_DELAY"),
    ("security_delay", "SECURITY_DELAY"),
    ("airline_delay", "AIRLINE_DELAY"),
    ("late_aircraft_delay", "LATE_AIRCRAFT_DELAY"),
    ("weather_delay", "WEATHER_DELAY"),
]
NOTHING_PROCESSED = _dt.date(1, 1, 1)
ON_TIME = "0"
TOP_K = 10
# ---------------------------------------------------------------------------

# Columns of a cleaned flight frame, in order.
FLIGHT_COLUMNS = [
    "flight_date",
    "week_day",
    "airline",
    "origin_airport",
    "destination_airport",
    "departure_delay",
    "arrival_delay",
    *[c for c, _ in DELAY_REASONS],
]

# Metric ids used as the ``metric`` column of the long counts/state frame
# ``(metric string, k1 string, k2 string, n bigint)``.
DEPARTURES_BY_ORIGIN = "departures_by_origin"          # k1 = origin
ONTIME_BY_AIRLINE = "ontime_by_airline"                # k1 = airline
ONTIME_BY_ORIGIN_AIRLINE = "ontime_by_origin_airline"  # k1 = origin, k2 = airline
ONTIME_BY_ORIGIN_DEST = "ontime_by_origin_destination" # k1 = origin, k2 = destination
ONTIME_ARRIVALS_BY_WEEKDAY = "ontime_arrivals_by_weekday"  # k1 = week day code
REASON_COUNT = "delay_reason_count"                    # k1 = reason label
REASON_MINUTES = "delay_reason_minutes"                # k1 = reason label
BATCH = "__batch__"                                    # k1 = rows / first_day / last_day

STATE_SCHEMA = "metric STRING, k1 STRING, k2 STRING, n BIGINT"

# Names of the published metric tables of a run (one folder each).
METRIC_NAMES = [
    "top_airports",
    "top_airlines",
    "top_carriers_per_origin",
    "top_destinations_per_origin",
    "weekdays_by_ontime",
    "delay_reason_counts",
    "delay_reason_percent",
    "delay_reason_minutes",
]

# Columns of the published metric tables.
METRIC_SCHEMAS = {
    "top_airports": "rank BIGINT, airport_code STRING, airport STRING, flights BIGINT",
    "top_airlines": "rank BIGINT, airline_code STRING, airline STRING, ontime_flights BIGINT",
    "top_carriers_per_origin":
        "origin_code STRING, origin STRING, rank BIGINT, airline_code STRING, airline STRING, ontime_departures BIGINT",
    "top_destinations_per_origin":
        "origin_code STRING, origin STRING, rank BIGINT, destination_code STRING, destination STRING, ontime_departures BIGINT",
    "weekdays_by_ontime": "rank BIGINT, week_day STRING, ontime_arrivals BIGINT",
    "delay_reason_counts": "reason_id INT, reason STRING, flights BIGINT",
    "delay_reason_percent": "reason_id INT, reason STRING, percent DOUBLE",
    "delay_reason_minutes": "reason_id INT, reason STRING, minutes BIGINT",
}
