from .tables import airlines_from_tables, airports_from_tables, flights_from_tables, table
from .text import (
    parse_dictionary_lines,
    parse_flight_lines,
    read_dictionary_csv,
    read_flights_csv,
    read_lines,
    stream_lines,
)

__all__ = [
    "airlines_from_tables",
    "airports_from_tables",
    "flights_from_tables",
    "parse_dictionary_lines",
    "parse_flight_lines",
    "read_dictionary_csv",
    "read_flights_csv",
    "read_lines",
    "stream_lines",
    "table",
]
