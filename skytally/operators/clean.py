"""Validation and filtering of flight rows (the cleaned-flights frame)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import FLIGHT_COLUMNS
from ..functions import date_lit
from .joins import keep_known


def clean_flights(
    flights: DataFrame,
    airports: DataFrame,
    after: _dt.date | None = None,
) -> DataFrame:
    """Rows with a known origin and destination airport, dated after ``after``.

    ``flights`` carries the 12 flight columns and ``_problem``.  Every row
    is checked before any filter: the check is the first operator above
    the scan, and the airport semi joins sit on top of it, so a malformed
    row fails the query even if its airports are unknown or its date is
    old.  The airline is not checked against its dictionary.
    """
    keep = F.lit(True) if after is None else F.col("flight_date") > date_lit(after)
    checked = flights.where(
        F.when(F.col("_problem").isNotNull(), F.raise_error(F.col("_problem"))).otherwise(keep)
    )
    codes = airports.select("code")
    known = keep_known(keep_known(checked, "origin_airport", codes), "destination_airport", codes)
    return known.select(*FLIGHT_COLUMNS)


def batch_date_range(clean: DataFrame) -> DataFrame:
    """One row ``(first_date, last_date, flights)``; dates are NULL for no rows."""
    return clean.agg(
        F.min("flight_date").alias("first_date"),
        F.max("flight_date").alias("last_date"),
        F.count(F.lit(1)).alias("flights"),
    )


def ontime_departures(clean: DataFrame) -> DataFrame:
    """``(airline, origin_airport, destination_airport)`` of departures with delay exactly '0'."""
    return clean.where(F.col("departure_delay") == "0").select(
        "airline", "origin_airport", "destination_airport"
    )
