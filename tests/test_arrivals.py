"""Arrivals in the inbox: files of a bounded number of lines, without one task that reads a fixed share."""

import glob

from pyspark.sql import functions as F

from skytally.constants import FLIGHT_COLUMNS
from skytally.plans.catalogue import write_arrival
from skytally.sources import read_flights_csv


def test_number_of_files_grows_with_the_flights(spark, tmp_path):
    for n in (600, 6000):
        days = F.expr("date_add(DATE '2015-01-01', CAST(id % 20 AS INT))")
        flights = spark.range(n).coalesce(2).select(days.alias("flight_date"), *[F.col("id").cast("string").alias(c) for c in FLIGHT_COLUMNS[1:]])
        inbox = str(tmp_path / f"inbox-{n}")
        write_arrival(flights, inbox, 100)
        sizes = [sum(1 for _ in open(f)) - 1 for f in glob.glob(f"{inbox}/part-*.csv")]  # but for the header
        assert len(sizes) == n // 100 and max(sizes) == 100  # three files before, whatever the flights
        back = read_flights_csv(spark, inbox).select(*FLIGHT_COLUMNS)
        assert back.count() == n and back.exceptAll(flights).isEmpty() and flights.exceptAll(back).isEmpty()
