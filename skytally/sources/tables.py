"""Flights and dictionaries derived from the star-schema test tables.

There is no flights table among the provided parquet tables, so a
flights view is derived from ``lineitem ⋈ orders ⋈ customer ⋈ supplier``
(one flight per line item).  The mapping is a fixed convention shared
with the SQL oracle in ``plans/oracle.py``: ship date -> flight date,
ISO weekday -> week day, supplier -> airline, customer nation -> origin,
supplier nation -> destination, and small arithmetic on keys for the
delay fields, with some delays left empty so every branch has work.

The joins are plain equi-joins: Catalyst prunes every table to the
columns used, and picks broadcast or sort-merge per join from the scan
statistics (AQE re-plans at run time).  Nothing is hinted here because
every side of these joins grows with the scale factor.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _text(c: Column) -> Column:
    return c.cast("string")


def flights_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights view: 12 flight columns plus an always-NULL ``_problem``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    # The flight fields as SQL over the joined columns (one expression each).
    no_cause = "l_returnflag <> 'R'"
    return j.selectExpr(
        "CAST(l_shipdate AS DATE) AS flight_date",
        "CAST(weekday(l_shipdate) + 1 AS STRING) AS week_day",
        "CAST(l_suppkey AS STRING) AS airline",
        "CAST(c_nationkey AS STRING) AS origin_airport",
        "CAST(s_nationkey AS STRING) AS destination_airport",
        "CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(CAST(l_quantity AS INT) % 4 - 1 AS STRING) END"
        " AS departure_delay",
        "CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey % 3 - 1 AS STRING) END AS arrival_delay",
        f"CASE WHEN {no_cause} THEN '' ELSE CAST(l_partkey % 4 * 5 AS STRING) END AS air_system_delay",
        f"CASE WHEN {no_cause} THEN '' ELSE CAST(CASE WHEN l_partkey % 10 = 0 THEN 7 ELSE 0 END AS STRING) END"
        " AS security_delay",
        f"CASE WHEN {no_cause} THEN '' ELSE CAST(l_suppkey % 3 * 4 AS STRING) END AS airline_delay",
        f"CASE WHEN {no_cause} THEN '' ELSE CAST(CAST(l_quantity AS INT) % 6 AS STRING) END AS late_aircraft_delay",
        f"CASE WHEN {no_cause} OR l_linestatus = 'O' THEN '' ELSE CAST(l_partkey % 2 * 9 AS STRING) END"
        " AS weather_delay",
        "CAST(NULL AS STRING) AS _problem",
    )


def airlines_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline dictionary ``(code, name)``; every tenth supplier is missing."""
    return (
        table(spark, sf_dir, "supplier")
        .where(F.col("s_suppkey") % 10 != 3)
        .select(_text(F.col("s_suppkey")).alias("code"), F.col("s_name").alias("name"))
    )


def airports_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dictionary ``(code, name)``; the nations of one region are missing."""
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_regionkey") != 4)
        .select(_text(F.col("n_nationkey")).alias("code"), F.col("n_name").alias("name"))
    )
