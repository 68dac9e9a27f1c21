"""Every registered query against its DuckDB SQL on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from skytally.plans.catalogue import QUERIES
from skytally.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    """Of the job itself; the text queries, where they are present, have tests of their own."""
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(E.oracle_sql()) == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(df.columns, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["origin_code", "origin", "rank", "airline_code", "airline", "ontime_departures"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["dictionary_last_wins_airlines", "metrics_sink_roundtrip",
                                  "incremental_two_batches", "top_carriers_per_origin_desc"])
def test_query_matches_oracle_with_many_partitions_and_no_aqe(spark, duck, name):
    """Results must not depend on partitioning: 32 shuffle partitions, AQE off
    (many part files for the written dictionaries, metrics and state)."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
