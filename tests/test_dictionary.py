"""Dictionary reading: header per file, last duplicate wins, joins chosen by size."""

import contextlib
import io

from conftest import write_files
from skytally.operators import keep_known
from skytally.sources import read_dictionary_csv


def test_last_duplicate_wins_and_header_dropped(spark, tmp_path):
    d = write_files(tmp_path, {"a.csv": "CODE,NAME\nJFK,Kennedy\nLAX,Los Angeles\nJFK,John F Kennedy,NY\nX,,y\n"})
    got = {r.code: r.name for r in read_dictionary_csv(spark, d).collect()}
    assert got == {"JFK": "John F Kennedy", "LAX": "Los Angeles", "X": ""}


def test_join_follows_the_size_of_the_written_dictionary(spark, tmp_path):
    """No hint and no probe: the file size of the run's small table decides."""
    from skytally.state import StateStore

    store = StateStore(spark, str(tmp_path / "s"))
    small = spark.range(5).selectExpr("CAST(id AS STRING) AS code", "'n' AS name")
    large = spark.range(200_000).selectExpr("CAST(id AS STRING) AS code", "concat('name of ', id) AS name")
    store.write_dictionaries("r", airports=small, airlines=large)
    assert store.read_dictionary("r", "airports").count() == 5 and store.read_dictionaries("r").count() == 200_005
    probe = spark.range(1000).selectExpr("CAST(id AS STRING) AS c")

    def plan(kind):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            keep_known(probe, "c", store.read_dictionary("r", kind)).explain()
        return buf.getvalue()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        assert "BroadcastHashJoin" in plan("airports")
        assert "BroadcastHashJoin" not in plan("airlines")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_empty_dictionary_is_a_table_too(spark, tmp_path):
    from skytally.state import StateStore

    store = StateStore(spark, str(tmp_path / "s"))
    none = spark.range(0).selectExpr("CAST(id AS STRING) AS code", "'n' AS name")
    store.write_dictionaries("r", airports=none, airlines=none)
    assert store.read_dictionary("r", "airports").count() == 0 and store.read_dictionaries("r").count() == 0


def test_run_without_broadcast_gives_same_results(spark, tmp_path):
    """Dictionaries too large to broadcast are joined by a shuffle."""
    from skytally.plans.batch import run_batch
    from test_hand_fixture import AIRLINES, AIRPORTS, BATCH1, HEADER

    d = write_files(tmp_path / "in", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES,
                                      "flights.csv": HEADER + BATCH1})
    args = (f"{d}/flights.csv", f"{d}/airlines.csv", f"{d}/airports.csv")
    with_bc = run_batch(spark, str(tmp_path / "a"), *args)
    expected = {k: sorted(map(tuple, v.collect())) for k, v in with_bc.metrics.items()}
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in off:
        spark.conf.set(k, "-1")
    try:
        without = run_batch(spark, str(tmp_path / "b"), *args)
        got = {k: sorted(map(tuple, v.collect())) for k, v in without.metrics.items()}
    finally:
        for k in off:
            spark.conf.unset(k)
    assert got == expected


def test_last_wins_across_files(spark, tmp_path):
    d = write_files(tmp_path, {
        "part-0.csv": "CODE,NAME\nJFK,Kennedy\nLAX,Los Angeles\n",
        "part-1.csv": "CODE,NAME\nJFK,JFK International\nSFO,San Francisco\n",
    })
    got = {r.code: r.name for r in read_dictionary_csv(spark, d).collect()}
    assert got == {"JFK": "JFK International", "LAX": "Los Angeles", "SFO": "San Francisco"}
