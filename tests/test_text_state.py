"""Importing the original job's text cache, then continuing with run_batch."""

import datetime as dt

import pytest

from conftest import write_files
from test_hand_fixture import AIRLINES, AIRPORTS, BATCH2, HEADER, per_origin, ranked, reasons
from skytally.plans.batch import run_batch
from skytally.sources.text_state import import_text_state, read_text_state
from skytally.state import StateStore

# The original job's cache after batch 1 of the hand fixture.
CACHE_AFTER_BATCH_1 = {
    "topTenAirportsCache/part-00000": "JFK,3\nLAX,3\n",
    "topTenAirportsCache/part-00001": "SFO,2\n",
    "topTenAirlinesCache/part-00000": "AA,1\nUA,1\nZZ,1\n",
    "topTenAirportsPerAvialinesCache/part-00000": "(JFK,AA),2\n(JFK,DL),1\n(SFO,ZZ),1\n(LAX,UA),1\n",
    "topTenDestinationsCache/part-00000": "(JFK,LAX),2\n(JFK,SFO),1\n(SFO,JFK),1\n(LAX,SFO),1\n",
    "weekdaysOrderbyDelaysCache/part-00000": "6,2\n4,1\n5,1\n",
    "delaysPerReasonsCache.csv": "1,0,1,1,0",
    "percentDelayPerReasonsCache.csv": "30,0,12,8, 0\n",
    "last_processed_date.txt": "2015-01-03",
}


def _write_cache(root, files):
    for name, text in files.items():
        folder, _, leaf = name.rpartition("/")
        write_files(root / folder if folder else root, {leaf: text})
    return str(root)


def test_import_then_continue_matches_two_runs(spark, tmp_path):
    cache = _write_cache(tmp_path / "cache", CACHE_AFTER_BATCH_1)
    base = str(tmp_path / "state")
    c = import_text_state(spark, cache, base)
    assert (c.seq, c.last_date, c.flights) == (1, dt.date(2015, 1, 3), 8)
    d = write_files(tmp_path / "in", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES,
                                      "flights.csv": HEADER + BATCH2})
    r = run_batch(spark, base, f"{d}/flights.csv", f"{d}/airlines.csv", f"{d}/airports.csv")
    assert r.status == "processed" and r.flights == 3  # the 2015-01-03 row is at the mark
    m = r.metrics
    assert ranked(m["top_airports"], "airport", "flights") == [
        ("Kennedy", 5), ("Los Angeles", 3), ("San Francisco", 3)]
    assert ranked(m["top_airlines"], "airline", "ontime_flights") == [("United", 1), ("American", 2)]
    assert per_origin(m["top_carriers_per_origin"], "airline", "ontime_departures") == {
        "Kennedy": [("Delta", 1), ("American", 3)], "Los Angeles": [("United", 1)],
        "San Francisco": [("United", 1)]}
    assert per_origin(m["top_destinations_per_origin"], "destination", "ontime_departures") == {
        "Kennedy": [("San Francisco", 1), ("Los Angeles", 3)],
        "Los Angeles": [("San Francisco", 1)],
        "San Francisco": [("Kennedy", 2)]}
    assert ranked(m["weekdays_by_ontime"], "week_day", "ontime_arrivals") == [
        ("6", 2), ("4", 1), ("5", 1), ("7", 1)]
    assert reasons(m["delay_reason_counts"], "flights") == [2, 0, 1, 2, 1]
    assert reasons(m["delay_reason_minutes"], "minutes") == [35, 0, 12, 33, 10]
    assert reasons(m["delay_reason_percent"], "percent") == [38.89, 0.0, 13.33, 36.67, 11.11]


def test_empty_cache_and_refusals(spark, tmp_path):
    assert import_text_state(spark, str(tmp_path / "nothing"), str(tmp_path / "s1")) is None
    counts_only = {k: v for k, v in CACHE_AFTER_BATCH_1.items() if k != "last_processed_date.txt"}
    with pytest.raises(ValueError, match="no last_processed_date"):
        import_text_state(spark, _write_cache(tmp_path / "c2", counts_only), str(tmp_path / "s2"))
    bad = dict(CACHE_AFTER_BATCH_1, **{"topTenAirlinesCache/part-00000": "AA,x\n"})
    with pytest.raises(Exception):
        read_text_state(spark, _write_cache(tmp_path / "c3", bad))[0].collect()
    cache = _write_cache(tmp_path / "c4", CACHE_AFTER_BATCH_1)
    import_text_state(spark, cache, str(tmp_path / "s4"))
    with pytest.raises(ValueError, match="already has committed runs"):
        import_text_state(spark, cache, str(tmp_path / "s4"))
    assert StateStore(spark, str(tmp_path / "s4")).latest_commit().seq == 1


def test_cli_import(spark, tmp_path):
    from skytally.__main__ import main

    cache = _write_cache(tmp_path / "cache", CACHE_AFTER_BATCH_1)
    assert main(["--base-path", str(tmp_path / "job"), "--import-cache", cache]) == 0
    assert StateStore(spark, str(tmp_path / "job" / "state")).latest_commit().last_date == dt.date(2015, 1, 3)
