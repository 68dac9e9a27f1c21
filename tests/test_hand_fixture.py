"""The hand fixture: two CSV batches through run_batch (CSV path end to end)."""

import datetime as dt

import pytest

from conftest import write_files
from skytally.plans.batch import RunOptions, run_batch
from skytally.state import StateStore

HEADER = "YEAR,MONTH,DAY,DAY_OF_WEEK,AIRLINE,rest\n"
AIRPORTS = "IATA_CODE,AIRPORT\nJFK,Kennedy\nLAX,Los Angeles\nSFO,San Francisco\n"
AIRLINES = "IATA_CODE,AIRLINE\nAA,American\nDL,Delta\nUA,United\n"

BATCH1 = """2015,1,1,4,AA,,,JFK,LAX,,,0,,,,,,,,,,,0,,,,,,,,
2015,1,1,4,AA,,,JFK,LAX,,,0,,,,,,,,,,,-5,,,,,,,,
2015,1,1,4,DL,,,JFK,SFO,,,0,,,,,,,,,,,30,,,,30,0,0,0,0
2015,01,2,5,DL,,,LAX,JFK,,,12,,,,,,,,,,,20,,,,0,0,12,8,0
2015,1,2,5,ZZ,,,SFO,JFK,,,0,,,,,,,,,,,0,,,,,,,,
2015,1,2,5,AA,,,10397,JFK,,,0,,,,,,,,,,,0,,,,,,,,
2015,1,3,6,AA,,,LAX,SFO,,,,,,,,,,,,,,,,,,,,,,
2015,1,3,6,AA,,,LAX,XXX,,,0,,,,,,,,,,,0,,,,,,,,
2015,1,3,6,UA,,,SFO,LAX,,,-3,,,,,,,,,,,0,,,,,,,,
2015,1,3,6,UA,,,LAX,SFO,,,0,,,,,,,,,,,0,,,,,,,,
"""

BATCH2 = """2015,1,3,6,AA,,,JFK,LAX,,,0,,,,,,,,,,,0,,,,,,,,
2015,1,4,7,AA,,,JFK,LAX,,,0,,,,,,,,,,,0,,,,,,,,
2015,1,4,7,DL,,,JFK,LAX,,,5,,,,,,,,,,,25,,,,0,0,0,25,0
2015,1,4,7,UA,,,SFO,JFK,,,0,,,,,,,,,,,15,,,,5,0,0,0,10
"""


@pytest.fixture()
def files(tmp_path):
    d = write_files(tmp_path / "dict", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES})
    write_files(tmp_path / "b1", {"flights.csv": HEADER + BATCH1})
    write_files(tmp_path / "b2", {"flights.csv": HEADER + BATCH2})
    return {
        "airports": f"{d}/airports.csv",
        "airlines": f"{d}/airlines.csv",
        "b1": str(tmp_path / "b1" / "flights.csv"),
        "b2": str(tmp_path / "b2" / "flights.csv"),
        "base": str(tmp_path / "state"),
    }


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def ranked(df, name_col, value_col):
    return [(r[name_col], r[value_col]) for r in sorted(df.collect(), key=lambda r: r["rank"])]


def per_origin(df, partner, value):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["origin"], r["rank"])):
        out.setdefault(r["origin"], []).append((r[partner], r[value]))
    return out


def reasons(df, col):
    return [r[col] for r in sorted(df.collect(), key=lambda r: r["reason_id"])]


def run(spark, f, batch, **kw):
    return run_batch(spark, f["base"], f[batch], f["airlines"], f["airports"], RunOptions(**kw))


def test_batch_one(spark, files):
    r = run(spark, files, "b1")
    assert r.status == "processed"
    assert r.flights == 8
    assert (r.first_date, r.last_date) == (dt.date(2015, 1, 1), dt.date(2015, 1, 3))
    m = r.metrics
    assert ranked(m["top_airports"], "airport", "flights") == [
        ("Kennedy", 3), ("Los Angeles", 3), ("San Francisco", 2)]
    assert ranked(m["top_airlines"], "airline", "ontime_flights") == [("American", 1), ("United", 1)]
    assert per_origin(m["top_carriers_per_origin"], "airline", "ontime_departures") == {
        "Kennedy": [("Delta", 1), ("American", 2)], "Los Angeles": [("United", 1)]}
    assert per_origin(m["top_destinations_per_origin"], "destination", "ontime_departures") == {
        "Kennedy": [("San Francisco", 1), ("Los Angeles", 2)],
        "Los Angeles": [("San Francisco", 1)],
        "San Francisco": [("Kennedy", 1)]}
    assert ranked(m["weekdays_by_ontime"], "week_day", "ontime_arrivals") == [("6", 2), ("4", 1), ("5", 1)]
    assert reasons(m["delay_reason_counts"], "flights") == [1, 0, 1, 1, 0]
    assert reasons(m["delay_reason_minutes"], "minutes") == [30, 0, 12, 8, 0]
    assert reasons(m["delay_reason_percent"], "percent") == [60.0, 0.0, 24.0, 16.0, 0.0]
    state = StateStore(spark, files["base"]).committed_state()
    assert rows(state.where("metric = 'ontime_by_airline'"), "k1", "n") == [("AA", 1), ("UA", 1), ("ZZ", 1)]


def test_two_batches_and_repeat(spark, files):
    run(spark, files, "b1")
    r = run(spark, files, "b2")
    assert r.status == "processed"
    assert r.flights == 3
    assert (r.first_date, r.last_date) == (dt.date(2015, 1, 4), dt.date(2015, 1, 4))
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

    store = StateStore(spark, files["base"])
    before = rows(store.committed_state(), "metric", "k1", "k2", "n")
    again = run(spark, files, "b2")
    assert again.status == "no_new_data"
    assert rows(store.committed_state(), "metric", "k1", "k2", "n") == before
    assert [r.seq for r in store.commits().collect()] and store.latest_commit().seq == 2
    statuses = [r.status for r in store.run_log().orderBy("logged_at", "status").collect()]
    assert statuses.count("processed") == 2 and statuses[-1] == "no_new_data"


def test_sort_directions(spark, files):
    r = run(spark, files, "b1", airports_ascending=True, airlines_ascending=False,
            carriers_ascending=False, destinations_ascending=False)
    m = r.metrics
    assert ranked(m["top_airports"], "airport", "flights") == [
        ("San Francisco", 2), ("Kennedy", 3), ("Los Angeles", 3)]
    assert ranked(m["top_airlines"], "airline", "ontime_flights") == [("American", 1), ("United", 1)]
    assert per_origin(m["top_carriers_per_origin"], "airline", "ontime_departures")["Kennedy"] == [
        ("American", 2), ("Delta", 1)]
    assert per_origin(m["top_destinations_per_origin"], "destination", "ontime_departures")["Kennedy"] == [
        ("Los Angeles", 2), ("San Francisco", 1)]


def test_top_k_cut(spark, files):
    r = run(spark, files, "b1", k=1)
    m = r.metrics
    assert ranked(m["top_airports"], "airport", "flights") == [("Kennedy", 3)]
    assert per_origin(m["top_carriers_per_origin"], "airline", "ontime_departures") == {
        "Kennedy": [("Delta", 1)], "Los Angeles": [("United", 1)]}


def test_unknown_metric_name_is_rejected(spark, files):
    run(spark, files, "b1")
    store = StateStore(spark, files["base"])
    assert store.committed_metric("top_airports").count() == 3
    with pytest.raises(KeyError):
        store.committed_metric("busiest_everything")
    with pytest.raises(KeyError):
        store.write_metric(store.committed_metric("top_airports"), "x", "nonsense")


def test_text_export_and_cli(spark, tmp_path):
    import os

    from skytally.__main__ import main

    base = tmp_path / "job"
    write_files(base / "input", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES,
                                 "flights.csv": HEADER + BATCH1, "later.csv": HEADER + BATCH2})
    assert main(["--base-path", str(base)]) == 0
    assert main(["--base-path", str(base), "--input-file", "later.csv"]) == 0
    store = StateStore(spark, str(base / "state"))
    run_id = store.latest_commit().run_id
    lines = {}
    for name in ["top_airports", "top_carriers_per_origin", "delay_reason_percent", "weekdays_by_ontime"]:
        folder = store.lines_path(run_id, name)
        parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        lines[name] = [ln for f in parts for ln in open(os.path.join(folder, f)).read().splitlines()]
    assert lines["top_airports"] == ["Kennedy,5", "Los Angeles,3", "San Francisco,3"]
    assert lines["top_carriers_per_origin"] == [
        "Kennedy,Delta,1", "Kennedy,American,3", "Los Angeles,United,1", "San Francisco,United,1"]
    assert lines["delay_reason_percent"] == [
        "AIR_SYSTEM_DELAY,38.89", "SECURITY_DELAY,0.0", "AIRLINE_DELAY,13.33",
        "LATE_AIRCRAFT_DELAY,36.67", "WEATHER_DELAY,11.11"]
    assert lines["weekdays_by_ontime"] == ["6,2", "4,1", "5,1", "7,1"]


def test_windows_line_endings(spark, tmp_path):
    crlf = {name: text.replace("\n", "\r\n") for name, text in
            {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES, "flights.csv": HEADER + BATCH1}.items()}
    for name, text in crlf.items():
        (tmp_path / name).write_bytes(text.encode())
    r = run_batch(spark, str(tmp_path / "state"), str(tmp_path / "flights.csv"),
                  str(tmp_path / "airlines.csv"), str(tmp_path / "airports.csv"))
    assert r.flights == 8
    assert reasons(r.metrics["delay_reason_minutes"], "minutes") == [30, 0, 12, 8, 0]
    assert ranked(r.metrics["top_airports"], "airport", "flights")[0] == ("Kennedy", 3)


def test_cli_order_and_no_text(spark, tmp_path):
    import os

    from skytally.__main__ import main

    base = tmp_path / "job"
    write_files(base / "input", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES,
                                 "flights.csv": HEADER + BATCH1})
    assert main(["--base-path", str(base), "--airports-order", "asc", "--top", "2", "--no-text"]) == 0
    store = StateStore(spark, str(base / "state"))
    m1 = store.committed_metric("top_airports")
    assert ranked(m1, "airport", "flights") == [("San Francisco", 2), ("Kennedy", 3)]
    assert not os.path.exists(store.lines_path(store.latest_commit().run_id, "top_airports"))
