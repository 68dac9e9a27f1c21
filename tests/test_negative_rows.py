"""Rows that must fail the run and leave the committed state untouched."""

import pytest

from conftest import write_files
from test_hand_fixture import AIRLINES, AIRPORTS, BATCH1, HEADER
from skytally.plans.batch import run_batch
from skytally.state import StateStore

GOOD_LATER = "2015,1,5,1,AA,,,JFK,LAX,,,0,,,,,,,,,,,0,,,,,,,,\n"
BAD = {
    "impossible_day": "2015,2,30,1,AA,,,JFK,LAX,,,0,,,,,,,,,,,0,,,,,,,,\n",
    "long_month": "2015,123,1,1,AA,,,JFK,LAX,,,0,,,,,,,,,,,0,,,,,,,,\n",
    "short_row": "2015,1,5,1,AA,,,JFK,LAX,,,0,,,,,,,,\n",
    "minutes_not_a_number": "2015,1,5,1,AA,,,JFK,LAX,,,0,,,,,,,,,,,0,,,,abc,0,0,0,0\n",
    "bad_date_unknown_airport": "2015,2,30,1,AA,,,XXX,YYY,,,0,,,,,,,,,,,0,,,,,,,,\n",
    "bad_date_old_row": "2014,13,1,1,AA,,,JFK,LAX,,,0,,,,,,,,,,,0,,,,,,,,\n",
}


@pytest.mark.parametrize("case", sorted(BAD))
def test_bad_row_fails_and_keeps_state(spark, tmp_path, case):
    d = write_files(tmp_path / "dict", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES})
    write_files(tmp_path / "b1", {"flights.csv": HEADER + BATCH1})
    write_files(tmp_path / "b2", {"flights.csv": HEADER + GOOD_LATER + BAD[case] + GOOD_LATER})
    base = str(tmp_path / "state")
    run_batch(spark, base, str(tmp_path / "b1"), f"{d}/airlines.csv", f"{d}/airports.csv")
    store = StateStore(spark, base)
    before = sorted(map(tuple, store.committed_state().collect()))
    with pytest.raises(Exception):
        run_batch(spark, base, str(tmp_path / "b2"), f"{d}/airlines.csv", f"{d}/airports.csv")
    assert store.latest_commit().seq == 1
    assert sorted(map(tuple, store.committed_state().collect())) == before
    log = store.run_log().collect()
    assert any(r.status == "error" for r in log)


def test_dictionary_line_without_name_fails(spark, tmp_path):
    d = write_files(tmp_path / "dict", {"airports.csv": AIRPORTS + "ORD,\n", "airlines.csv": AIRLINES})
    write_files(tmp_path / "b1", {"flights.csv": HEADER + BATCH1})
    with pytest.raises(Exception):
        run_batch(spark, str(tmp_path / "state"), str(tmp_path / "b1"), f"{d}/airlines.csv",
                  f"{d}/airports.csv")
