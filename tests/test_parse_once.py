"""Raw flight lines are parsed once, whatever the counts above them mention."""

from conftest import write_files
from test_hand_fixture import AIRPORTS, BATCH1, HEADER
from skytally.operators import clean_flights, tally
from skytally.sources import read_dictionary_csv, read_flights_csv


def test_date_and_fields_are_taken_from_a_line_once(spark, tmp_path):
    d = write_files(tmp_path / "in", {"flights.csv": HEADER + BATCH1})
    airports = read_dictionary_csv(spark, write_files(tmp_path / "dict", {"airports.csv": AIRPORTS}))
    counts = tally(clean_flights(read_flights_csv(spark, d), airports))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("yyyy-MM-dd") == 1  # was parsed again in every filter and count that reads the date
    assert plan.count("fields#") < 100
    assert {r.k1: r.n for r in counts.collect() if r.metric == "__batch__"}["rows"] == 8
