"""Incremental property: runs split at any date equal one run over everything."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from skytally.functions import date_lit
from skytally.operators import merge_counts, tally
from skytally.plans.batch import run_batch
from skytally.plans.catalogue import Inputs
from skytally.state import StateStore


def _state_rows(df):
    return sorted(tuple(r) for r in df.where("metric <> '__batch__'").select("metric", "k1", "k2", "n").collect())


@pytest.mark.parametrize("cuts", [
    [dt.date(1996, 6, 30)],
    [dt.date(1999, 12, 31)],
    [dt.date(1995, 3, 1), dt.date(1998, 1, 1), dt.date(2001, 6, 30)],
])
def test_split_runs_equal_one_shot(spark, tmp_path, cuts):
    i = Inputs(spark, SF_SMALL)
    one_shot = _state_rows(merge_counts(tally(i.clean()).where("metric <> '__batch__'")))
    base = str(tmp_path / "state")
    d = F.col("flight_date")
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:]):
        part = i.flights
        if lo is not None:
            part = part.where(d > date_lit(lo))
        if hi is not None:
            part = part.where(d <= date_lit(hi))
        run_batch(spark, base, part, i.airlines, i.airports)
    store = StateStore(spark, base)
    assert _state_rows(store.committed_state()) == one_shot
    assert store.latest_commit().seq == len(cuts) + 1


def test_uncommitted_snapshot_is_ignored(spark, tmp_path):
    i = Inputs(spark, SF_SMALL)
    base = str(tmp_path / "state")
    run_batch(spark, base, i.flights, i.airlines, i.airports)
    store = StateStore(spark, base)
    committed = _state_rows(store.committed_state())
    _, run_id = store.new_run(store.latest_commit())
    store.write_snapshot(tally(i.clean()), run_id)  # written, never committed
    assert _state_rows(store.committed_state()) == committed


def test_empty_first_batch_is_no_new_data(spark, tmp_path):
    i = Inputs(spark, SF_SMALL)
    r = run_batch(spark, str(tmp_path / "s"), i.flights.where("flight_date < DATE '1900-01-01'"),
                  i.airlines, i.airports)
    assert r.status == "no_new_data"
    assert StateStore(spark, str(tmp_path / "s")).latest_commit() is None


def test_typed_flights_frame_without_problem_column(spark, tmp_path):
    i = Inputs(spark, SF_SMALL)
    typed = i.flights.drop("_problem")
    r = run_batch(spark, str(tmp_path / "s"), typed, i.airlines, i.airports)
    assert r.status == "processed" and r.flights == i.clean().count()
    with pytest.raises(ValueError, match="lacks column"):
        run_batch(spark, str(tmp_path / "t"), typed.drop("airline"), i.airlines, i.airports)


def test_text_inputs_two_runs_equal_one_shot(spark, tmp_path):
    """The production path: flights and dictionaries as text files, two runs."""
    from skytally.plans.catalogue import flight_lines
    from skytally.sinks import write_text_with_header

    i = Inputs(spark, SF_SMALL)
    d = F.col("flight_date")
    cut = dt.date(1999, 12, 31)
    write_text_with_header(flight_lines(i.flights.where(d <= date_lit(cut))), str(tmp_path / "f1"))
    write_text_with_header(flight_lines(i.flights.where(d > date_lit(cut))), str(tmp_path / "f2"))
    write_text_with_header(i.airports.select(F.concat_ws(",", "code", "name")), str(tmp_path / "ap"))
    write_text_with_header(i.airlines.select(F.concat_ws(",", "code", "name")), str(tmp_path / "al"))
    base = str(tmp_path / "state")
    for part in ("f1", "f2"):
        assert run_batch(spark, base, str(tmp_path / part), str(tmp_path / "al"),
                         str(tmp_path / "ap")).status == "processed"
    one_shot = _state_rows(merge_counts(tally(i.clean()).where("metric <> '__batch__'")))
    assert _state_rows(StateStore(spark, base).committed_state()) == one_shot
