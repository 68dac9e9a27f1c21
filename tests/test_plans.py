"""Plan shape: the physical operators the design relies on."""

import contextlib
import io
import os
import uuid

from skytally import RunOptions, run_batch
from skytally import constants as C
from skytally.operators import merge_into, metric_counts, reasons_from_counts, slice_metric, tally
from skytally.plans import metrics as M
from skytally.plans.catalogue import QUERIES, Inputs
from conftest import SF_SMALL
from skytally.state import StateStore


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_global_top_k_is_take_ordered(spark):
    p = plan(QUERIES["top_airports_desc"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    assert "BroadcastHashJoin" in p


def test_per_group_top_k_limits_before_shuffle(spark):
    p = plan(QUERIES["top_carriers_per_origin_asc"](spark, SF_SMALL))
    partial = p.index("WindowGroupLimit", p.index("Exchange hashpartitioning(origin_code"))
    assert "Partial" in p[partial:p.index("\n", partial)]
    assert "Final" in p


def test_tally_is_one_aggregate_with_one_shuffle(spark):
    i = Inputs(spark, SF_SMALL)
    p = plan(tally(i.clean()))
    assert "Generate inline" in p
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("HashAggregate") == 2  # partial + final


def test_airport_filter_is_broadcast_semi_join(spark):
    p = plan(QUERIES["clean_flights"](spark, SF_SMALL))
    assert p.count("LeftSemi") == 2


def test_merge_leaves_the_old_state_in_place(spark, tmp_path):
    """The old side is a bucketed scan without an exchange; only the new counts are shuffled."""
    store = StateStore(spark, str(tmp_path / "s"))
    counts = tally(Inputs(spark, SF_SMALL).clean())
    store.write_snapshot(counts, "old", 8)
    new = store.write_counts(counts, "new")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("8", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            with store.bucketed("old", 8) as old:
                p = plan(merge_into(old, new))
                store.write_snapshot(merge_into(old, new), f"merged-{partitions}", 8, in_place=True)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert p.count("Exchange") == 1 and "Bucketed: true" in p and "FullOuter" in p
        left, right = p.split("FileScan parquet")[0:2]
        assert "Exchange" not in left  # it stands between the two scans, above the new counts
        want = sorted((r.metric, r.k1, r.k2, 2 * r.n) for r in counts.collect())
        assert sorted(map(tuple, store.read_snapshot(f"merged-{partitions}").collect())) == want
        files = os.listdir(tmp_path / "s" / "snapshots" / f"run=merged-{partitions}")
        assert sum(f.endswith(".parquet") for f in files) <= 8  # one file a bucket
    assert spark.catalog.listTables() == []


def test_a_run_has_few_jobs_and_caches_nothing(spark, tmp_path):
    """Jobs of a whole run (AQE counts each shuffle as one), and no probe before the scan."""
    i = Inputs(spark, SF_SMALL)
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    for base in ("s", "s"):  # a first run, and one that merges
        group = f"run-{uuid.uuid4().hex}"
        sc.setJobGroup(group, "one run")
        try:
            cut = "<=" if not os.path.exists(tmp_path / base) else ">"
            result = run_batch(spark, str(tmp_path / base), i.flights.where(f"flight_date {cut} DATE '1999-12-31'"), i.airlines, i.airports)
        finally:
            sc.setJobGroup("none", "")
        assert result.status == "processed"
        assert 0 < len(tracker.getJobIdsForGroup(group)) <= 25
        assert sc._jsc.getPersistentRDDs().isEmpty()


def test_all_tables_at_once_equal_the_single_metrics(spark, tmp_path):
    i = Inputs(spark, SF_SMALL)
    for options in (RunOptions(k=3), RunOptions(True, False, False, False, k=4)):
        base = str(tmp_path / f"s{options.k}")
        result = run_batch(spark, base, i.flights, i.airlines, i.airports, options)
        state = StateStore(spark, base).committed_state()
        totals = reasons_from_counts(state)
        single = {
            "top_airports": M.top_airports(slice_metric(state, C.DEPARTURES_BY_ORIGIN), i.airports, options.airports_ascending, options.k),
            "top_airlines": M.top_airlines(slice_metric(state, C.ONTIME_BY_AIRLINE), i.airlines, options.airlines_ascending, options.k),
            "top_carriers_per_origin": M.top_carriers_per_origin(
                slice_metric(state, C.ONTIME_BY_ORIGIN_AIRLINE), i.airports, i.airlines, options.carriers_ascending, options.k),
            "top_destinations_per_origin": M.top_destinations_per_origin(
                slice_metric(state, C.ONTIME_BY_ORIGIN_DEST), i.airports, options.destinations_ascending, options.k),
            "weekdays_by_ontime": M.weekdays_by_ontime(slice_metric(state, C.ONTIME_ARRIVALS_BY_WEEKDAY)),
            "delay_reason_counts": M.delay_reason_counts(totals), "delay_reason_minutes": M.delay_reason_minutes(totals),
            "delay_reason_percent": M.delay_reason_percent(totals),
        }
        for name, df in single.items():
            assert result.metrics[name].columns == df.columns
            assert sorted(map(tuple, result.metrics[name].collect())) == sorted(map(tuple, df.collect())), name


def test_projection_reaches_the_scan(spark):
    i = Inputs(spark, SF_SMALL)
    p = plan(metric_counts(i.clean(), C.DEPARTURES_BY_ORIGIN))
    lineitem_scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in lineitem_scan


def test_no_python_udf_anywhere(spark):
    for name in ["top_airports_desc", "top_carriers_per_origin_desc", "weekdays_by_ontime",
                 "delay_reason_percent", "merge_counts", "clean_flights"]:
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "Python" not in p and "ArrowEval" not in p, name


def test_weekday_ranking_is_total_order(spark):
    i = Inputs(spark, SF_SMALL)
    df = M.weekdays_by_ontime(metric_counts(i.clean(), C.ONTIME_ARRIVALS_BY_WEEKDAY))
    ranks = sorted(r["rank"] for r in df.collect())
    assert ranks == list(range(1, len(ranks) + 1))
