"""StateStore: snapshots, commits, run log, visibility rules."""

import datetime as dt

from pyspark.sql import functions as F

from skytally.state import StateStore


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_empty_store(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    assert store.latest_commit() is None
    assert store.committed_state().count() == 0
    assert store.commits().count() == 0 and store.run_log().count() == 0
    assert store.committed_state().columns == ["metric", "k1", "k2", "n"]


def test_commits_are_ordered_and_only_committed_state_is_visible(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    state = spark.createDataFrame([("m", "a", "", 1), ("m", "b", "", 2)], "metric string, k1 string, k2 string, n bigint")
    seq1, run1 = store.new_run(None)
    store.write_snapshot(state, run1)
    assert store.latest_commit() is None  # written, not committed
    store.commit(seq1, run1, dt.date(2015, 1, 1), dt.date(2015, 1, 3), 8)
    c1 = store.latest_commit()
    assert (c1.seq, c1.run_id, c1.last_date, c1.flights) == (1, run1, dt.date(2015, 1, 3), 8)

    seq2, run2 = store.new_run(c1)
    assert seq2 == 2 and run2 != run1 and run2 > run1
    store.write_snapshot(state.withColumn("n", F.col("n") * 10), run2)
    assert _rows(store.committed_state()) == _rows(state)  # run 2 not committed yet
    store.commit(seq2, run2, dt.date(2015, 1, 4), dt.date(2015, 1, 4), 3)
    assert store.latest_commit().seq == 2
    assert _rows(store.committed_state()) == [("m", "a", "", 10), ("m", "b", "", 20)]


def test_run_log_appends(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    store.log("r1", ("collected", "x"), ("processed", "y"))
    store.log(None, ("error", "boom"))
    got = sorted((r.run_id or "", r.status, r.detail) for r in store.run_log().collect())
    assert got == sorted([("r1", "collected", "x"), ("r1", "processed", "y"), ("", "error", "boom")])
    assert all(r.logged_at is not None for r in store.run_log().collect())


def test_stale_runs_lists_old_and_failed_runs_only(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    state = spark.createDataFrame([("m", "a", "", 1)], "metric string, k1 string, k2 string, n bigint")
    assert store.stale_runs() == []
    runs = []
    prev = None
    for i in range(4):
        seq, run_id = store.new_run(prev)
        store.write_snapshot(state, run_id)
        if i != 2:  # run 3 fails before its commit
            store.commit(seq, run_id, dt.date(2015, 1, i + 1), dt.date(2015, 1, i + 1), 1)
            prev = store.latest_commit()
        runs.append(run_id)
    _, in_flight = store.new_run(store.latest_commit())
    store.write_snapshot(state, in_flight)
    stale = store.stale_runs(keep=2)
    stale_runs = sorted({p.split("run=")[1].split("/")[0] for p in stale})
    # runs[0] seq 1 and runs[1] seq 2 committed; runs[2] (seq 3) failed; runs[3] reused seq 3 and
    # committed; in_flight (seq 4) started after the newest commit.  keep=2 keeps seq 2 and 3.
    assert runs[0] in stale_runs and runs[2] in stale_runs
    assert runs[3] not in stale_runs and in_flight not in stale_runs
    assert all(p.startswith(str(tmp_path / "s")) for p in stale)
