"""File stream with foreachBatch + availableNow drives the incremental job."""

from conftest import write_files
from test_hand_fixture import AIRLINES, AIRPORTS, BATCH1, BATCH2, HEADER
from skytally.state import StateStore
from skytally.streaming import start_incremental


def test_stream_processes_new_files_once(spark, tmp_path):
    d = write_files(tmp_path / "dict", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES})
    inbox = tmp_path / "inbox"
    write_files(inbox, {"part1.csv": HEADER + BATCH1})
    base = str(tmp_path / "state")
    cp = str(tmp_path / "cp")
    results = []
    q = start_incremental(spark, str(inbox), f"{d}/airlines.csv", f"{d}/airports.csv", base,
                          checkpoint_location=cp, results=results)
    q.awaitTermination(120)
    assert [r.status for r in results] == ["processed"]
    assert results[0].flights == 8

    write_files(inbox, {"part2.csv": HEADER + BATCH2})
    q = start_incremental(spark, str(inbox), f"{d}/airlines.csv", f"{d}/airports.csv", base,
                          checkpoint_location=cp, results=results)
    q.awaitTermination(120)
    assert [r.status for r in results] == ["processed", "processed"]
    assert results[1].flights == 3  # the late row of 2015-01-03 is ignored
    store = StateStore(spark, base)
    assert store.latest_commit().seq == 2
    m1 = {r.airport: r.flights for r in results[1].metrics["top_airports"].collect()}
    assert m1 == {"Kennedy": 5, "Los Angeles": 3, "San Francisco": 3}


def test_cli_inbox(spark, tmp_path):
    from skytally.__main__ import main

    job = tmp_path / "job"
    write_files(job / "input", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES})
    inbox = tmp_path / "inbox"
    write_files(inbox, {"a.csv": HEADER + BATCH1})
    assert main(["--base-path", str(job), "--inbox", str(inbox)]) == 0
    write_files(inbox, {"b.csv": HEADER + BATCH2})
    assert main(["--base-path", str(job), "--inbox", str(inbox)]) == 0
    assert main(["--base-path", str(job), "--inbox", str(inbox)]) == 0  # nothing new
    store = StateStore(spark, str(job / "state"))
    assert store.latest_commit().seq == 2
    assert store.latest_commit().flights == 3
