"""Inputs and writers that must not lose or repeat flights silently."""

import datetime as dt
import json
import os
import threading

import pytest

from conftest import write_files
from test_hand_fixture import AIRLINES, AIRPORTS, BATCH1, BATCH2, HEADER
from skytally.constants import FLIGHT_COLUMNS
from skytally.files import SharedFiles
from skytally.operators import rank_all
from skytally.plans.batch import run_batch
from skytally.sources import read_flights_csv
from skytally.sources.text_state import import_text_state
from skytally.state import StateStore
from skytally.streaming import start_incremental
from test_text_state import CACHE_AFTER_BATCH_1, _write_cache


def _state(base, spark):
    rows = StateStore(spark, base).committed_state().where("metric <> '__batch__'").collect()
    return sorted(tuple(r) for r in rows)


def _inputs(tmp_path):
    d = write_files(tmp_path / "dict", {"airports.csv": AIRPORTS, "airlines.csv": AIRLINES})
    return f"{d}/airlines.csv", f"{d}/airports.csv"


def _stream(spark, inbox, airlines, airports, base, results):
    q = start_incremental(spark, str(inbox), airlines, airports, base, results=results)
    q.awaitTermination(120)
    assert q.exception() is None


def test_stream_takes_all_files_of_one_date_and_old_files(spark, tmp_path):
    airlines, airports = _inputs(tmp_path)
    lines = [x + "\n" for x in BATCH1.strip().splitlines()]
    inbox = tmp_path / "inbox"
    write_files(inbox, {f"p{k}.csv": HEADER + line for k, line in enumerate(lines)})
    base, results = str(tmp_path / "state"), []
    _stream(spark, inbox, airlines, airports, base, results)
    assert [r.status for r in results] == ["processed"] and results[0].flights == 8
    write_files(tmp_path / "one", {"all.csv": HEADER + BATCH1})
    run_batch(spark, str(tmp_path / "direct"), str(tmp_path / "one"), airlines, airports)
    assert _state(base, spark) == _state(str(tmp_path / "direct"), spark)
    # newer flights in a file that says it is two months old; the stream resumes from the folder below the state
    write_files(inbox, {"old.csv": HEADER + BATCH2})
    long_ago = dt.datetime.now().timestamp() - 60 * 86400
    os.utime(inbox / "old.csv", (long_ago, long_ago))
    _stream(spark, inbox, airlines, airports, base, results)
    assert [r.status for r in results] == ["processed", "processed"] and results[1].flights == 3


def test_typed_frames_without_dates_or_strings(spark, tmp_path):
    airlines, airports = _inputs(tmp_path)
    write_files(tmp_path / "in", {"f.csv": HEADER + BATCH1})
    typed = read_flights_csv(spark, str(tmp_path / "in")).select(*FLIGHT_COLUMNS)
    undated = typed.selectExpr("CAST(NULL AS DATE) AS flight_date", *FLIGHT_COLUMNS[1:]).limit(1)
    with pytest.raises(Exception, match="flight without a date"):
        run_batch(spark, str(tmp_path / "a"), typed.unionByName(undated), airlines, airports)
    assert StateStore(spark, str(tmp_path / "a")).latest_commit() is None
    nulls = typed.selectExpr("flight_date", *[f"nullif({c}, '') AS {c}" for c in FLIGHT_COLUMNS[1:]])
    run_batch(spark, str(tmp_path / "b"), nulls, airlines, airports)
    run_batch(spark, str(tmp_path / "c"), typed, airlines, airports)
    assert _state(str(tmp_path / "b"), spark) == _state(str(tmp_path / "c"), spark)


def test_repeated_codes_in_a_dictionary_frame_count_once(spark, tmp_path):
    _, airports = _inputs(tmp_path)
    write_files(tmp_path / "in", {"f.csv": HEADER + BATCH1})
    twice = spark.createDataFrame([("AA", "B name"), ("AA", "A name"), ("UA", "U"), ("UA", None)], "code string, name string")
    r = run_batch(spark, str(tmp_path / "s"), str(tmp_path / "in"), twice, airports)
    rows = [(x.rank, x.airline) for x in r.metrics["top_airlines"].collect()]
    assert sorted(n for _, n in rows) == ["A name", "U"] and len({k for k, _ in rows}) == 2


def test_no_new_data_writes_no_snapshot(spark, tmp_path):
    airlines, airports = _inputs(tmp_path)
    write_files(tmp_path / "in", {"f.csv": HEADER + BATCH1})
    base = str(tmp_path / "s")
    run_batch(spark, base, str(tmp_path / "in"), airlines, airports)
    before = sorted(os.listdir(os.path.join(base, "snapshots")))
    assert run_batch(spark, base, str(tmp_path / "in"), airlines, airports).status == "no_new_data"
    assert sorted(os.listdir(os.path.join(base, "snapshots"))) == before


def test_a_second_commit_of_one_run_number_fails(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    day = dt.date(2015, 1, 1)
    store.commit(1, "0000000001-a", day, day, 1)
    with pytest.raises(RuntimeError, match="already committed"):
        store.commit(1, "0000000001-b", day, day, 2)
    assert store.latest_commit().run_id == "0000000001-a"


def test_two_writers_at_once_one_commits(spark, tmp_path):
    """Many rounds of two threads that commit the same run number at the same moment."""
    day = dt.date(2015, 1, 1)
    store = StateStore(spark, str(tmp_path / "s"))
    for seq in range(1, 21):
        start, outcome = threading.Barrier(2), []

        def write(who):
            own = StateStore(spark, str(tmp_path / "s"))
            start.wait()
            try:
                own.commit(seq, f"{seq:010d}-{who}", day, day, 1)
                outcome.append(who)
            except RuntimeError as err:
                assert "already committed" in str(err)

        threads = [threading.Thread(target=write, args=(w,)) for w in "ab"]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(outcome) == 1
        assert store.latest_commit().run_id == f"{seq:010d}-{outcome[0]}"
        assert store.current()["run_id"] == store.latest_commit().run_id
    assert store.commits().count() == 20 and not [n for n in os.listdir(tmp_path / "s" / "commits") if n.startswith(".")]


def test_two_runs_at_once_one_is_published(spark, tmp_path):
    airlines, airports = _inputs(tmp_path)
    write_files(tmp_path / "in", {"f.csv": HEADER + BATCH1})
    base, outcome = str(tmp_path / "s"), []
    start = threading.Barrier(2)

    def run():
        start.wait()
        try:
            outcome.append(run_batch(spark, base, str(tmp_path / "in"), airlines, airports).status)
        except RuntimeError:
            outcome.append("refused")

    threads = [threading.Thread(target=run) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    # the slower one is refused, or came so late that it saw the commit
    assert sorted(outcome) in (["processed", "refused"], ["no_new_data", "processed"])
    store = StateStore(spark, base)
    assert store.latest_commit().seq == 1 and store.latest_commit().flights == 8
    alone = str(tmp_path / "alone")
    run_batch(spark, alone, str(tmp_path / "in"), airlines, airports)
    assert _state(base, spark) == _state(alone, spark)


def test_pointer_is_set_again_after_a_death_between_commit_and_pointer(spark, tmp_path):
    airlines, airports = _inputs(tmp_path)
    write_files(tmp_path / "in", {"f.csv": HEADER + BATCH1})
    base = tmp_path / "s"
    first = run_batch(spark, str(base), str(tmp_path / "in"), airlines, airports)
    os.unlink(base / "current.json")
    assert run_batch(spark, str(base), str(tmp_path / "in"), airlines, airports).status == "no_new_data"
    now = json.loads((base / "current.json").read_text())
    assert now["run_id"] == first.run_id and os.path.isdir(base / now["metrics"]) and os.path.isdir(base / now["state"])


def test_commits_of_another_version_are_refused(spark, tmp_path):
    os.makedirs(tmp_path / "s" / "commits" / "run-0000000001")
    with pytest.raises(ValueError, match="not a commit of this version"):
        StateStore(spark, str(tmp_path / "s")).latest_commit()


def test_files_elsewhere_are_created_once_and_replaced(spark, tmp_path):
    """The way for file systems other than the local one (here a view of it)."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.files.link./m", f"file://{tmp_path}")
    files = SharedFiles(spark)
    base = "viewfs://files/m/x"
    assert files.names(base) == [] and files.read(f"{base}/a") is None
    assert files.create(f"{base}/a", "one") and not files.create(f"{base}/a", "two")
    assert files.read(f"{base}/a") == "one"
    files.replace(f"{base}/a", "three")
    files.replace(f"{base}/b", "é")
    assert (files.read(f"{base}/a"), files.read(f"{base}/b")) == ("three", "é")
    assert files.names(base) == ["a", "b"]


def test_archived_files_are_not_read_again(spark, tmp_path):
    """Processed files leave the inbox, and a second call reads only new ones."""
    airlines, airports = _inputs(tmp_path)
    inbox, archive, base = tmp_path / "inbox", tmp_path / "archive", str(tmp_path / "state")
    results = []

    def arrive(name, text):
        write_files(inbox, {name: HEADER + text})
        q = start_incremental(spark, str(inbox), airlines, airports, base, results=results, archive_dir=str(archive), forget_after="30d")
        q.awaitTermination(120)
        assert q.exception() is None

    def moved():
        return sorted(f for _, _, names in os.walk(archive) for f in names if f.endswith(".csv"))

    arrive("a.csv", BATCH1)
    arrive("b.csv", BATCH2)
    assert [r.flights for r in results if r.status == "processed"] == [8, 3]
    assert "a.csv" in moved() and not (inbox / "a.csv").exists()
    arrive("a.csv", BATCH1)  # an old name again: its flights are all too old, nothing is counted twice
    assert StateStore(spark, base).latest_commit().seq == 2
    run_batch(spark, str(tmp_path / "direct"), _written(tmp_path, BATCH1), airlines, airports)
    run_batch(spark, str(tmp_path / "direct"), _written(tmp_path, BATCH2), airlines, airports)
    assert _state(base, spark) == _state(str(tmp_path / "direct"), spark)
    with pytest.raises(ValueError, match="forget_after needs archive_dir"):
        start_incremental(spark, str(inbox), airlines, airports, base, forget_after="1d")


def _written(tmp_path, text):
    folder = tmp_path / f"written-{abs(hash(text))}"
    write_files(folder, {"f.csv": HEADER + text})
    return str(folder)


def test_unknown_tables_are_counted_and_the_run_goes_on(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    known = spark.range(2).selectExpr("id AS rank", "CAST(id AS STRING) AS week_day", "id AS ontime_arrivals")
    store.write_metrics({"weekdays_by_ontime": known, "x": spark.range(5).toDF("n"), "y": spark.range(0).toDF("n")}, "r")
    assert store.read_metric("r", "weekdays_by_ontime").count() == 2
    assert [tuple(r) for r in store.read_rejects("r").collect()] == [("x", 5)]
    assert sorted(r.detail for r in store.run_log().collect()) == ["unknown metric x", "unknown metric y"]
    with pytest.raises(KeyError):
        store.read_metric("r", "x")
    assert store.read_rejects("other").count() == 0


@pytest.mark.parametrize("gone", ["topTenAirlinesCache/part-00000", "delaysPerReasonsCache.csv"])
def test_cache_with_a_mark_but_without_counts_is_refused(spark, tmp_path, gone):
    cache = _write_cache(tmp_path / "cache", {k: v for k, v in CACHE_AFTER_BATCH_1.items() if k != gone})
    with pytest.raises(ValueError, match="the cache lacks " + gone.split("/")[0]):
        import_text_state(spark, cache, str(tmp_path / "s"))


def test_ranking_everything_has_no_bound_and_no_single_task(spark, tmp_path):
    """200,000 keys, a third of them with one value: the order is total, and no window holds the values."""
    rows = spark.range(200_000).selectExpr("concat('k', id) AS k", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS n", "id AS more")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_all(rows, "n", "k", False, str(tmp_path / "ranked"))
        ranks = [(r.n, r.k, r["rank"]) for r in got.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r for _, _, r in sorted(ranks, key=lambda x: (-x[0], x[1]))] == list(range(1, 200_001))
    spread = spark.read.parquet(str(tmp_path / "ranked")).groupBy("_part").count().collect()
    assert len(spread) > 4 and max(r["count"] for r in spread) < 60_000
    assert rank_all(rows.limit(0), "n", "k", True).count() == 0
    one = rank_all(spark.range(3).selectExpr("CAST(id AS STRING) AS k", "1 AS n"), "n", "k", True).collect()
    assert sorted((r.k, r["rank"]) for r in one) == [("0", 1), ("1", 2), ("2", 3)]


def test_no_local_folder_on_a_cluster(monkeypatch):
    from skytally import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
