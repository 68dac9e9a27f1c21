"""Benchmark of the headline queries.

Runs on ``local[$BENCH_CPUS]`` (default 8) over ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) and prints ONE JSON line:

  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., "profile": {...}}

Each query is executed to completion with the ``noop`` sink (no driver
transfer); the time reported per query is the median of
``$BENCH_REPEAT`` (default 3) warm runs; ``value`` is their sum.
``run_batch_full`` is one complete incremental run (all seven metrics,
fresh state, commit).  ``profile`` is read from Spark's event log (written
to a fresh folder below the checkpoint root by a second session, so the log does not slow the
timed runs): jobs, stages, input records read and shuffle bytes of one full
run, next to the records read by one plain scan of the flights view.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_flights",
    "top_airports_desc",
    "top_airlines_asc",
    "top_carriers_per_origin_asc",
    "top_destinations_per_origin_asc",
    "weekdays_by_ontime",
    "delay_reason_counts",
    "delay_reason_percent",
    "merge_counts",
    "csv_scan_roundtrip",
    "incremental_two_batches",
    "full_run_metrics",
]


def _profile(log_dir: str, windows: dict[str, tuple[int, int]]) -> dict:
    """Sum stage metrics of the jobs submitted inside each time window."""
    # Spark 4 writes rolling logs: a folder of ``events_<n>_...`` files.
    files = sorted(
        (f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
         if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus")),
        key=lambda f: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", f)],
    )
    job_stages, job_time, stage_metrics = {}, {}, {}
    for line in (ln for f in files for ln in open(f)):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            job_stages[ev["Job ID"]] = ev.get("Stage IDs", [])
            job_time[ev["Job ID"]] = ev.get("Submission Time", 0)
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            stage_metrics[info["Stage ID"]] = {
                "tasks": info.get("Number of Tasks", 0),
                "input": int(acc.get("internal.metrics.input.recordsRead", 0) or 0),
                "shuffle": int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
            }
    out = {}
    for label, (t0, t1) in windows.items():
        jobs = [j for j, t in job_time.items() if t0 <= t <= t1]
        stages = {s for j in jobs for s in job_stages[j] if s in stage_metrics}
        out[label] = {
            "jobs": len(jobs),
            "stages_run": len(stages),
            "records_read": sum(stage_metrics[s]["input"] for s in stages),
            "shuffle_write_bytes": sum(stage_metrics[s]["shuffle"] for s in stages),
        }
    return out


def _scaling(spark, sf_dir: str) -> dict:
    """The one input job of a run (tally merged into state) over the flights
    view unioned with itself 1x and 10x: seconds and input rows per second."""
    from functools import reduce

    from skytally.operators import clean_flights, merge_counts, tally
    from skytally.plans.catalogue import Inputs

    i = Inputs(spark, sf_dir)
    rows = i.flights.count()
    out = {}
    for k in (1, 10):
        flights = reduce(lambda a, b: a.unionByName(b), [i.flights] * k)
        job = merge_counts(tally(clean_flights(flights, i.airports)))
        job.write.format("noop").mode("overwrite").save()
        t0 = time.perf_counter()
        job.write.format("noop").mode("overwrite").save()
        sec = time.perf_counter() - t0
        out[f"x{k}"] = {"input_rows": rows * k, "sec": round(sec, 3), "rows_per_sec": int(rows * k / sec)}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from skytally import make_session
    from skytally.plans.batch import run_batch
    from skytally.plans.catalogue import QUERIES, Inputs
    from skytally.session import scratch_dir

    def session(extra=None):
        s = make_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="skytally-bench",
                         extra=extra)
        s.sparkContext.setLogLevel("ERROR")
        return s

    spark = session()
    # event log of the profiling session: a fresh folder below the shared checkpoint root
    log_dir = scratch_dir(spark, "eventlog")
    os.makedirs(log_dir, exist_ok=True)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    def full_run() -> float:
        i = Inputs(spark, sf_dir)
        t0 = time.perf_counter()
        run_batch(spark, scratch_dir(spark, "bench"), i.flights, i.airlines, i.airports)
        return time.perf_counter() - t0

    def control() -> float:
        """A fixed job that depends on no table and no code of this repository: how fast the machine is just now."""
        t0 = time.perf_counter()
        spark.range(0, 20_000_000, 1, 8).selectExpr("id % 1000 AS k", "id * 3 AS v").groupBy("k").sum("v").write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    control()
    names = only or HEADLINE
    for name in names:  # JVM, JIT and codegen warm-up: every query once, untimed
        run(name)
    times = {}
    controls = []
    for name in names:
        controls.append(control())
        runs = [run(name) for _ in range(repeat)]
        times[name] = round(statistics.median(runs), 3)
    windows = {}
    scaling = {}
    if not only:
        times["run_batch_full"] = round(statistics.median([full_run() for _ in range(repeat)]), 3)
        scaling = _scaling(spark, sf_dir)
    spark.stop()

    if not only:
        # Separate session with the event log on (it slows every job down a little).
        spark = session({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                         "spark.eventLog.compress": "false"})
        i = Inputs(spark, sf_dir)
        t0 = int(time.time() * 1000)
        run_batch(spark, scratch_dir(spark, "bench"), i.flights, i.airlines, i.airports)
        windows["run_batch_full"] = (t0, int(time.time() * 1000))
        time.sleep(0.05)
        t0 = int(time.time() * 1000)
        i.flights.write.format("noop").mode("overwrite").save()
        windows["flights_scan_only"] = (t0, int(time.time() * 1000))
        spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    # Seconds of the control job between the queries, and each query in multiples of it.
    out["control_sec"] = round(statistics.median(controls), 3)
    out["relative"] = {k: round(v / out["control_sec"], 2) for k, v in times.items()}
    if scaling:
        out["scaling"] = scaling
    if windows:
        try:
            out["profile"] = _profile(log_dir, windows)
        except Exception as err:  # the timings matter more than the profile
            out["profile"] = {"error": str(err)[:200]}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
