"""Per-job profile of one run_batch from Spark's event log.

Usage: python tools/profile_run.py [sf_dir]
Writes the event log to a fresh scratch folder and prints, per job: start
offset, duration, input records read and shuffle bytes written.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytally import make_session  # noqa: E402
from skytally.plans.batch import run_batch  # noqa: E402
from skytally.plans.catalogue import Inputs  # noqa: E402
from skytally.session import scratch_dir  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skytally-profile-")
    spark = make_session(8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                   "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    i = Inputs(spark, sf)
    t0 = time.perf_counter()
    result = run_batch(spark, scratch_dir(spark, "profile"), i.flights, i.airlines, i.airports)
    print(f"run_batch: {result.status}, {result.flights} flights, {time.perf_counter() - t0:.2f}s")
    spark.stop()
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f) and "appstatus" not in f)
    jobs, stages = {}, {}
    for line in (ln for f in files for ln in open(f)):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            props = ev.get("Properties", {})
            jobs[ev["Job ID"]] = {"t": ev["Submission Time"], "stages": ev["Stage IDs"],
                                  "site": (props.get("callSite.short") or "")[:60]}
        elif kind == "SparkListenerJobEnd":
            jobs[ev["Job ID"]]["end"] = ev["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            stages[info["Stage ID"]] = (int(acc.get("internal.metrics.input.recordsRead", 0) or 0),
                                        int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0))
    start = min(j["t"] for j in jobs.values())
    print(f"{'job':>4} {'start':>7} {'dur':>6} {'records':>9} {'shuffle':>9}  call site")
    for jid in sorted(jobs):
        j = jobs[jid]
        rec = sum(stages.get(s, (0, 0))[0] for s in j["stages"])
        shf = sum(stages.get(s, (0, 0))[1] for s in j["stages"])
        print(f"{jid:4d} {(j['t'] - start) / 1000:7.2f} {(j.get('end', j['t']) - j['t']) / 1000:6.2f} "
              f"{rec:9d} {shf:9d}  {j['site']}")


if __name__ == "__main__":
    main()
