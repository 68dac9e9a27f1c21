"""Random flight files: every metric of run_batch against a plain-Python model
of the rules (brute force over the rows), including ties, unknown codes and
empty delay fields."""

import math
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import write_files
from skytally.plans.batch import RunOptions, run_batch

AIRPORTS = {"JFK": "Kennedy", "LAX": "Los Angeles", "SFO": "San Francisco", "ORD": "O Hare"}
AIRLINES = {"AA": "American", "DL": "Delta", "UA": "United"}
ORIGINS = list(AIRPORTS) + ["XXX"]
CARRIERS = list(AIRLINES) + ["ZZ"]
DELAYS = ["", "0", "0", "-3", "5", "12"]
CAUSES = ["", "0", "3", "10", "25"]

row = st.tuples(
    st.integers(1, 28), st.integers(1, 12), st.sampled_from(CARRIERS), st.sampled_from(ORIGINS),
    st.sampled_from(ORIGINS), st.sampled_from(DELAYS), st.sampled_from(DELAYS),
    st.lists(st.sampled_from(CAUSES), min_size=5, max_size=5),
)


def line(r):
    day, month, airline, origin, dest, dep, arr, causes = r
    fields = [""] * 31
    fields[0:5] = ["2015", str(month), str(day), str((day + month) % 7 + 1), airline]
    fields[7], fields[8], fields[11], fields[22] = origin, dest, dep, arr
    fields[26:31] = causes
    return ",".join(fields)


def top(counts, k, ascending):
    order = sorted(counts.items(), key=lambda kv: ((kv[1] if ascending else -kv[1]), kv[0]))
    return order[:k]


def model(rows, k=10):
    kept = [r for r in rows if r[3] in AIRPORTS and r[4] in AIRPORTS]
    m1 = top(Counter(r[3] for r in kept), k, False)
    m2 = top(Counter(r[2] for r in kept if r[5] == "0" and r[6] == "0"), k, True)
    per = {"m3": defaultdict(Counter), "m4": defaultdict(Counter)}
    for r in kept:
        if r[5] == "0":
            per["m3"][r[3]][r[2]] += 1
            per["m4"][r[3]][r[4]] += 1
    m3 = {o: top(c, k, True) for o, c in per["m3"].items()}
    m4 = {o: top(c, k, True) for o, c in per["m4"].items()}
    wd = Counter(str((r[0] + r[1]) % 7 + 1) for r in kept if r[6] == "0")
    m5 = sorted(wd.items(), key=lambda kv: (-kv[1], kv[0]))
    counts = [sum(1 for r in kept if r[7][i] not in ("", "0")) for i in range(5)]
    minutes = [sum(int(r[7][i]) for r in kept if r[7][i] not in ("", "0")) for i in range(5)]
    total = sum(minutes)
    pct = [0.0 if total == 0 else math.floor(10000.0 * m / total + 0.5) / 100.0 for m in minutes]
    return {
        "top_airports": [(AIRPORTS[c], n) for c, n in m1 if c in AIRPORTS],
        "top_airlines": [(AIRLINES[c], n) for c, n in m2 if c in AIRLINES],
        "top_carriers_per_origin": sorted((AIRPORTS[o], AIRLINES[c], n) for o, lst in m3.items()
                                          for c, n in lst if c in AIRLINES),
        "top_destinations_per_origin": sorted((AIRPORTS[o], AIRPORTS[c], n) for o, lst in m4.items()
                                              for c, n in lst),
        "weekdays_by_ontime": m5,
        "delay_reason_counts": counts,
        "delay_reason_minutes": minutes,
        "delay_reason_percent": pct,
    }


def observed(metrics):
    by_rank = lambda df, a, b: [(r[a], r[b]) for r in sorted(df.collect(), key=lambda r: r["rank"])]
    by_reason = lambda df, c: [r[c] for r in sorted(df.collect(), key=lambda r: r["reason_id"])]
    return {
        "top_airports": by_rank(metrics["top_airports"], "airport", "flights"),
        "top_airlines": by_rank(metrics["top_airlines"], "airline", "ontime_flights"),
        "top_carriers_per_origin": sorted((r.origin, r.airline, r.ontime_departures)
                                          for r in metrics["top_carriers_per_origin"].collect()),
        "top_destinations_per_origin": sorted((r.origin, r.destination, r.ontime_departures)
                                              for r in metrics["top_destinations_per_origin"].collect()),
        "weekdays_by_ontime": by_rank(metrics["weekdays_by_ontime"], "week_day", "ontime_arrivals"),
        "delay_reason_counts": by_reason(metrics["delay_reason_counts"], "flights"),
        "delay_reason_minutes": by_reason(metrics["delay_reason_minutes"], "minutes"),
        "delay_reason_percent": by_reason(metrics["delay_reason_percent"], "percent"),
    }


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(row, min_size=1, max_size=60), k=st.sampled_from([1, 2, 10]))
def test_run_matches_brute_force_model(spark, tmp_path_factory, rows, k):
    d = tmp_path_factory.mktemp("model")
    write_files(d, {
        "flights.csv": "HEADER\n" + "\n".join(line(r) for r in rows) + "\n",
        "airports.csv": "CODE,NAME\n" + "".join(f"{c},{n}\n" for c, n in AIRPORTS.items()),
        "airlines.csv": "CODE,NAME\n" + "".join(f"{c},{n}\n" for c, n in AIRLINES.items()),
    })
    want = model(rows, k)
    if not any(r[3] in AIRPORTS and r[4] in AIRPORTS for r in rows):
        r = run_batch(spark, str(d / "state"), str(d / "flights.csv"), str(d / "airlines.csv"),
                      str(d / "airports.csv"), RunOptions(k=k))
        assert r.status == "no_new_data"
        return
    r = run_batch(spark, str(d / "state"), str(d / "flights.csv"), str(d / "airlines.csv"),
                  str(d / "airports.csv"), RunOptions(k=k))
    assert r.status == "processed"
    assert observed(r.metrics) == want


@settings(max_examples=4, deadline=None)
@given(rows=st.lists(row, min_size=2, max_size=50), cut=st.integers(1, 12), overlap=st.booleans())
def test_two_runs_match_model_over_all_rows(spark, tmp_path_factory, rows, cut, overlap):
    """Rows up to a month go in the first file, the rest in the second (which
    may also repeat the first file's rows: those are late and ignored)."""
    first = [r for r in rows if r[1] <= cut]
    second = [r for r in rows if r[1] > cut]
    if not first or not second:
        return
    d = tmp_path_factory.mktemp("model2")
    write_files(d, {
        "f1.csv": "HEADER\n" + "\n".join(line(r) for r in first) + "\n",
        "f2.csv": "HEADER\n" + "\n".join(line(r) for r in second + (first if overlap else [])) + "\n",
        "airports.csv": "CODE,NAME\n" + "".join(f"{c},{n}\n" for c, n in AIRPORTS.items()),
        "airlines.csv": "CODE,NAME\n" + "".join(f"{c},{n}\n" for c, n in AIRLINES.items()),
    })
    kept = lambda rs: [r for r in rs if r[3] in AIRPORTS and r[4] in AIRPORTS]
    if not kept(first):
        return  # a first run without rows would leave no mark; covered elsewhere
    args = (str(d / "airlines.csv"), str(d / "airports.csv"))
    base = str(d / "state")
    run_batch(spark, base, str(d / "f1.csv"), *args)
    last_first = max((r[1], r[0]) for r in kept(first))
    later = [r for r in kept(second) if (r[1], r[0]) > last_first]
    r2 = run_batch(spark, base, str(d / "f2.csv"), *args)
    if not later:
        assert r2.status == "no_new_data"
        return
    assert r2.status == "processed"
    # the second run counts only rows after the first run's last date
    counted = kept(first) + later
    assert observed(r2.metrics) == model(counted)
