"""Print the physical plans of the main operators (for PLANS.md)."""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytally import constants as C, make_session  # noqa: E402
from skytally.operators import clean_flights, merge_counts, metric_counts, tally  # noqa: E402
from skytally.plans import metrics as M  # noqa: E402
from skytally.plans.catalogue import Inputs  # noqa: E402
from skytally.sources import read_flights_csv  # noqa: E402


def plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    csv = sys.argv[2] if len(sys.argv) > 2 else None
    spark = make_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    i = Inputs(spark, sf)
    clean = i.clean()
    shows = {
        "M1 top_airports (global top-k + lookup)": M.top_airports(
            metric_counts(clean, C.DEPARTURES_BY_ORIGIN), i.airports),
        "M3 top_carriers_per_origin (per-group top-k + two lookups)": M.top_carriers_per_origin(
            metric_counts(clean, C.ONTIME_BY_ORIGIN_AIRLINE), i.airports, i.airlines),
        "tally merged into state (the one job that reads the input)": merge_counts(tally(clean)),
    }
    if csv:
        c = clean_flights(read_flights_csv(spark, csv), i.airports)
        shows["clean flights from text (split once, check, semi joins)"] = c
    for title, df in shows.items():
        print(f"### {title}\n\n```")
        print(plan(df).strip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
