"""Command line: one incremental run.

    python -m skytally --base-path <dir> [--input-file flights.csv]
        [--airports-order desc] [--airlines-order asc] [--carriers-order asc]
        [--destinations-order asc] [--top 10] [--no-text] [--import-cache DIR] [--inbox DIR [--archive DIR]]

Inputs are read from ``<base>/input/`` (``<input-file>``, ``airlines.csv``,
``airports.csv``); state, published metrics (parquet and, unless
``--no-text``, plain ``name,value`` lines) and the run log go below
``<base>/state``.  The session comes from ``SparkSession.builder``, so the
master and cluster settings are those of the launching environment.  The exit status is 0 for ``processed`` and
``no_new_data``; an error is logged in the run log and re-raised.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .plans.batch import RunOptions, run_batch


def _order(value: str) -> bool:
    return value.lower() == "asc"


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="skytally", description="cumulative on-time flight metrics")
    p.add_argument("--base-path", required=True)
    p.add_argument("--input-file", default="flights.csv")
    p.add_argument("--airports-order", choices=["asc", "desc"], default="desc")
    p.add_argument("--airlines-order", choices=["asc", "desc"], default="asc")
    p.add_argument("--carriers-order", choices=["asc", "desc"], default="asc")
    p.add_argument("--destinations-order", choices=["asc", "desc"], default="asc")
    p.add_argument("--top", type=int, default=10)
    p.add_argument("--no-text", action="store_true", help="skip the plain-text metric export")
    p.add_argument("--import-cache", metavar="DIR",
                   help="import the original job's cache folder as the first run, then stop")
    p.add_argument("--inbox", metavar="DIR",
                   help="process the flight files that arrived in DIR since the last call (file stream, "
                        "availableNow), instead of --input-file")
    p.add_argument("--archive", metavar="DIR", help="with --inbox: move the files of finished batches below DIR")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("skytally").getOrCreate()
    if a.import_cache:
        from .sources.text_state import import_text_state

        commit = import_text_state(spark, a.import_cache, os.path.join(a.base_path, "state"))
        print("nothing to import" if commit is None
              else f"imported up to {commit.last_date} as run={commit.run_id}")
        return 0
    inp = os.path.join(a.base_path, "input")
    options = RunOptions(
        airports_ascending=_order(a.airports_order),
        airlines_ascending=_order(a.airlines_order),
        carriers_ascending=_order(a.carriers_order),
        destinations_ascending=_order(a.destinations_order),
        k=a.top,
        export_lines=not a.no_text,
    )
    if a.inbox:
        from .streaming import start_incremental

        results = []
        query = start_incremental(
            spark, a.inbox, os.path.join(inp, "airlines.csv"), os.path.join(inp, "airports.csv"),
            os.path.join(a.base_path, "state"),
            checkpoint_location=os.path.join(a.base_path, "inbox-checkpoint"),
            options=options, results=results, archive_dir=a.archive,
        )
        query.awaitTermination()
        for result in results:
            _report(result)
        if not results:
            print("no new files")
        return 0
    result = run_batch(
        spark,
        os.path.join(a.base_path, "state"),
        os.path.join(inp, a.input_file),
        os.path.join(inp, "airlines.csv"),
        os.path.join(inp, "airports.csv"),
        options,
    )
    _report(result)
    return 0


def _report(result) -> None:
    print(f"{result.status} run={result.run_id} flights={result.flights} "
          f"from={result.first_date} to={result.last_date}")


if __name__ == "__main__":
    sys.exit(main())
