"""One incremental run: new flights -> cumulative state -> seven metrics.

Cost model of a run, whatever the input size:

* the flights input is scanned and parsed **once**: validation, the
  incremental cut, the airport filter and the counts of all seven
  metrics happen in one job (``tally``, one aggregate whose partial
  aggregation runs before the only shuffle of the input);
* without new rows the run ends there, with a log line and nothing else;
* the new counts are written and read back, so a lost executor costs no second
  scan, and nothing that comes from the flights is cached;
* the new counts are joined to the committed state where it lies (it is bucketed by
  its keys; only the new counts are shuffled) into the new snapshot;
* the metrics are computed from the written snapshot, which holds one
  row per group, as one frame and written in one job under the same run id,
  partitioned by metric;
* one commit file makes snapshot and metrics visible together.

Dictionaries are written once per run too: as small tables of known size,
from which Catalyst and AQE choose the joins without a probe.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    BATCH,
    FLIGHT_COLUMNS,
    METRIC_NAMES,
    NOTHING_PROCESSED,
    TOP_K,
)
from ..operators import clean_flights, merge_into, tally
from ..sinks import write_metric_lines
from ..sources import read_dictionary_csv, read_flights_csv
from ..state import STATE_BUCKETS, StateStore
from . import metrics as M


@dataclass(frozen=True)
class RunOptions:
    """Sort directions of the four rankings, their length, and whether the
    metrics are also exported as plain text lines (the original format).
    ``state_buckets`` counts for the first run; later ones keep its number."""

    airports_ascending: bool = False
    airlines_ascending: bool = True
    carriers_ascending: bool = True
    destinations_ascending: bool = True
    k: int = TOP_K
    export_lines: bool = False
    state_buckets: int = STATE_BUCKETS

    def __post_init__(self):
        if not isinstance(self.state_buckets, int) or self.state_buckets < 1:
            raise ValueError(f"state_buckets must be a positive integer, got {self.state_buckets!r}")
        if not isinstance(self.k, int) or self.k < 1:
            raise ValueError(f"k must be a positive integer, got {self.k!r}")

    @property
    def ascending(self) -> dict[str, bool]:
        """Direction of each ranking by the name of its table."""
        return {"top_airports": self.airports_ascending, "top_airlines": self.airlines_ascending,
                "top_carriers_per_origin": self.carriers_ascending, "top_destinations_per_origin": self.destinations_ascending}


# Columns and order of each metric in the plain-line export: names and
# counts only, ``name,value`` per line as in the original output files.
LINE_LAYOUT = {
    "top_airports": (["airport", "flights"], ["rank"]),
    "top_airlines": (["airline", "ontime_flights"], ["rank"]),
    "top_carriers_per_origin": (["origin", "airline", "ontime_departures"], ["origin", "rank"]),
    "top_destinations_per_origin": (["origin", "destination", "ontime_departures"], ["origin", "rank"]),
    "weekdays_by_ontime": (["week_day", "ontime_arrivals"], ["rank"]),
    "delay_reason_counts": (["reason", "flights"], ["reason_id"]),
    "delay_reason_percent": (["reason", "percent"], ["reason_id"]),
    "delay_reason_minutes": (["reason", "minutes"], ["reason_id"]),
}


@dataclass
class BatchResult:
    status: str  # "processed" or "no_new_data"
    run_id: str | None
    first_date: _dt.date | None
    last_date: _dt.date | None
    flights: int
    metrics: Mapping[str, DataFrame] = field(default_factory=dict)


def _require(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {', '.join(missing)}; has {', '.join(df.columns)}")


def _as_flights(spark: SparkSession, flights: DataFrame | str | list[str]) -> DataFrame:
    if isinstance(flights, (str, list)):
        return read_flights_csv(spark, flights)
    _require(flights, FLIGHT_COLUMNS, "flights")
    # A typed source reports no malformed rows itself: a missing date aborts the
    # run as it does for text, missing strings are empty fields.
    undated = F.when(F.col("flight_date").isNull(), F.lit("flight without a date"))
    problem = F.coalesce(F.col("_problem"), undated) if "_problem" in flights.columns else undated
    return flights.select("flight_date", *[F.coalesce(c, F.lit("")).alias(c) for c in FLIGHT_COLUMNS[1:]], problem.alias("_problem"))


def _as_dictionary(spark: SparkSession, d: DataFrame | str | list[str], what: str) -> DataFrame:
    if isinstance(d, (str, list)):
        return read_dictionary_csv(spark, d)
    _require(d, ["code", "name"], what)
    # A frame has no order of rows: of a repeated code the smallest name is kept.
    return d.groupBy(F.col("code").cast("string").alias("code")).agg(F.coalesce(F.min(F.col("name").cast("string")), F.lit("")).alias("name"))


def run_batch(
    spark: SparkSession,
    base_path: str,
    flights: DataFrame | str | list[str],
    airlines: DataFrame | str | list[str],
    airports: DataFrame | str | list[str],
    options: RunOptions = RunOptions(),
) -> BatchResult:
    """Process the flights newer than the last committed run.

    ``flights`` is a flights CSV path or a frame of the 12 flight columns
    (``flight_date`` DATE, the rest strings, '' or NULL for missing; optionally
    ``_problem`` from the text parser); ``airlines``/``airports`` are
    dictionary CSV paths or ``(code, name)`` frames (of a code that occurs
    several times in a frame the smallest name counts).  A row without a date
    aborts the run.
    On error the run is logged as ``error`` and the exception re-raised;
    nothing is published.  With no new rows the status is ``no_new_data``
    and nothing changes.
    """
    store = StateStore(spark, base_path)
    run_id = None
    try:
        previous = store.latest_commit()
        store.point_to_current()  # a run that died after its commit may not have done so
        mark = previous.last_date if previous else NOTHING_PROCESSED
        seq, run_id = store.new_run(previous)
        store.write_dictionaries(run_id, airports=_as_dictionary(spark, airports, "airports"),
                                 airlines=_as_dictionary(spark, airlines, "airlines"))
        clean = clean_flights(_as_flights(spark, flights), store.read_dictionary(run_id, "airports"), mark)

        # The input is scanned once: its counts (one row per group) are written, and say
        # whether there is anything new before a snapshot is written.
        new = store.write_counts(tally(clean), run_id)
        batch = {r.k1: r.n for r in new.where(F.col("metric") == BATCH).select("k1", "n").collect()}  # three rows
        n_rows = int(batch.get("rows", 0))
        if n_rows == 0:
            store.log(run_id, ("no_new_data", f"no flights after {mark.isoformat()}"))
            return BatchResult("no_new_data", None, None, None, 0,
                               _published(store, previous.run_id) if previous else {})
        buckets = previous.buckets if previous else options.state_buckets
        if previous is None:
            store.write_snapshot(new, run_id, buckets)
        else:
            # The new batch rows pass through the merge unchanged (the old ones are
            # left out: they describe the previous run).
            with store.bucketed(previous.run_id, buckets) as old:
                store.write_snapshot(merge_into(old.where(F.col("metric") != BATCH), new), run_id, buckets, in_place=True)
        epoch = _dt.date(1970, 1, 1)
        first = epoch + _dt.timedelta(days=int(batch["first_day"]))
        last = epoch + _dt.timedelta(days=int(batch["last_day"]))

        state = store.read_snapshot(run_id).where(F.col("metric") != BATCH)
        store.write_metric_rows(M.published_rows(state, store.read_dictionaries(run_id), options.ascending, options.k,
                                                 store.ranked_path(run_id)), run_id)
        if options.export_lines:
            with ThreadPoolExecutor(max_workers=len(LINE_LAYOUT)) as pool:
                jobs = []
                for name, (cols, order) in LINE_LAYOUT.items():
                    published = store.read_metric(run_id, name)
                    jobs.append(pool.submit(write_metric_lines, published, store.lines_path(run_id, name),
                                            cols, order))
                for f in jobs:
                    f.result()

        store.commit(seq, run_id, first, last, n_rows, buckets)
        store.log(run_id, ("collected", f"flights from {first.isoformat()} to {last.isoformat()}"),
                  ("processed", f"{n_rows} flights"))
        return BatchResult("processed", run_id, first, last, n_rows, _published(store, run_id))
    except Exception as err:
        message = str(err).strip().splitlines()[0][:2000] if str(err).strip() else type(err).__name__
        try:
            store.log(run_id, ("error", message))
        except Exception:  # the original error matters more than the log line
            pass
        raise


class _Published(Mapping):
    """The published metric tables of a run, each read when first asked for."""

    def __init__(self, store: StateStore, run_id: str):
        self._store = store
        self._run_id = run_id
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in METRIC_NAMES:
            raise KeyError(name)
        if name not in self._read:
            self._read[name] = self._store.read_metric(self._run_id, name)
        return self._read[name]

    def __iter__(self):
        return iter(METRIC_NAMES)

    def __len__(self) -> int:
        return len(METRIC_NAMES)


def _published(store: StateStore, run_id: str) -> Mapping[str, DataFrame]:
    return _Published(store, run_id)
