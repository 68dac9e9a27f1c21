"""Named queries over the provided tables, one per operator of the job.

Every query takes ``(spark, sf_dir)``, derives flights and dictionaries
from the tables under ``sf_dir`` (see ``sources.tables``) and returns a
DataFrame.  Queries of the incremental cycle write their state below the
session's shared checkpoint folder, each call in a new subfolder.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from .. import constants as C
from ..functions import date_lit
from ..operators import (
    batch_date_range,
    clean_flights,
    merge_counts,
    merge_into,
    metric_counts,
    ontime_departures,
    rank_all,
    reason_totals,
    reasons_from_counts,
    slice_metric,
    tally,
)
from ..session import scratch_dir
from ..sinks import read_metric_lines, write_metric_lines, write_text_with_header
from ..sources import (
    airlines_from_tables,
    airports_from_tables,
    flights_from_tables,
    read_dictionary_csv,
    read_flights_csv,
    table,
)
from ..state import STATE_BUCKETS, StateStore
from . import metrics as M
from .batch import LINE_LAYOUT, RunOptions, run_batch

# Fixed parameters of the test queries.
MARK = _dt.date(1999, 12, 31)        # split point of all incremental queries
LATE_FROM = _dt.date(1999, 7, 1)     # second batch re-sends rows from here on
AFTER_ALL = _dt.date(2100, 1, 1)     # a cut that leaves no rows
FILE_LINES = 1_000_000               # lines of an inbox file at most


class Inputs:
    """Flights view and dictionaries of one table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.flights = flights_from_tables(spark, sf_dir)
        self.airports = airports_from_tables(spark, sf_dir)
        self.airlines = airlines_from_tables(spark, sf_dir)

    def clean(self, after: _dt.date | None = None) -> DataFrame:
        return clean_flights(self.flights, self.airports, after)


def _dates_as_text(df: DataFrame) -> DataFrame:
    """DATE columns rendered as ISO text (``yyyy-MM-dd``).

    Only for the query outputs checked against SQL on another engine: a DATE
    comes back as a date object from one side and as a midnight timestamp
    from the other, while the text is the same everywhere.  The library
    itself returns real DATE columns.
    """
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, DateType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _no_batch(state: DataFrame) -> DataFrame:
    return state.where(F.col("metric") != C.BATCH)


# -- cleaning, filters, projections --------------------------------------------

def q_clean_flights(spark, sf_dir):
    return _dates_as_text(Inputs(spark, sf_dir).clean())


def q_ontime_departures(spark, sf_dir):
    return ontime_departures(Inputs(spark, sf_dir).clean())


def q_incremental_filter(spark, sf_dir):
    return _dates_as_text(Inputs(spark, sf_dir).clean(MARK))


def q_batch_date_range(spark, sf_dir):
    return _dates_as_text(batch_date_range(Inputs(spark, sf_dir).clean(MARK)))


# -- plain counts ----------------------------------------------------------------

def _counts(spark, sf_dir, metric, names):
    c = metric_counts(Inputs(spark, sf_dir).clean(), metric)
    cols = [F.col("k1").alias(names[0])]
    if len(names) == 3:
        cols.append(F.col("k2").alias(names[1]))
    return c.select(*cols, F.col("n").alias(names[-1]))


def q_departures_by_origin(spark, sf_dir):
    return _counts(spark, sf_dir, C.DEPARTURES_BY_ORIGIN, ["origin_airport", "flights"])


def q_ontime_count_by_airline(spark, sf_dir):
    return _counts(spark, sf_dir, C.ONTIME_BY_AIRLINE, ["airline", "ontime_flights"])


def q_ontime_count_by_weekday(spark, sf_dir):
    return _counts(spark, sf_dir, C.ONTIME_ARRIVALS_BY_WEEKDAY, ["week_day", "ontime_arrivals"])


def q_ontime_by_origin_airline(spark, sf_dir):
    return _counts(spark, sf_dir, C.ONTIME_BY_ORIGIN_AIRLINE, ["origin_airport", "airline", "ontime_departures"])


def q_ontime_by_origin_destination(spark, sf_dir):
    return _counts(spark, sf_dir, C.ONTIME_BY_ORIGIN_DEST,
                   ["origin_airport", "destination_airport", "ontime_departures"])


# -- the seven metrics -------------------------------------------------------------

def _top_airports(ascending):
    def q(spark, sf_dir):
        i = Inputs(spark, sf_dir)
        return M.top_airports(metric_counts(i.clean(), C.DEPARTURES_BY_ORIGIN), i.airports, ascending)
    return q


def _top_airlines(ascending):
    def q(spark, sf_dir):
        i = Inputs(spark, sf_dir)
        return M.top_airlines(metric_counts(i.clean(), C.ONTIME_BY_AIRLINE), i.airlines, ascending)
    return q


def _top_carriers(ascending):
    def q(spark, sf_dir):
        i = Inputs(spark, sf_dir)
        return M.top_carriers_per_origin(metric_counts(i.clean(), C.ONTIME_BY_ORIGIN_AIRLINE),
                                         i.airports, i.airlines, ascending)
    return q


def _top_destinations(ascending):
    def q(spark, sf_dir):
        i = Inputs(spark, sf_dir)
        return M.top_destinations_per_origin(metric_counts(i.clean(), C.ONTIME_BY_ORIGIN_DEST),
                                             i.airports, ascending)
    return q


def q_weekdays_by_ontime(spark, sf_dir):
    return M.weekdays_by_ontime(metric_counts(Inputs(spark, sf_dir).clean(), C.ONTIME_ARRIVALS_BY_WEEKDAY))


def q_delay_reason_counts(spark, sf_dir):
    return M.delay_reason_counts(reason_totals(Inputs(spark, sf_dir).clean(), minutes=False))


def q_delay_reason_minutes(spark, sf_dir):
    return M.delay_reason_minutes(reason_totals(Inputs(spark, sf_dir).clean(), counts=False))


def q_delay_reason_percent(spark, sf_dir):
    return M.delay_reason_percent(reason_totals(Inputs(spark, sf_dir).clean(), counts=False))


def q_delay_percent_empty(spark, sf_dir):
    return M.delay_reason_percent(reason_totals(Inputs(spark, sf_dir).clean(AFTER_ALL), counts=False))


# -- merging counts ----------------------------------------------------------------

def _split_tallies(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    clean = i.clean()
    before = tally(clean.where(F.col("flight_date") <= date_lit(MARK)))
    after = tally(clean.where(F.col("flight_date") > date_lit(MARK)))
    return merge_counts(_no_batch(before), _no_batch(after))


def q_merge_counts(spark, sf_dir):
    return _split_tallies(spark, sf_dir)


def q_merge_reason_totals(spark, sf_dir):
    totals = reasons_from_counts(_split_tallies(spark, sf_dir))
    return M.delay_reason_counts(totals).join(M.delay_reason_minutes(totals), ["reason_id", "reason"])


# -- sources and sinks ---------------------------------------------------------------

def q_dictionary_last_wins(spark, sf_dir):
    """All nations written as an airport dictionary in which those of region 0
    appear a second time, later, with a new name; read back."""
    nation = table(spark, sf_dir, "nation")
    first = nation.select(F.lit(0).alias("seq"), "n_nationkey", F.col("n_name").alias("name"))
    again = nation.where(F.col("n_regionkey") == 0).select(
        F.lit(1).alias("seq"), "n_nationkey", F.lower("n_name").alias("name"))
    lines = first.unionByName(again).orderBy("seq", "n_nationkey").select(
        F.concat_ws(",", F.col("n_nationkey").cast("string"), "name", F.lit("extra")).alias("line"))
    path = scratch_dir(spark, "airports-csv")
    write_text_with_header(lines, path, header="code,name,note")
    return read_dictionary_csv(spark, path)


def q_dictionary_last_wins_airlines(spark, sf_dir):
    """All suppliers written as an airline dictionary in which every seventh
    appears a second time, later, with a new name; read back."""
    supplier = table(spark, sf_dir, "supplier")
    first = supplier.select(F.lit(0).alias("seq"), "s_suppkey", F.col("s_name").alias("name"))
    again = supplier.where(F.col("s_suppkey") % 7 == 0).select(
        F.lit(1).alias("seq"), "s_suppkey", F.lower("s_name").alias("name"))
    lines = first.unionByName(again).orderBy("seq", "s_suppkey").select(
        F.concat_ws(",", F.col("s_suppkey").cast("string"), "name").alias("line"))
    path = scratch_dir(spark, "airlines-csv")
    write_text_with_header(lines, path, header="code,name")
    return read_dictionary_csv(spark, path)


def flight_lines(flights: DataFrame) -> DataFrame:
    """Flights as 31-field comma-separated lines (month and day unpadded,
    unused positions empty) - the raw input layout."""
    pos = {v: k for k, v in C.FIELD_POSITIONS.items()}
    d = F.col("flight_date")
    raw = {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}
    fields = []
    for i in range(C.MIN_FIELDS):
        name = pos.get(i)
        if name is None:
            fields.append(F.lit(""))
        else:
            fields.append((raw[name] if name in raw else F.col(name)).cast("string"))
    return flights.select(F.concat_ws(",", *fields).alias("line"))


def q_csv_scan_roundtrip(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    path = scratch_dir(spark, "flights-csv")
    write_text_with_header(flight_lines(i.flights), path, header="year,month,day,rest")
    clean = clean_flights(read_flights_csv(spark, path), i.airports)
    return _dates_as_text(clean)


def q_state_roundtrip(spark, sf_dir):
    store = StateStore(spark, scratch_dir(spark, "state"))
    store.write_snapshot(tally(Inputs(spark, sf_dir).clean()), "roundtrip")
    return store.read_snapshot("roundtrip")


_M3_LINE_SCHEMA = "origin STRING, airline STRING, ontime_departures BIGINT, rank BIGINT"


def q_metrics_sink_roundtrip(spark, sf_dir):
    m3 = _top_carriers(True)(spark, sf_dir)
    path = scratch_dir(spark, "metric-lines")
    write_metric_lines(m3, path, ["origin", "airline", "ontime_departures", "rank"], ["origin_code", "rank"])
    return read_metric_lines(spark, path, _M3_LINE_SCHEMA)


def q_text_state_roundtrip(spark, sf_dir):
    """One-shot counts written in the original job's cache formats (count
    folders, five-counter lines, mark file), imported, read back."""
    from ..sources import text_state as T

    store = StateStore(spark, scratch_dir(spark, "text-source"))
    store.write_snapshot(tally(Inputs(spark, sf_dir).clean()), "counted")  # the flights are scanned once
    counts = store.read_snapshot("counted")
    cache = scratch_dir(spark, "text-cache")

    def write(df, name):
        df.write.mode("errorifexists").text(f"{cache}/{name}")

    for folder, metric in T.SINGLE_KEY_FOLDERS.items():
        write(counts.where(F.col("metric") == metric).select(F.concat_ws(",", "k1", "n")), folder)
    for folder, metric in T.PAIR_KEY_FOLDERS.items():
        pair = F.concat(F.lit("("), F.col("k1"), F.lit(","), F.col("k2"), F.lit("),"), F.col("n").cast("string"))
        write(counts.where(F.col("metric") == metric).select(pair), folder)
    totals = reasons_from_counts(counts)
    for name, metric in T.FIVE_COUNTER_FILES.items():
        prefix = "c_" if metric == C.REASON_COUNT else "m_"
        write(totals.select(F.concat_ws(",", *[F.col(f"{prefix}{c}").cast("string")
                                               for c, _ in C.DELAY_REASONS])), name)
    last_day = counts.where((F.col("metric") == C.BATCH) & (F.col("k1") == "last_day"))
    write(last_day.select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("n").cast("int")).cast("string")),
          T.MARK_FILE)
    base = scratch_dir(spark, "imported")
    T.import_text_state(spark, cache, base)
    return _no_batch(StateStore(spark, base).committed_state())


# -- the incremental cycle -------------------------------------------------------------

def _runs(spark, sf_dir, second_from: _dt.date | None, repeat_second: bool = False):
    i = Inputs(spark, sf_dir)
    base = scratch_dir(spark, "runs")
    d = F.col("flight_date")
    first = run_batch(spark, base, i.flights.where(d <= date_lit(MARK)), i.airlines, i.airports)
    second_in = i.flights.where(d > date_lit(MARK)) if second_from is None else i.flights.where(d >= date_lit(second_from))
    second = run_batch(spark, base, second_in, i.airlines, i.airports)
    results = [first, second]
    if repeat_second:
        results.append(run_batch(spark, base, second_in, i.airlines, i.airports))
    return StateStore(spark, base), results


def q_incremental_two_batches(spark, sf_dir):
    store, _ = _runs(spark, sf_dir, None)
    return _no_batch(store.committed_state())


def q_incremental_late_rows_ignored(spark, sf_dir):
    store, _ = _runs(spark, sf_dir, LATE_FROM)
    return _no_batch(store.committed_state())


def q_incremental_hwm(spark, sf_dir):
    store, _ = _runs(spark, sf_dir, None)
    return _dates_as_text(store.commits().select("seq", "first_date", "last_date", "flights"))


def q_incremental_no_new_data(spark, sf_dir):
    store, results = _runs(spark, sf_dir, None, repeat_second=True)
    if results[-1].status != "no_new_data":
        raise AssertionError(f"third run should find no new data, got {results[-1].status}")
    return _no_batch(store.committed_state())


def q_publish_ignores_uncommitted(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    base = scratch_dir(spark, "runs")
    run_batch(spark, base, i.flights.where(F.col("flight_date") <= date_lit(MARK)), i.airlines, i.airports)
    store = StateStore(spark, base)
    # A run that wrote its snapshot (all flights) but never committed.
    _, run_id = store.new_run(store.latest_commit())
    store.write_snapshot(tally(i.clean()), run_id)
    return _no_batch(store.committed_state())


def q_run_log(spark, sf_dir):
    store, _ = _runs(spark, sf_dir, None, repeat_second=True)
    log = store.run_log().join(store.commits().select("run_id", "seq"), "run_id", "left")
    # seq 0: the run was not committed (no new data)
    return log.select(F.coalesce("seq", F.lit(0).cast("long")).alias("seq"), "status", "detail")


def _written_inputs(spark, sf_dir, i: Inputs) -> tuple[str, str, str, str]:
    """Paths of two flights folders (up to the mark, after it) and both dictionaries, as text."""
    folder = scratch_dir(spark, "text-inputs")
    d = F.col("flight_date")
    for name, rows in (("first", i.flights.where(d <= date_lit(MARK))), ("second", i.flights.where(d > date_lit(MARK)))):
        write_text_with_header(flight_lines(rows), f"{folder}/{name}", header="year,month,day,rest")
    for name, rows in (("airlines", i.airlines), ("airports", i.airports)):
        write_text_with_header(rows.select(F.concat_ws(",", "code", "name").alias("line")), f"{folder}/{name}", header="code,name")
    return tuple(f"{folder}/{n}" for n in ("first", "second", "airlines", "airports"))


def q_full_run_from_text(spark, sf_dir):
    """The job as users start it: flights and dictionaries as text paths, two runs."""
    first, second, airlines, airports = _written_inputs(spark, sf_dir, Inputs(spark, sf_dir))
    base = scratch_dir(spark, "runs")
    run_batch(spark, base, first, airlines, airports)
    return stack_metrics(run_batch(spark, base, second, airlines, airports).metrics)


def write_arrival(flights: DataFrame, inbox: str, most: int) -> None:
    """Add flights to an inbox as raw text files of ``most`` lines at most, from the partitions they lie in."""
    lines = flight_lines(flights)
    lines.select(F.col(lines.columns[0]).alias("line")).write.mode("append").option("maxRecordsPerFile", most) \
        .option("header", True).option("sep", "\u001f").option("emptyValue", "") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(inbox)


def q_stream_two_arrivals(spark, sf_dir):
    """The file stream over an inbox that gets two arrivals of several files each."""
    from ..streaming import start_incremental

    i = Inputs(spark, sf_dir)
    base, inbox = scratch_dir(spark, "runs"), scratch_dir(spark, "inbox")
    d = F.col("flight_date")
    # several files each: of a million lines, or a sixth of the flights where they are few
    most = max(1, min(FILE_LINES, table(spark, sf_dir, "lineitem").count() // 6))
    for rows in (i.flights.where(d <= date_lit(MARK)), i.flights.where(d > date_lit(MARK))):
        write_arrival(rows, inbox, most)
        query = start_incremental(spark, inbox, i.airlines, i.airports, base)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return _no_batch(StateStore(spark, base).committed_state())


def q_repeated_dictionary_codes(spark, sf_dir):
    """Dictionaries given as frames in which every code occurs twice: the smallest name counts."""
    i = Inputs(spark, sf_dir)
    again = lambda d: d.unionByName(d.select("code", F.concat("name", F.lit(" (again)")).alias("name")))
    return stack_metrics(run_batch(spark, scratch_dir(spark, "runs"), i.flights, again(i.airlines), again(i.airports)).metrics)


def q_current_metrics(spark, sf_dir):
    """The newest metrics as a reader without this package finds them: ``current.json``, then plain Parquet."""
    store, _ = _runs(spark, sf_dir, None)
    now = spark.read.json(f"{store.base}/current.json").first()  # one small line
    tables = spark.read.parquet(f"{store.base}/{now.metrics}")
    return stack_metrics({name: tables.where(F.col("metric") == name) for name in now.tables})


def q_exclusive_commit(spark, sf_dir):
    """Two writers of one run number, the second with all flights: it is refused and nothing of it is seen."""
    i = Inputs(spark, sf_dir)
    store = StateStore(spark, scratch_dir(spark, "runs"))
    seq, _ = store.new_run(None)
    refused = 0
    for rows in (i.flights.where(F.col("flight_date") <= date_lit(MARK)), i.flights):
        _, run_id = store.new_run(None)
        store.write_snapshot(tally(clean_flights(rows, i.airports)), run_id)
        try:
            store.commit(seq, run_id, MARK, MARK, 0)
        except RuntimeError:
            refused += 1
    if refused != 1:
        raise AssertionError(f"one of two writers should be refused, not {refused}")
    return _no_batch(store.committed_state())


def q_merge_in_buckets(spark, sf_dir):
    """New counts joined to a bucketed state, which is read where it lies, and written in the same buckets."""
    i = Inputs(spark, sf_dir)
    store = StateStore(spark, scratch_dir(spark, "runs"))
    d = F.col("flight_date")
    store.write_snapshot(_no_batch(tally(i.clean().where(d <= date_lit(MARK)))), "old")
    new = _no_batch(store.write_counts(tally(i.clean().where(d > date_lit(MARK))), "new"))
    with store.bucketed("old", STATE_BUCKETS) as old:
        store.write_snapshot(merge_into(old, new), "new", in_place=True)
    return store.read_snapshot("new")


def q_reuse_one_scan(spark, sf_dir):
    """What a run keeps of its one scan: the written counts, and the state that came from them."""
    i = Inputs(spark, sf_dir)
    base = scratch_dir(spark, "runs")
    run_id = run_batch(spark, base, i.flights, i.airlines, i.airports).run_id
    store = StateStore(spark, base)
    kept = store.read_counts(run_id).select(F.lit("counts").alias("held"), "*")
    return kept.unionByName(store.read_snapshot(run_id).select(F.lit("state").alias("held"), "*"))


def q_all_airlines_ranked(spark, sf_dir):
    """All airlines in the order of their on-time flights."""
    c = metric_counts(Inputs(spark, sf_dir).clean(), C.ONTIME_BY_AIRLINE)
    c = c.select(F.col("k1").alias("airline_code"), F.col("n").alias("ontime_flights"))
    return rank_all(c, "ontime_flights", "airline_code", ascending=False)


def q_unknown_metric_rejected(spark, sf_dir):
    """A run's tables with one that the job does not know: it is counted as rejected, the others are published."""
    i = Inputs(spark, sf_dir)
    store = StateStore(spark, scratch_dir(spark, "runs"))
    _, run_id = store.new_run(None)
    counts = store.write_counts(tally(i.clean()), run_id)
    totals = reasons_from_counts(_no_batch(counts))
    by_airline = slice_metric(counts, C.ONTIME_BY_AIRLINE)
    store.write_metrics({"delay_reason_counts": M.delay_reason_counts(totals), "flights_by_airline": by_airline,
                         "top_airports": M.top_airports(slice_metric(counts, C.DEPARTURES_BY_ORIGIN), i.airports)}, run_id)
    out = store.read_rejects(run_id).select("metric", F.lit("rejected").alias("outcome"), F.col("rejected").alias("n_rows"))
    for name in ("delay_reason_counts", "top_airports"):
        there = store.read_metric(run_id, name).agg(F.count(F.lit(1)).alias("n_rows"))
        out = out.unionByName(there.select(F.lit(name).alias("metric"), F.lit("published").alias("outcome"), "n_rows"))
    said = store.run_log().where("status = 'rejected'").groupBy("detail").agg(F.count(F.lit(1)).alias("n_rows"))
    return out.unionByName(said.select(F.col("detail").alias("metric"), F.lit("logged").alias("outcome"), "n_rows"))


#: The four rankings the other way round.
REVERSED = RunOptions(airports_ascending=True, airlines_ascending=False, carriers_ascending=False, destinations_ascending=False)


def q_full_run_reversed(spark, sf_dir):
    """One run with all four sort directions other than the defaults."""
    i = Inputs(spark, sf_dir)
    return stack_metrics(run_batch(spark, scratch_dir(spark, "runs"), i.flights, i.airlines, i.airports, REVERSED).metrics)


def q_metric_lines_all(spark, sf_dir):
    """All metrics of a run exported as plain lines and read back: (metric, line)."""
    i = Inputs(spark, sf_dir)
    base = scratch_dir(spark, "runs")
    result = run_batch(spark, base, i.flights, i.airlines, i.airports, RunOptions(export_lines=True))
    store = StateStore(spark, base)
    out = None
    for name in LINE_LAYOUT:
        lines = spark.read.text(store.lines_path(result.run_id, name)).select(F.lit(name).alias("metric"), F.col("value").alias("line"))
        out = lines if out is None else out.unionByName(lines)
    # a percentage is written as 12.5 here and may be written as 12.50 elsewhere
    number = F.regexp_replace("line", "^.*,", "").cast("double") * 100
    key = F.regexp_replace("line", ",[^,]*$", "")
    percent = F.col("metric") == "delay_reason_percent"
    return out.select("metric", F.when(percent, F.concat_ws(",", key, F.round(number).cast("long").cast("string"))).otherwise(F.col("line")).alias("line"))


def q_full_run_metrics(spark, sf_dir):
    """M0: every metric of a two-run cycle, stacked as ``(metric, key, n)``
    rows so one frame carries them all (percentages x 100 as integers)."""
    store, results = _runs(spark, sf_dir, None)
    return stack_metrics(results[-1].metrics)


def stack_metrics(metrics: dict[str, DataFrame]) -> DataFrame:
    """The published metric tables as one long frame ``(metric, rank, key, n)``."""
    parts = [
        metrics["top_airports"].select(F.lit("top_airports").alias("metric"), "rank",
                                       F.col("airport").alias("key"), F.col("flights").alias("n")),
        metrics["top_airlines"].select(F.lit("top_airlines").alias("metric"), "rank",
                                       F.col("airline").alias("key"), F.col("ontime_flights").alias("n")),
        metrics["top_carriers_per_origin"].select(
            F.lit("top_carriers_per_origin").alias("metric"), "rank",
            F.concat_ws("|", "origin", "airline").alias("key"), F.col("ontime_departures").alias("n")),
        metrics["top_destinations_per_origin"].select(
            F.lit("top_destinations_per_origin").alias("metric"), "rank",
            F.concat_ws("|", "origin", "destination").alias("key"), F.col("ontime_departures").alias("n")),
        metrics["weekdays_by_ontime"].select(F.lit("weekdays_by_ontime").alias("metric"), "rank",
                                             F.col("week_day").alias("key"), F.col("ontime_arrivals").alias("n")),
        metrics["delay_reason_counts"].select(F.lit("delay_reason_counts").alias("metric"),
                                              F.col("reason_id").cast("long").alias("rank"),
                                              F.col("reason").alias("key"), F.col("flights").alias("n")),
        metrics["delay_reason_minutes"].select(F.lit("delay_reason_minutes").alias("metric"),
                                               F.col("reason_id").cast("long").alias("rank"),
                                               F.col("reason").alias("key"), F.col("minutes").alias("n")),
        metrics["delay_reason_percent"].select(F.lit("delay_reason_percent").alias("metric"),
                                               F.col("reason_id").cast("long").alias("rank"),
                                               F.col("reason").alias("key"),
                                               F.round(F.col("percent") * 100).cast("long").alias("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_flights": q_clean_flights,
    "ontime_departures": q_ontime_departures,
    "incremental_filter": q_incremental_filter,
    "batch_date_range": q_batch_date_range,
    "departures_by_origin": q_departures_by_origin,
    "ontime_count_by_airline": q_ontime_count_by_airline,
    "ontime_count_by_weekday": q_ontime_count_by_weekday,
    "ontime_by_origin_airline": q_ontime_by_origin_airline,
    "ontime_by_origin_destination": q_ontime_by_origin_destination,
    "top_airports_desc": _top_airports(False),
    "top_airports_asc": _top_airports(True),
    "top_airlines_asc": _top_airlines(True),
    "top_airlines_desc": _top_airlines(False),
    "top_carriers_per_origin_asc": _top_carriers(True),
    "top_carriers_per_origin_desc": _top_carriers(False),
    "top_destinations_per_origin_asc": _top_destinations(True),
    "top_destinations_per_origin_desc": _top_destinations(False),
    "weekdays_by_ontime": q_weekdays_by_ontime,
    "delay_reason_counts": q_delay_reason_counts,
    "delay_reason_minutes": q_delay_reason_minutes,
    "delay_reason_percent": q_delay_reason_percent,
    "delay_percent_empty": q_delay_percent_empty,
    "merge_counts": q_merge_counts,
    "merge_reason_totals": q_merge_reason_totals,
    "dictionary_last_wins": q_dictionary_last_wins,
    "dictionary_last_wins_airlines": q_dictionary_last_wins_airlines,
    "csv_scan_roundtrip": q_csv_scan_roundtrip,
    "state_roundtrip": q_state_roundtrip,
    "text_state_roundtrip": q_text_state_roundtrip,
    "metrics_sink_roundtrip": q_metrics_sink_roundtrip,
    "incremental_two_batches": q_incremental_two_batches,
    "incremental_late_rows_ignored": q_incremental_late_rows_ignored,
    "incremental_hwm": q_incremental_hwm,
    "incremental_no_new_data": q_incremental_no_new_data,
    "publish_ignores_uncommitted": q_publish_ignores_uncommitted,
    "run_log": q_run_log,
    "full_run_metrics": q_full_run_metrics,
    "full_run_from_text": q_full_run_from_text,
    "full_run_reversed": q_full_run_reversed,
    "repeated_dictionary_codes": q_repeated_dictionary_codes,
    "metric_lines_all": q_metric_lines_all,
    "stream_two_arrivals": q_stream_two_arrivals,
    "current_metrics": q_current_metrics,
    "exclusive_commit": q_exclusive_commit,
    "merge_in_buckets": q_merge_in_buckets,
    "reuse_one_scan": q_reuse_one_scan,
    "all_airlines_ranked": q_all_airlines_ranked,
    "unknown_metric_rejected": q_unknown_metric_rejected,
}
