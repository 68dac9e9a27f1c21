"""Import the cumulative state written by the original job (its text cache).

The original job keeps its running counts as text under one cache folder;
``import_text_state`` reads them with Spark, turns them into the long state
``(metric, k1, k2, n)`` and commits them as the first run of a
``StateStore``, with the cache's last processed date as the mark.  The next
``run_batch`` then continues exactly where the original job stopped.

Formats (read as plain text lines):

* single-key counts, one folder of part files: ``key,count``
  (split like Java's ``String.split(",")``);
* pair-key counts, one folder: ``(k1,k2),count`` (split on ``[,()]``,
  items 1, 2 and 4);
* five cause counters, one file with one line ``a,b,c,d,e`` (the last
  value may carry blanks);
* the mark, one file with an ISO date.

A missing folder or file means "no counts yet", but only without a mark: a
mark says that flights were processed, so all seven count entries must be there.
Text that does not parse (a count that is not an integer, a bad date) fails
the import; the original job would silently reset such state.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (
    DELAY_REASONS,
    DEPARTURES_BY_ORIGIN,
    ONTIME_ARRIVALS_BY_WEEKDAY,
    ONTIME_BY_AIRLINE,
    ONTIME_BY_ORIGIN_AIRLINE,
    ONTIME_BY_ORIGIN_DEST,
    REASON_COUNT,
    REASON_MINUTES,
    STATE_SCHEMA,
)
from ..functions import parse_int_sql
from ..operators import merge_counts
from ..state import Commit, StateStore

# ---------------------------------------------------------------------------
# The names the original job gives its cache entries, and the
# metric each one holds.
# ---------------------------------------------------------------------------
SINGLE_KEY_FOLDERS = {
    "topTenAirportsCache": DEPARTURES_BY_ORIGIN,
    "topTenAirlinesCache": ONTIME_BY_AIRLINE,
    "weekdaysOrderbyDelaysCache": ONTIME_ARRIVALS_BY_WEEKDAY,
}
PAIR_KEY_FOLDERS = {
    "topTenAirportsPerAvialinesCache": ONTIME_BY_ORIGIN_AIRLINE,
    "topTenDestinationsCache": ONTIME_BY_ORIGIN_DEST,
}
FIVE_COUNTER_FILES = {
    "delaysPerReasonsCache.csv": REASON_COUNT,
    "percentDelayPerReasonsCache.csv": REASON_MINUTES,
}
MARK_FILE = "last_processed_date.txt"
# ---------------------------------------------------------------------------


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.text(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return None
        raise


def _count(text: str, what: str) -> str:
    """SQL: the integer in ``text`` (an SQL expression), or fail the query."""
    parsed = parse_int_sql(text)
    return (f"CASE WHEN ({parsed}) IS NULL "
            f"THEN raise_error(concat('not a count in {what}: [', value, ']')) ELSE {parsed} END")


def _single_key(lines: DataFrame, metric: str, folder: str) -> DataFrame:
    # Java's split(",") drops trailing empty fields: strip them first.
    fields = "split(regexp_replace(value, ',+$', ''), ',', -1)"
    return lines.where("value <> ''").selectExpr(
        f"'{metric}' AS metric",
        f"get({fields}, 0) AS k1",
        "'' AS k2",
        f"CAST({_count(f'get({fields}, 1)', folder)} AS BIGINT) AS n",
    )


def _pair_key(lines: DataFrame, metric: str, folder: str) -> DataFrame:
    items = "split(value, '[,()]', -1)"
    return lines.where("value <> ''").selectExpr(
        f"'{metric}' AS metric",
        f"get({items}, 1) AS k1",
        f"get({items}, 2) AS k2",
        f"CAST({_count(f'get({items}, 4)', folder)} AS BIGINT) AS n",
    )


def _five_counters(lines: DataFrame, metric: str, name: str) -> DataFrame:
    fields = "split(value, ',', -1)"
    rows = ", ".join(
        f"named_struct('metric', '{metric}', 'k1', '{label}', 'k2', '', "
        f"'n', CAST({_count(f'trim(get({fields}, {i}))', name)} AS BIGINT))"
        for i, (_, label) in enumerate(DELAY_REASONS)
    )
    return lines.where("trim(value) <> ''").selectExpr(f"inline(array({rows}))")


def read_text_state(spark: SparkSession, cache_dir: str) -> tuple[DataFrame, _dt.date | None]:
    """The original job's cache as ``(long state frame, mark or None)``."""
    parts: list[DataFrame] = []
    missing: list[str] = []
    for folder, metric in SINGLE_KEY_FOLDERS.items():
        lines = _lines(spark, os.path.join(cache_dir, folder))
        if lines is not None:
            parts.append(_single_key(lines, metric, folder))
        else:
            missing.append(folder)
    for folder, metric in PAIR_KEY_FOLDERS.items():
        lines = _lines(spark, os.path.join(cache_dir, folder))
        if lines is not None:
            parts.append(_pair_key(lines, metric, folder))
        else:
            missing.append(folder)
    for name, metric in FIVE_COUNTER_FILES.items():
        lines = _lines(spark, os.path.join(cache_dir, name))
        if lines is not None:
            parts.append(_five_counters(lines, metric, name))
        else:
            missing.append(name)
    empty = spark.range(0).selectExpr(
        *[f"CAST(NULL AS {t}) AS {n}" for n, t in (f.strip().split(" ", 1) for f in STATE_SCHEMA.split(","))])
    state = merge_counts(empty, *parts)

    mark = None
    lines = _lines(spark, os.path.join(cache_dir, MARK_FILE))
    if lines is not None:
        first = lines.where("trim(value) <> ''").selectExpr(
            "try_to_date(trim(value), 'yyyy-MM-dd') AS d", "value").first()  # one line
        if first is not None:
            if first.d is None:
                raise ValueError(f"not a date in {MARK_FILE}: {first.value!r}")
            mark = first.d
    if mark is not None and missing:
        raise ValueError(f"{MARK_FILE} says flights were processed, but the cache lacks {', '.join(missing)}")
    return state, mark


def import_text_state(spark: SparkSession, cache_dir: str, base_path: str) -> Commit | None:
    """Commit the original job's cache as the first run of ``base_path``.

    Returns the commit, or None when the cache holds nothing.  Counts
    without a mark are refused (continuing would count old flights twice).
    The target must not have committed runs yet.
    """
    store = StateStore(spark, base_path)
    if store.latest_commit() is not None:
        raise ValueError(f"{base_path} already has committed runs")
    state, mark = read_text_state(spark, cache_dir)
    seq, run_id = store.new_run(None)
    store.write_snapshot(state, run_id)
    written = store.read_snapshot(run_id)
    flights = written.where(F.col("metric") == DEPARTURES_BY_ORIGIN).agg(F.sum("n").alias("n")).first().n
    has_counts = written.limit(1).count() > 0
    if mark is None:
        if has_counts:
            raise ValueError(f"counts found in {cache_dir} but no {MARK_FILE}")
        return None
    store.commit(seq, run_id, mark, mark, int(flights or 0))
    store.log(run_id, ("imported", f"text state from {cache_dir}, processed up to {mark.isoformat()}"))
    return store.latest_commit()
