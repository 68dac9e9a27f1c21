"""Counting: per-metric counts, the one-pass tally of all metrics, merging.

Counts live in one long frame ``(metric, k1, k2, n)`` (see
``constants``): the key columns are the codes the metric groups by,
unused keys are ''.  The same shape is the persisted state, so merging
new counts into old ones is a single union + aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    BATCH,
    DELAY_REASONS,
    DEPARTURES_BY_ORIGIN,
    ONTIME_ARRIVALS_BY_WEEKDAY,
    ONTIME_BY_AIRLINE,
    ONTIME_BY_ORIGIN_AIRLINE,
    ONTIME_BY_ORIGIN_DEST,
    REASON_COUNT,
    REASON_MINUTES,
)
from ..functions import cause_minutes_sql, cause_present_sql, is_on_time_sql

_DEP0 = is_on_time_sql("departure_delay")
_ARR0 = is_on_time_sql("arrival_delay")
_BOTH0 = f"({_DEP0} AND {_ARR0})"

# metric -> (row condition as SQL or None for all rows, k1 column, k2 column or None)
_PLAIN_COUNTS = {
    DEPARTURES_BY_ORIGIN: (None, "origin_airport", None),
    ONTIME_BY_AIRLINE: (_BOTH0, "airline", None),
    ONTIME_BY_ORIGIN_AIRLINE: (_DEP0, "origin_airport", "airline"),
    ONTIME_BY_ORIGIN_DEST: (_DEP0, "origin_airport", "destination_airport"),
    ONTIME_ARRIVALS_BY_WEEKDAY: (_ARR0, "week_day", None),
}


def count_by(df: DataFrame, keys: list[str], where: Column | None = None, name: str = "n") -> DataFrame:
    """``groupBy(keys).count()`` of the rows matching ``where`` (partial + final aggregate)."""
    src = df if where is None else df.where(where)
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def metric_counts(clean: DataFrame, metric: str) -> DataFrame:
    """New counts of one ranking metric as ``(k1, k2, n)``, straight from flights."""
    cond, k1, k2 = _PLAIN_COUNTS[metric]
    keys = [k1] + ([k2] if k2 else [])
    c = count_by(clean, keys, F.expr(cond) if cond else None)
    return c.select(
        F.col(k1).alias("k1"),
        (F.col(k2) if k2 else F.lit("")).alias("k2"),
        F.col("n"),
    )


def reason_totals(clean: DataFrame, *, counts: bool = True, minutes: bool = True) -> DataFrame:
    """One row: per delay cause the number of flights with it (``c_<cause>``)
    and its minutes (``m_<cause>``).  Empty input gives zeros."""
    aggs = []
    for col, _ in DELAY_REASONS:
        if counts:
            aggs.append(f"CAST(coalesce(sum({cause_present_sql(col)}), 0) AS BIGINT) AS c_{col}")
        if minutes:
            aggs.append(f"CAST(coalesce(sum({cause_minutes_sql(col, col)}), 0) AS BIGINT) AS m_{col}")
    return clean.agg(*[F.expr(a) for a in aggs])


def _struct_sql(fields: list[tuple[str, str]]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields) + ")"


def reason_rows(one_row: DataFrame, prefix: str, value_name: str, value_type: str = "BIGINT") -> DataFrame:
    """Unpivot the five ``<prefix><cause>`` columns of a one-row frame into
    ``(reason_id, reason, value_name)`` in the fixed cause order."""
    rows = [
        _struct_sql([("reason_id", str(i + 1)), ("reason", f"'{label}'"),
                     (value_name, f"CAST({prefix}{col} AS {value_type})")])
        for i, (col, label) in enumerate(DELAY_REASONS)
    ]
    return one_row.selectExpr(f"inline(array({', '.join(rows)}))")


# ---------------------------------------------------------------------------
# One pass over the flights for every metric
# ---------------------------------------------------------------------------

_TOTALS = "__totals__"


def _entry_sql(metric: str, k1: str, k2: str, n: str) -> str:
    """SQL of one ``(metric, k1, k2, n)`` struct."""
    return _struct_sql([("metric", metric), ("k1", f"CAST({k1} AS STRING)"),
                        ("k2", f"CAST({k2} AS STRING)"), ("n", f"CAST({n} AS BIGINT)")])


def tally(clean: DataFrame) -> DataFrame:
    """New counts of all seven metrics, plus the batch range, in one pass.

    Every flight emits the groups it counts towards - its origin (all
    flights), and only when the condition holds its airline (departure
    and arrival on time), origin+airline and origin+destination (departure
    on time) and week day (arrival on time) - plus one totals row that
    carries its cause flags, cause minutes and date.  One aggregate over
    ``(metric, k1, k2)`` then counts them: one scan, one shuffle, partial
    aggregation before the shuffle, so a hot key (an airport with a third
    of all flights, or the single totals group) costs one partial row per
    task.  Compared with a GROUPING SETS aggregate (every flight expanded
    into every set, all sums updated in each) this does a fraction of the
    aggregation work when on-time values are rare.

    Output: ``(metric, k1, k2, n)``; the totals group becomes the five
    cause counts, the five cause minutes and the ``__batch__`` rows
    ``rows`` / ``first_day`` / ``last_day`` (days since 1970-01-01).  An
    empty batch gives no rows at all.
    """
    null_long, null_date = "CAST(NULL AS BIGINT)", "CAST(NULL AS DATE)"

    def emitted(metric: str, cond: str | None, k1: str, k2: str | None) -> str:
        fields = [("metric", f"'{metric}'" if cond is None else f"CASE WHEN {cond} THEN '{metric}' END"),
                  ("k1", k1), ("k2", k2 or "''")]
        fields += [(f"c_{c}", null_long) for c, _ in DELAY_REASONS]
        fields += [(f"m_{c}", null_long) for c, _ in DELAY_REASONS]
        return _struct_sql(fields + [("d", null_date)])

    totals = [("metric", f"'{_TOTALS}'"), ("k1", "''"), ("k2", "''")]
    totals += [(f"c_{c}", f"CAST({cause_present_sql(c)} AS BIGINT)") for c, _ in DELAY_REASONS]
    totals += [(f"m_{c}", f"CAST({cause_minutes_sql(c, c)} AS BIGINT)") for c, _ in DELAY_REASONS]
    totals += [("d", "flight_date")]
    rows = [emitted(m, cond, k1, k2) for m, (cond, k1, k2) in _PLAIN_COUNTS.items()] + [_struct_sql(totals)]
    per_flight = clean.selectExpr(f"inline(array({', '.join(rows)}))").where("metric IS NOT NULL")

    aggs = ["count(1) AS n"]
    aggs += [f"sum(c_{c}) AS c_{c}" for c, _ in DELAY_REASONS]
    aggs += [f"sum(m_{c}) AS m_{c}" for c, _ in DELAY_REASONS]
    aggs += ["min(d) AS first_date", "max(d) AS last_date"]
    agg = per_flight.groupBy("metric", "k1", "k2").agg(*[F.expr(a) for a in aggs])

    out = [_entry_sql(f"'{REASON_COUNT}'", f"'{label}'", "''", f"c_{col}") for col, label in DELAY_REASONS]
    out += [_entry_sql(f"'{REASON_MINUTES}'", f"'{label}'", "''", f"m_{col}") for col, label in DELAY_REASONS]
    out += [
        _entry_sql(f"'{BATCH}'", "'rows'", "''", "n"),
        _entry_sql(f"'{BATCH}'", "'first_day'", "''", "unix_date(first_date)"),
        _entry_sql(f"'{BATCH}'", "'last_day'", "''", "unix_date(last_date)"),
    ]
    entries = (f"CASE WHEN metric = '{_TOTALS}' THEN array({', '.join(out)}) "
               f"ELSE array({_entry_sql('metric', 'k1', 'k2', 'n')}) END")
    return agg.selectExpr(f"inline({entries})")


def merge_counts(*frames: DataFrame) -> DataFrame:
    """Union of long count frames, summed per ``(metric, k1, k2)``."""
    union = reduce(lambda a, b: a.unionByName(b), [f.select("metric", "k1", "k2", "n") for f in frames])
    return union.groupBy("metric", "k1", "k2").agg(F.sum("n").cast("long").alias("n"))


def merge_into(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` plus ``new``, both with one row per ``(metric, k1, k2)``.

    A full outer join on the state's keys: an ``old`` that is bucketed by them is read bucket by bucket
    and not shuffled, only ``new`` is, into as many partitions; the result lies in the same buckets.
    """
    keys = ["metric", "k1", "k2"]
    o, w = old.alias("o"), new.alias("w")
    both = o.join(w, [F.col(f"o.{k}") == F.col(f"w.{k}") for k in keys], "full_outer")
    n = F.coalesce("o.n", F.lit(0)) + F.coalesce("w.n", F.lit(0))
    return both.select(*[F.coalesce(f"o.{k}", f"w.{k}").alias(k) for k in keys], n.cast("long").alias("n"))


def slice_metric(counts: DataFrame, metric: str) -> DataFrame:
    """``(k1, k2, n)`` of one metric of a long count frame."""
    return counts.where(F.col("metric") == metric).select("k1", "k2", "n")


def reasons_from_counts(counts: DataFrame) -> DataFrame:
    """The one-row ``c_<cause>`` / ``m_<cause>`` frame from long counts
    (always one row; causes never seen are 0)."""
    aggs = []
    for col, label in DELAY_REASONS:
        for metric, prefix in ((REASON_COUNT, "c_"), (REASON_MINUTES, "m_")):
            hit = f"metric = '{metric}' AND k1 = '{label}'"
            aggs.append(f"CAST(coalesce(sum(CASE WHEN {hit} THEN n END), 0) AS BIGINT) AS {prefix}{col}")
    return counts.where(F.col("metric").isin(REASON_COUNT, REASON_MINUTES)).agg(*[F.expr(a) for a in aggs])
