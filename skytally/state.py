"""Cumulative state, published results and the run log, all as Spark tables.

Layout below ``base_path``::

    dictionaries/run=<run_id>/kind=<k>/  the run's dictionaries, one row per code
    counts/run=<run_id>/                 the new counts of a run
    ranked/run=<run_id>/                 its week days in their order
    snapshots/run=<run_id>/              complete state after a run (parquet files
                                         in buckets of (metric, k1, k2))
    metrics/run=<run_id>/metric=<name>/  the published metric tables
    metrics_text/run=<run_id>/<name>/    optional plain-text export of them
    rejects/run=<run_id>/                row counts of tables with unknown names
    commits/run-<seq>.json               one file per committed run
    current.json                         where the newest committed run's tables are
    log/<time>-<id>.json                 entries of the run log

A run writes its tables under a fresh ``run_id`` (never overwriting anything),
then creates one commit file, which the file system lets only one writer do.  Readers
look at the newest committed run, so results and state become visible
together, and a run that fails half way leaves nothing visible.  ``current.json``
is replaced after each commit, for readers without this package.  Old
runs stay readable until removed by retention outside this package.

State is kept in buckets, so that the next run joins its new counts to it without
moving the old rows: ``bucketed`` reads it as a bucketed table.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import METRIC_NAMES, METRIC_SCHEMAS, STATE_SCHEMA
from .files import SharedFiles

COMMIT_SCHEMA = (
    "seq BIGINT, run_id STRING, first_date DATE, last_date DATE, flights BIGINT, committed_at TIMESTAMP, buckets INT"
)
DICTIONARY_SCHEMA = "code STRING, name STRING"
REJECT_SCHEMA = "metric STRING, rejected BIGINT"
COMMIT_FILE = re.compile(r"run-(\d+)\.json")
STATE_KEYS = ["metric", "k1", "k2"]
#: Buckets of a new state; the number is kept for as long as the state lives.
STATE_BUCKETS = 8
LOG_SCHEMA = "run_id STRING, status STRING, detail STRING, logged_at TIMESTAMP"


@dataclass(frozen=True)
class Commit:
    seq: int
    run_id: str
    first_date: _dt.date
    last_date: _dt.date
    flights: int
    buckets: int = STATE_BUCKETS


def _missing(err: AnalysisException) -> bool:
    cls = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cls() if cls else None
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(err)


class StateStore:
    """State table, commits and run log under one base path."""

    def __init__(self, spark: SparkSession, base_path: str):
        self.spark = spark
        self.base = base_path.rstrip("/")
        self.files = SharedFiles(spark)

    # -- paths ---------------------------------------------------------------
    def _p(self, *parts: str) -> str:
        return os.path.join(self.base, *parts)

    def snapshot_path(self, run_id: str) -> str:
        return self._p("snapshots", f"run={run_id}")

    def counts_path(self, run_id: str) -> str:
        return self._p("counts", f"run={run_id}")

    def ranked_path(self, run_id: str) -> str:
        return self._p("ranked", f"run={run_id}")

    def dictionaries_path(self, run_id: str, kind: str | None = None) -> str:
        p = self._p("dictionaries", f"run={run_id}")
        return os.path.join(p, f"kind={kind}") if kind else p

    def metrics_path(self, run_id: str, name: str | None = None) -> str:
        p = self._p("metrics", f"run={run_id}")
        return os.path.join(p, f"metric={name}") if name else p

    def lines_path(self, run_id: str, name: str) -> str:
        """Plain-text export of a metric (``name,value`` lines, no header)."""
        return self._p("metrics_text", f"run={run_id}", name)

    # -- reads ---------------------------------------------------------------
    def _read(self, path: str, schema: str, kind: str) -> DataFrame:
        """The files of a folder; an empty frame if there is none."""
        try:
            return self.spark.read.schema(schema).format(kind).load(path)
        except AnalysisException as err:
            if _missing(err):
                return _empty(self.spark, schema)
            raise

    def commits(self) -> DataFrame:
        return self._read(self._p("commits"), COMMIT_SCHEMA, "json")

    def run_log(self) -> DataFrame:
        return self._read(self._p("log"), LOG_SCHEMA, "json")

    def latest_commit(self) -> Commit | None:
        """The newest committed run (one listing and one small file, no Spark job)."""
        newest = 0
        for name in self.files.names(self._p("commits")):
            found = COMMIT_FILE.fullmatch(name)
            if found:
                newest = max(newest, int(found[1]))
            elif not name.startswith((".", "_")):
                raise ValueError(f"{self._p('commits', name)} is not a commit of this version; the state was written by another one")
        if not newest:
            return None
        c = json.loads(self.files.read(self._commit_path(newest)))
        return Commit(c["seq"], c["run_id"], _dt.date.fromisoformat(c["first_date"]), _dt.date.fromisoformat(c["last_date"]),
                      c["flights"], c["buckets"])

    def _commit_path(self, seq: int) -> str:
        return self._p("commits", f"run-{seq:010d}.json")

    def read_snapshot(self, run_id: str) -> DataFrame:
        """State of a run as ``(metric, k1, k2, n)``; missing data raises."""
        df = self.spark.read.schema(STATE_SCHEMA).parquet(self.snapshot_path(run_id))
        return df.select("metric", "k1", "k2", "n")

    @contextmanager
    def bucketed(self, run_id: str, buckets: int) -> Iterator[DataFrame]:
        """The same rows as a bucketed table: joins on the state's keys leave them where they are.

        The catalogue entry lives as long as the block; the files stay.
        """
        name = f"skytally_state_{uuid.uuid4().hex}"
        keys = ", ".join(STATE_KEYS)
        path = self.snapshot_path(run_id).replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({STATE_SCHEMA}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                       f"INTO {buckets} BUCKETS LOCATION '{path}'")
        try:
            yield self.spark.table(name).select("metric", "k1", "k2", "n")
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def read_counts(self, run_id: str) -> DataFrame:
        """The new counts of a run, as they were written."""
        return self.spark.read.schema(STATE_SCHEMA).parquet(self.counts_path(run_id))

    def read_dictionary(self, run_id: str, kind: str) -> DataFrame:
        """``(code, name)`` of one dictionary of a run: a small table whose size Spark knows from its files."""
        return self.spark.read.schema(DICTIONARY_SCHEMA).parquet(self.dictionaries_path(run_id, kind))

    def read_dictionaries(self, run_id: str) -> DataFrame:
        """``(kind, code, name)`` of all dictionaries of a run."""
        return self.spark.read.schema(f"{DICTIONARY_SCHEMA}, kind STRING").parquet(self.dictionaries_path(run_id))

    def read_rejects(self, run_id: str) -> DataFrame:
        """``(metric, rejected)``: rows of tables with unknown names that a run was given."""
        return self._read(self._p("rejects", f"run={run_id}"), REJECT_SCHEMA, "parquet")

    def committed_state(self) -> DataFrame:
        """State of the newest committed run; empty before the first commit."""
        c = self.latest_commit()
        if c is None:
            return _empty(self.spark, STATE_SCHEMA)
        return self.read_snapshot(c.run_id)

    def committed_metric(self, name: str) -> DataFrame:
        """A published metric table of the newest committed run."""
        _known_metric(name)
        c = self.latest_commit()
        if c is None:
            raise LookupError("no committed run yet")
        return self.read_metric(c.run_id, name)

    def read_metric(self, run_id: str, name: str) -> DataFrame:
        """A metric table of a run.  A table without rows has no folder of its
        own, so the run's folder is read and pruned to the metric's partition."""
        _known_metric(name)
        rows = self.spark.read.schema(f"{METRIC_SCHEMAS[name]}, metric STRING").parquet(self.metrics_path(run_id))
        return rows.where(F.col("metric") == name).drop("metric")

    def stale_runs(self, keep: int = 2) -> list[str]:
        """Folders of runs that no reader needs any more, for a retention job.

        Keeps the newest ``keep`` committed runs and every run started after
        the newest commit (it may still be in flight); lists older committed
        runs and runs that never committed.  Nothing is deleted here.  Run
        ids are the folder names below ``snapshots/``.
        """
        latest = self.latest_commit()
        if latest is None:
            return []
        on_disk = [n.removeprefix("run=") for n in self.files.names(self._p("snapshots")) if n.startswith("run=")]
        committed = {r.run_id: r.seq for r in self.commits().select("run_id", "seq").collect()}  # one row per run
        kept_from = latest.seq - keep + 1
        stale = []
        for run_id in on_disk:
            seq = int(run_id.split("-", 1)[0])
            if seq > latest.seq:
                continue  # started after the newest commit: may be running
            if run_id in committed and seq >= kept_from:
                continue
            stale += [self.snapshot_path(run_id), self.metrics_path(run_id), self.counts_path(run_id), self.dictionaries_path(run_id), self.ranked_path(run_id),
                      self._p("metrics_text", f"run={run_id}"), self._p("rejects", f"run={run_id}")]
        return stale

    # -- writes --------------------------------------------------------------
    @staticmethod
    def new_run(previous: Commit | None) -> tuple[int, str]:
        seq = 1 if previous is None else previous.seq + 1
        return seq, f"{seq:010d}-{uuid.uuid4().hex[:12]}"

    def write_dictionaries(self, run_id: str, **kinds: DataFrame) -> None:
        """Keep the run's dictionaries ``(code, name)`` as small tables, by kind, in one job."""
        rows = reduce(DataFrame.unionByName, [df.select("code", "name", F.lit(kind).alias("kind")) for kind, df in kinds.items()])
        # a dictionary without rows still has its folder
        path = self.dictionaries_path(run_id)
        rows.write.mode("errorifexists").partitionBy("kind").parquet(path)
        there = self.files.names(path)
        for kind in kinds:
            if f"kind={kind}" not in there:
                _empty(self.spark, DICTIONARY_SCHEMA).write.parquet(self.dictionaries_path(run_id, kind))

    def write_counts(self, counts: DataFrame, run_id: str) -> DataFrame:
        """Write a run's new counts and read them back: what follows does not go back to the flights, even
        if executors are lost."""
        counts.select("metric", "k1", "k2", "n").write.mode("errorifexists").parquet(self.counts_path(run_id))
        return self.read_counts(run_id)

    def write_snapshot(self, state: DataFrame, run_id: str, buckets: int = STATE_BUCKETS, in_place: bool = False) -> str:
        """Write a state in ``buckets`` files.  ``in_place`` says that its partitions are the buckets already
        (the merge of a bucketed state); else rows are shuffled to them."""
        path, name = self.snapshot_path(run_id), f"skytally_state_{uuid.uuid4().hex}"
        rows = state.select("metric", "k1", "k2", "n")
        if not in_place:
            rows = rows.repartition(buckets, *STATE_KEYS)
        try:
            (rows.write.mode("errorifexists").bucketBy(buckets, *STATE_KEYS).sortBy(*STATE_KEYS)
             .option("path", path).format("parquet").saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay
        return path

    def write_metrics(self, tables: dict[str, DataFrame], run_id: str) -> str:
        """All metric tables of a run in one job: one frame with the columns of
        all of them (NULL where a table lacks one), a folder per metric.

        Tables with unknown names are not published; their rows are counted in ``read_rejects`` and in
        the log, and the run goes on."""
        unknown = {name: df for name, df in tables.items() if name not in METRIC_NAMES}
        frames = [df.select(F.lit(name).alias("metric"), *df.columns) for name, df in tables.items() if name not in unknown]
        path = self.write_metric_rows(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), run_id)
        if unknown:
            counts = [df.select(F.lit(name).alias("metric")) for name, df in unknown.items()]
            given = reduce(DataFrame.unionAll, counts).groupBy("metric").agg(F.count(F.lit(1)).alias("rejected"))
            given.write.mode("errorifexists").parquet(self._p("rejects", f"run={run_id}"))
            self.log(run_id, *[("rejected", f"unknown metric {name}") for name in sorted(unknown)])
        return path

    def write_metric_rows(self, rows: DataFrame, run_id: str) -> str:
        """Metric tables that are stacked already, told apart by the column ``metric``."""
        path = self.metrics_path(run_id)
        rows.write.mode("errorifexists").partitionBy("metric").parquet(path)
        return path

    def write_metric(self, df: DataFrame, run_id: str, name: str) -> str:
        _known_metric(name)
        path = self.metrics_path(run_id, name)
        df.write.mode("errorifexists").parquet(path)
        return path

    def commit(self, seq: int, run_id: str, first_date, last_date, flights: int, buckets: int = STATE_BUCKETS) -> None:
        """Make a run visible.  Of several writers of one ``seq`` the file system lets one create the
        commit file; the others raise and have published nothing."""
        row = {"seq": seq, "run_id": run_id, "first_date": first_date.isoformat(), "last_date": last_date.isoformat(),
               "flights": flights, "committed_at": _now(), "buckets": buckets}
        if not self.files.create(self._commit_path(seq), json.dumps(row)):
            raise RuntimeError(f"run {seq} of {self.base} is already committed by another writer")
        self.point_to_current()

    def current(self) -> dict | None:
        """What ``current.json`` says: run, dates, and the folders of its state and metrics below the base path."""
        text = self.files.read(self._p("current.json"))
        return json.loads(text) if text else None

    def point_to_current(self) -> None:
        """Let ``current.json`` name the newest committed run.

        A driver may die between commit and pointer, or be overtaken by the next
        run; so each run sets it again, and looks once more whether a newer run has come."""
        while (c := self.latest_commit()) is not None and ((now := self.current()) is None or now["seq"] != c.seq):
            self.files.replace(self._p("current.json"), json.dumps({
                "seq": c.seq, "run_id": c.run_id, "first_date": c.first_date.isoformat(), "last_date": c.last_date.isoformat(),
                "flights": c.flights, "state": f"snapshots/run={c.run_id}", "metrics": f"metrics/run={c.run_id}",
                "tables": METRIC_NAMES}))

    def log(self, run_id: str | None, *entries: tuple[str, str]) -> None:
        """Append ``(status, detail)`` entries of one run to the run log: a file of their own, as other writers may log too."""
        now = _now()
        lines = [json.dumps({"run_id": run_id, "status": status, "detail": detail, "logged_at": now}) for status, detail in entries]
        self.files.create(self._p("log", f"{now.replace(':', '').replace('-', '')}-{uuid.uuid4().hex[:12]}.json"), "\n".join(lines) + "\n")


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame of ``schema`` built JVM-side (no Python data path)."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in fields])


def _known_metric(name: str) -> None:
    if name not in METRIC_NAMES:
        raise KeyError(f"unknown metric {name!r}; known: {', '.join(METRIC_NAMES)}")


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
