"""File-stream driver for the incremental job.

New flight files dropped into a folder are picked up by a Structured
Streaming file source and each micro-batch is handed to ``run_batch``
through ``foreachBatch``.  With ``trigger(availableNow=True)`` one call
processes everything that arrived since the last call and stops, which is
the scheduled-batch mode of the original job.

No watermark is used on purpose: the cut is the last date of the previous
*committed* run, strict, applied to whole batches (rows of that same day
arriving later are ignored), which is not the event-time semantics of
``withWatermark``.  Re-running a micro-batch after a failure is safe: if
its run had committed, its rows are now at or before the mark and the
replay ends as ``no_new_data``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.batch import BatchResult, RunOptions, run_batch
from ..sources import parse_flight_lines, stream_lines
from ..sources.text import MAX_FILE_AGE


def start_incremental(
    spark: SparkSession,
    input_dir: str,
    airlines: DataFrame | str,
    airports: DataFrame | str,
    base_path: str,
    *,
    checkpoint_location: str | None = None,
    options: RunOptions = RunOptions(),
    available_now: bool = True,
    processing_time: str | None = None,
    results: list[BatchResult] | None = None,
    archive_dir: str | None = None,
    forget_after: str | None = None,
) -> StreamingQuery:
    """Start a stream over ``input_dir`` (flight CSV files with a header line).

    ``checkpoint_location`` defaults to a folder below ``base_path``, so a
    later session resumes where this one stopped.  ``results``, if given,
    collects the outcome of every micro-batch (useful for tests and
    monitoring).

    ``archive_dir`` (outside ``input_dir``) takes the files of finished batches, so
    that a long-lived inbox stays short.  ``forget_after`` (such as ``"30d"``) then lets the
    source forget their names too; a file that much older than the newest one must not
    arrive any more, as it would not be read.
    """
    if forget_after and not archive_dir:
        raise ValueError("forget_after needs archive_dir: forgotten files that stay in the inbox would be read again")
    flights = parse_flight_lines(stream_lines(spark, input_dir, archive_dir, forget_after or MAX_FILE_AGE))
    location = checkpoint_location or f"{base_path.rstrip('/')}/stream"

    def each(batch: DataFrame, batch_id: int) -> None:
        outcome = run_batch(batch.sparkSession, base_path, batch, airlines, airports, options)
        if results is not None:
            results.append(outcome)

    writer = flights.writeStream.foreachBatch(each).option("checkpointLocation", location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
