from .aggregate import (
    count_by,
    merge_counts,
    merge_into,
    metric_counts,
    reason_rows,
    reason_totals,
    reasons_from_counts,
    slice_metric,
    tally,
)
from .clean import batch_date_range, clean_flights, ontime_departures
from .joins import keep_known, lookup_name
from .rank import rank_all, top_k, top_k_per_group

__all__ = [
    "batch_date_range",
    "clean_flights",
    "count_by",
    "keep_known",
    "lookup_name",
    "merge_counts",
    "merge_into",
    "metric_counts",
    "ontime_departures",
    "rank_all",
    "reason_rows",
    "reason_totals",
    "reasons_from_counts",
    "slice_metric",
    "tally",
    "top_k",
    "top_k_per_group",
]
