from .metrics import (
    delay_reason_counts,
    delay_reason_minutes,
    delay_reason_percent,
    top_airlines,
    top_airports,
    top_carriers_per_origin,
    top_destinations_per_origin,
    weekdays_by_ontime,
)

__all__ = [
    "delay_reason_counts",
    "delay_reason_minutes",
    "delay_reason_percent",
    "top_airlines",
    "top_airports",
    "top_carriers_per_origin",
    "top_destinations_per_origin",
    "weekdays_by_ontime",
]
