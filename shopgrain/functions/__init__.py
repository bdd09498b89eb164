"""Column helpers shared by all jobs."""

from shopgrain.functions.numbers import cents, mean, pct, ratio, round2, round_to
from shopgrain.functions.times import (
    day_id,
    day_name,
    dow_sunday0,
    elapsed_seconds,
    in_month,
    is_weekend,
    minute_crossings,
    month_name,
    month_start,
    ntz,
    whole_days,
)

__all__ = [
    "cents", "day_id", "day_name", "dow_sunday0", "elapsed_seconds", "in_month", "is_weekend",
    "mean", "minute_crossings", "month_name", "month_start", "ntz", "pct", "ratio", "round2",
    "round_to", "whole_days",
]
