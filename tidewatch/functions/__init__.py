from tidewatch.functions.expr import (
    hours_between,
    month_start,
    norm_key,
    pct,
    round_half_up,
    split_rows,
    week_start,
)

__all__ = [
    "hours_between",
    "month_start",
    "norm_key",
    "pct",
    "round_half_up",
    "split_rows",
    "week_start",
]
