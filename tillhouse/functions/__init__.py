from tillhouse.functions.numeric import LINE, MONEY, divide, mean, money, percent, ratio, rounded
from tillhouse.functions.relational import first_per, lookup
from tillhouse.functions.temporal import (
    clock_seconds,
    days_elapsed,
    hours_elapsed,
    shift_hours,
    week_start,
    within,
)

__all__ = [
    "LINE",
    "MONEY",
    "clock_seconds",
    "days_elapsed",
    "divide",
    "first_per",
    "hours_elapsed",
    "lookup",
    "mean",
    "money",
    "percent",
    "ratio",
    "rounded",
    "shift_hours",
    "week_start",
    "within",
]
