"""Column expressions and small frame helpers shared by every dataset."""

from meterlens.functions.calendar import (
    Day,
    add_time_dimensions,
    between_days,
    day_of,
    days_before,
    month_of,
    month_to_date,
    trailing,
    up_to,
    week_of,
)
from meterlens.functions.measures import (
    count_if,
    exact_mean,
    percent,
    ratio,
    seconds_between,
    spend,
    sum_if,
)
from meterlens.functions.stamps import SCOPE, add_workspace_identifiers, stamp_identifiers

__all__ = [
    "Day",
    "SCOPE",
    "add_time_dimensions",
    "add_workspace_identifiers",
    "between_days",
    "count_if",
    "day_of",
    "days_before",
    "exact_mean",
    "month_of",
    "month_to_date",
    "percent",
    "ratio",
    "seconds_between",
    "spend",
    "stamp_identifiers",
    "sum_if",
    "trailing",
    "up_to",
    "week_of",
]
