"""One period against the period before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import Day, between_days, percent, trailing


def period_compare(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    as_of: Day,
    days: int = 7,
    date_col: str = "usage_date",
    current_col: str = "current_period_cost",
    previous_col: str = "previous_period_cost",
    change_col: str = "cost_change",
    percent_col: str = "cost_change_pct",
) -> DataFrame:
    """Totals of the last ``days`` days and of the ``days`` before, with change and change in percent.

    A key seen in only one period gets 0 for the other; percent is NULL when the
    previous total is missing or 0. Both totals come from one scan and one shuffle,
    which gives the rows that a full outer join of the two periods would.
    """
    this_period = between_days(date_col, as_of, days, 0)
    last_period = between_days(date_col, as_of, 2 * days, days)
    zero = F.lit(0)
    totals = (
        trailing(df, date_col, 2 * days, as_of)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum(F.when(this_period, F.col(value))), zero).alias(current_col),
            F.coalesce(F.sum(F.when(last_period, F.col(value))), zero).alias(previous_col),
        )
    )
    change = F.col(current_col) - F.col(previous_col)
    return totals.withColumns(
        {change_col: change, percent_col: percent(change, previous_col) + F.lit(0.0)}
    )
