"""Calendar buckets and date windows anchored on an explicit ``as_of`` day.

Every report takes ``as_of`` so that history can be replayed; ``None`` means the
session's current date. A window filters the stored date column itself, never a
function of it, so a Parquet table partitioned by that column is pruned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Day = dt.date | str | None


def day_of(as_of: Day) -> Column:
    """``as_of`` as a DATE expression."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def days_before(as_of: Day, days: int) -> Column:
    return F.date_sub(day_of(as_of), days)


def up_to(df: DataFrame, date_col: str, as_of: Day) -> DataFrame:
    """Rows up to ``as_of``; without one there is no bound, so rows dated ahead of the session's clock stay."""
    if as_of is None:
        return df
    return df.where(F.col(date_col) <= day_of(as_of))


def trailing(df: DataFrame, date_col: str, days: int, as_of: Day) -> DataFrame:
    """Rows from ``as_of - days`` to ``as_of``, both included; without ``as_of``, all from then on."""
    return up_to(df, date_col, as_of).where(F.col(date_col) >= days_before(as_of, days))


def between_days(date_col: str, as_of: Day, oldest: int, newest: int) -> Column:
    """Condition: ``as_of - oldest <= date < as_of - newest`` (``newest=0`` includes ``as_of``, or has no end without one)."""
    col = F.col(date_col)
    if newest == 0 and as_of is None:
        return col >= days_before(as_of, oldest)
    upper = col <= day_of(as_of) if newest == 0 else col < days_before(as_of, newest)
    return (col >= days_before(as_of, oldest)) & upper


def month_to_date(df: DataFrame, date_col: str, as_of: Day) -> DataFrame:
    """Rows of ``as_of``'s calendar month, written as a date range so it prunes."""
    return up_to(df, date_col, as_of).where(F.col(date_col) >= F.trunc(day_of(as_of), "month"))


def week_of(col: str | Column) -> Column:
    """Monday of the week, as DATE."""
    return F.trunc(col, "week")


def month_of(col: str | Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(col, "month")


def add_time_dimensions(df: DataFrame, timestamp_col: str) -> DataFrame:
    """Add ``date, hour, day_of_week`` (1 = Sunday), ``week_start`` and ``month_start``."""
    ts = F.col(timestamp_col)
    return df.withColumns(
        {
            "date": F.to_date(ts),
            "hour": F.hour(ts),
            "day_of_week": F.dayofweek(ts),
            "week_start": F.to_date(F.date_trunc("week", ts)),
            "month_start": F.to_date(F.date_trunc("month", ts)),
        }
    )
