"""Aggregate expressions that recur across the datasets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def spend(quantity: str = "usage_quantity", cost: str = "estimated_cost_usd", *, quantity_as: str = "total_dbus") -> list[Column]:
    """The quantity and cost totals carried by every cost dataset, kept in DECIMAL."""
    return [F.sum(quantity).alias(quantity_as), F.sum(cost).alias("total_cost_usd")]


def respend() -> list[Column]:
    """Totals of already totalled rows."""
    return spend("total_dbus", "total_cost_usd")


def sum_if(condition: Column, value: str | Column) -> Column:
    """Sum where the condition is true, 0 (not NULL) when it never is."""
    return F.sum(F.when(condition, _col(value)).otherwise(0))


def count_if(condition: Column) -> Column:
    return sum_if(condition, F.lit(1).cast("bigint"))


def exact_mean(value: str | Column) -> Column:
    """Mean of a DECIMAL as DOUBLE: exact decimal sum, then one division."""
    return F.sum(_col(value)).cast("double") / F.nullif(F.count(_col(value)), F.lit(0))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division as DOUBLE; NULL when the denominator is 0 (ANSI mode raises otherwise)."""
    return _col(numerator).cast("double") / F.nullif(_col(denominator).cast("double"), F.lit(0.0))


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    return F.round(ratio(F.lit(100.0) * _col(part).cast("double"), whole), digits)


def seconds_between(start: str, end: str) -> Column:
    """Whole seconds from start to end; NULL while either side is open."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)
