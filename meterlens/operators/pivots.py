"""Conditional sums, one output column per listed value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.functions import sum_if


def pivot_columns(column: str, outputs: Mapping[str, object], value: str) -> list[Column]:
    """``sum(value)`` per output column where ``column`` equals the mapped value; 0 if it never does."""
    return [sum_if(F.col(column) == F.lit(v), value).alias(out) for out, v in outputs.items()]


def pivot_sum(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    outputs: Mapping[str, object],
    value: str,
    *,
    total_col: str | None = None,
) -> DataFrame:
    """Pivot over a fixed value list in a single aggregation; unlisted values count in the total only."""
    total = [F.sum(value).alias(total_col)] if total_col else []
    return df.groupBy(*by).agg(*pivot_columns(column, outputs, value), *total)
