"""Moving averages, running totals and anomaly labels over daily series.

The windows run on rows that are already one per group and day, so a partition
holds at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _frame(by: Sequence[str], order: str, first: int, last: int, by_days: bool) -> WindowSpec:
    """Frame of previous rows, or of previous calendar days when ``by_days``."""
    group = Window.partitionBy(*by)
    if by_days:
        return group.orderBy(F.unix_date(order)).rangeBetween(first, last)
    return group.orderBy(order).rowsBetween(first, last)


def rolling_avg(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    values: Mapping[str, str],
    n: int,
    *,
    by_days: bool = False,
) -> DataFrame:
    """Average of the current and the ``n - 1`` previous rows; ``values`` maps output to input column.

    Rows, not days: a missing day stretches the window. ``by_days=True`` counts days.
    """
    frame = _frame(by, order, -(n - 1), 0, by_days)
    return df.withColumns({out: F.avg(F.col(src).cast("double")).over(frame) for out, src in values.items()})


def running_total(df: DataFrame, by: Sequence[str], order: str, value: str, output: str) -> DataFrame:
    """Running sum where all rows of one ``order`` value share a total (RANGE frame)."""
    frame = Window.partitionBy(*by).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(output, F.sum(value).over(frame))


def zscore_anomalies(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    value: str,
    *,
    history: int = 29,
    threshold: float = 2.0,
    mean_col: str = "avg_30d",
    stddev_col: str = "stddev_30d",
    score_col: str = "z_score",
    label_col: str = "anomaly_flag",
    labels: tuple[str, str, str] = ("HIGH", "LOW", "NORMAL"),
    digits: int | None = None,
    by_days: bool = False,
) -> DataFrame:
    """Label values far from the mean of the ``history`` rows before them.

    Rows without history are dropped. An undefined score (no or zero deviation) is
    labelled normal. The label uses the unrounded score; ``digits`` rounds the
    reported one.
    """
    before = _frame(by, order, -history, -1, by_days)
    level = F.col(value).cast("double")
    scored = (
        df.withColumns({mean_col: F.avg(level).over(before), stddev_col: F.stddev_samp(level).over(before)})
        .where(F.col(mean_col).isNotNull())
        .withColumn(score_col, (level - F.col(mean_col)) / F.nullif(F.col(stddev_col), F.lit(0.0)))
    )
    high, low, normal = labels
    labelled = scored.withColumn(
        label_col,
        F.when(F.col(score_col) > threshold, high).when(F.col(score_col) < -threshold, low).otherwise(normal),
    )
    if digits is None:
        return labelled
    return labelled.withColumn(score_col, _rounded(F.col(score_col), digits))


def _rounded(col: Column, digits: int) -> Column:
    return F.round(col, digits) + F.lit(0.0)  # turns -0.0 into 0.0
