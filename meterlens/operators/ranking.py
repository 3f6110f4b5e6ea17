"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(
    df: DataFrame,
    by: Sequence[str],
    metric: str,
    n: int,
    *,
    tiebreak: Sequence[str] = (),
    rank_col: str = "cost_rank",
) -> DataFrame:
    """The ``n`` rows per group with the greatest ``metric``, numbered from 1.

    Input is expected to be aggregated already. Each task keeps at most ``n`` rows
    per group before the shuffle (WindowGroupLimit).
    """
    order = Window.partitionBy(*by).orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tiebreak])
    return df.withColumn(rank_col, F.row_number().over(order)).where(F.col(rank_col) <= n)
