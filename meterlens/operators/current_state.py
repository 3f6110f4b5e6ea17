"""Current state of slowly changing records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the greatest ``order_col``, then the greatest tiebreak columns.

    ``row_number() = 1`` plans as a partial WindowGroupLimit before the shuffle, so
    at most one row per key leaves each task however many versions a hot key has.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (order_col, *tiebreak)])
    return df.withColumn("_version_rank", F.row_number().over(newest)).where("_version_rank = 1").drop("_version_rank")


def extract_current_scd2(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_col: str = "change_time",
    delete_col: str | None = "delete_time",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Latest version per key, without the keys whose latest version is a deletion.

    The deletion test comes after the pick: a deleted entity never falls back to an
    older version. ``delete_col=None`` keeps deleted entities. On equal times a
    deletion wins, then the tiebreak columns decide.
    """
    if delete_col is None:
        return latest_by(df, partition_cols, order_col, tiebreak)
    return latest_by(df, partition_cols, order_col, [delete_col, *tiebreak]).where(F.col(delete_col).isNull())
