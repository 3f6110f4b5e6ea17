"""Joins with groups of which a few may hold much of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least one in ``SHARE`` of all rows is hot; there are at most ``SHARE`` such keys.
SHARE = 4096


def join_groups(rows: DataFrame, groups: DataFrame, on: Sequence[str], size: str, share: int = SHARE) -> DataFrame:
    """``rows`` joined with the one row of ``groups`` for their key.

    ``groups`` is a stored table, and ``size`` its number of ``rows`` for a key. Hot groups
    are broadcast: their sizes add up to at most the total, so there are at most ``share``
    of them, whatever the table. Rows of all other keys are shuffled.
    """
    total = groups.agg(F.sum(size)).head()[0] or 0
    least = max(2, -(-total // share))
    hot = groups.where(F.col(size) >= least)
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), list(on), "left")
    others = rows.join(F.broadcast(hot.select(*on)), list(on), "left_anti")
    return marked.where("_hot").drop("_hot").unionByName(others.join(groups.where(F.col(size) < least), list(on)))
