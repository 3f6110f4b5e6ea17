"""Which dates of a dataset bear on entities that have changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.operators.changes import change_feed
from meterlens.sources.tables import only_dates
from meterlens.streaming.refresh import Dates, distinct_dates


def changed_entities(old: DataFrame, new: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """The keys that came, went or have other attributes from one state to the next."""
    narrow = [*keys, *attributes]
    return change_feed(old.select(*narrow), new.select(*narrow), keys).select(*keys).distinct()


def dates_of_entities(changed: DataFrame, rows: DataFrame, keys: Sequence[str], date_col: str) -> Dates:
    """The dates on which ``rows`` hold a changed entity; only keys and dates are read, and nothing if none changed."""
    if changed.isEmpty():
        return []
    return distinct_dates(rows.join(changed, list(keys), "left_semi"), date_col)


def whole_entities(rows: DataFrame, dates: Dates, date_col: str, keys: Sequence[str]) -> tuple[DataFrame, Dates]:
    """All rows of the entities on ``dates`` and on any other date of theirs, and these dates.

    For entities whose rows lie on several dates but count on one: what is made of these
    rows, cut to the dates returned, is whole there.
    """

    def of(days: Dates) -> DataFrame:
        here = only_dates(rows, date_col, days).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        return rows.join(here, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi")

    touched = sorted({*dates, *distinct_dates(of(dates), date_col)}, key=lambda d: (d is None, str(d)))
    return of(touched), touched
