"""Aggregates that are kept by date and merged when they are read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Partials:
    """Sums, extremes and a distinct count by ``keys`` that can be taken of parts and put together.

    Expressions are SQL over the rows. With ``member`` a state is kept for each of its
    values, so that ``members`` counts the distinct ones of any dates, however many rows
    one key has.
    """

    keys: Sequence[str]
    sums: Mapping[str, str] = field(default_factory=dict)
    lowest: Mapping[str, str] = field(default_factory=dict)
    highest: Mapping[str, str] = field(default_factory=dict)
    member: str | None = None
    members: str | None = None

    def _members(self) -> list[str]:
        return [self.member] if self.member else []

    def states(self, rows: DataFrame, *by: str) -> DataFrame:
        """The state of each part, one row for each key, ``by`` (a date, say) and member."""
        return rows.groupBy(*self.keys, *by, *self._members()).agg(
            *[F.sum(F.expr(e)).alias(name) for name, e in self.sums.items()],
            *[F.min(F.expr(e)).alias(name) for name, e in self.lowest.items()],
            *[F.max(F.expr(e)).alias(name) for name, e in self.highest.items()],
        )

    def _together(self, states: DataFrame, keys: Sequence[str]) -> DataFrame:
        counted = [F.count(self.member).alias(self.members)] if self.member and self.member not in keys else []
        return states.groupBy(*keys).agg(
            *[F.sum(name).alias(name) for name in self.sums],
            *[F.min(name).alias(name) for name in self.lowest],
            *[F.max(name).alias(name) for name in self.highest],
            *counted,
        )

    def merge(self, states: DataFrame) -> DataFrame:
        """One row for each key from the states of any parts."""
        by_member = self._together(states, [*self.keys, self.member]) if self.member else states
        return self._together(by_member, self.keys)
