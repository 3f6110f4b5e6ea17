"""Exact dedup with a heavy-hitter split: hot digests are settled map-side, the others are shuffled.

1. Every row becomes a 256-bit digest of its normalised text; these are written, and texts
   don't move again.
2. Each task counts its digests by the Misra-Gries algorithm with ``COUNTERS`` counters and
   hands over those above its share; they are summed by digest. A sum never exceeds the
   number of rows, so at most ``COUNTERS + 1`` digests reach one in ``COUNTERS + 1`` of all
   rows, and every digest that holds three times that is among them.
3. These candidates are counted exactly, with their winners, and broadcast: their rows are
   settled where they are.
4. The rows of all other digests are grouped by an ordinary shuffle, with partial sums.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm.store import fresh, stored

#: Counters of a task, and the bound of what is broadcast.
COUNTERS = 4095
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class MisraGries:
    """Counts of frequent values, each too low by at most a ``counters + 1``-th of the values added."""

    def __init__(self, counters: int):
        self.counters, self.added, self.counts = counters, 0, {}

    def add(self, counted: Iterator[tuple[bytes, int]]) -> None:
        """Add values with how often each occurs; what is left beyond the counters is cut from all."""
        counts = self.counts
        for value, n in counted:
            counts[value] = counts.get(value, 0) + n
            self.added += n
        if len(counts) > self.counters:
            cut = heapq.nlargest(self.counters + 1, counts.values())[-1]
            self.counts = {value: n - cut for value, n in counts.items() if n > cut}

    def frequent(self) -> dict[bytes, int]:
        """The values counted above their share of what was added."""
        return {value: n for value, n in self.counts.items() if n * (self.counters + 1) > self.added}


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = MisraGries(counters)
        for b in batches:
            counted = pc.value_counts(b.column(0))
            summary.add(zip(counted.field("values").to_pylist(), counted.field("counts").to_pylist(), strict=True))
        found = summary.frequent()
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["digest", "n"])

    return run


def digest(text: str) -> Column:
    """SHA-256 of a text with A-Z lower-cased; null is empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), 256))


def _winners(rows: DataFrame) -> DataFrame:
    """By digest: the largest id, one row that has it, and the number of rows."""
    last = F.coalesce(F.max_by("row", "id"), F.max("row")).alias("last")
    return rows.groupBy("digest").agg(F.max("id").alias("keep"), last, F.count("*").alias("size"))


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The winners of hot digests, at most ``counters + 1`` rows."""
    least = max(2, -(-digests.count() // (counters + 1)))
    estimates = digests.select("digest").mapInArrow(_summaries(counters), "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    candidates = estimates.where(F.col("n") >= least).select("digest")
    return stored(_winners(digests.join(F.broadcast(candidates), "digest", "left_semi")), "frequent-digests")


def _digests(df: DataFrame, id_column: str, text: str) -> DataFrame:
    rows = df.select(F.col(id_column).alias("id"), digest(text).alias("digest"), F.monotonically_increasing_id().alias("row"))
    return stored(rows, "digests")


def copies(df: DataFrame, id_column: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """``id, keep_id, group_size, kept, digest`` for every row of ``df``.

    Texts are equal when identical after lower-casing A-Z; a null text is empty. Of equal
    texts the row of the largest id stays, a null id being smaller than any other; of rows
    of one id and equal texts exactly one stays, whichever. An empty table gives no rows.
    Other columns, whatever their names, take no part.
    """
    digests = _digests(df, id_column, text)
    hot = frequent(digests, counters)
    settled = digests.join(F.broadcast(hot), "digest")
    rest = digests.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    both = settled.unionByName(rest.join(_winners(rest), "digest"))
    return both.select("id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), (F.col("row") == F.col("last")).alias("kept"), "digest")


def drop_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; ``copies`` says which.

    Copies of hot digests are removed where they are; the other rows are shuffled once.
    """
    digests = _digests(df, id_column, text)
    hot = frequent(digests, counters)
    key, keep = fresh(df, "_digest"), fresh(df, "_keep")
    stays = F.col(id_column).eqNullSafe(F.col(keep))
    keyed = df.withColumn(key, digest(text))
    winners = lambda groups: groups.select(F.col("digest").alias(key), F.col("keep").alias(keep))
    settled = keyed.join(F.broadcast(winners(hot)), key).where(stays)
    rest = digests.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    others = keyed.join(F.broadcast(winners(hot)), key, "left_anti").join(winners(_winners(rest)), key).where(stays)
    # Rows of the winning id may be repeated; the rest lies by digest already.
    return settled.dropDuplicates([key]).unionByName(others.dropDuplicates([key])).select(*df.columns)
