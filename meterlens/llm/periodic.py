"""Periodic runs of words, found by an online sparse diagonal DP.

The words of a text are read once. An earlier occurrence of a word, ``lag`` words before,
adds one to the match length on the diagonal of that lag if the diagonal is active, and
activates it otherwise; a diagonal that a word doesn't match ends there, and is emitted as
a run at once if it is long enough.

What keeps the diagonals sparse: of a word's earlier occurrences only those count that can
belong to a run. A run of period ``q`` has four periods, so with ``q <= w < 2q`` (``w`` a
power of two, 4 at least) each of its words from the ``q + w``-th on closes a stretch of
``w`` words that also ended ``q`` words earlier, and nowhere between, as ``q`` is the
smallest period. So for each ``w`` only the nearest earlier place where the last ``w`` words
were the same is an occurrence, at a lag above ``w / 2`` (any for 4) and up to ``w``: at
most one for each power of two, none for a word whose stretch doesn't come again. A diagonal
is active first with a match of exactly ``w`` words, and its lag is the smallest period of
what it spans: a smaller one would divide it, and be nearer. Such places come from names
for repeated stretches, doubled in width by sorting, for all texts of a batch at once.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm import textbytes

#: A run has this many words, and this many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
_BASE = 4  # the least width of stretches that are compared
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def occurrences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The earlier occurrences that can belong to a run: word number, lag and width of the stretch, by word number.

    ``codes`` are numbers of words from 0 on, different ones in different texts.
    """
    n = len(codes)
    at = np.flatnonzero(np.bincount(codes)[codes] > 1) if n else np.zeros(0, np.int64)
    names, width, found = codes[at], 1, []
    full = np.full(n, -1, np.int64)
    while len(at):
        full[:] = -1
        full[at] = names
        whole = at >= width
        whole[whole] = full[at[whole] - width] >= 0
        at = at[whole]
        key = (full[at] << 32) | full[at - width]
        width *= 2
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        lag = np.zeros(len(at), np.int64)
        lag[1:] = at[order[1:]] - at[order[:-1]]
        if width >= _BASE:
            near = ~new & (lag <= width) & ((lag > width // 2) | (width == _BASE))
            found.append((at[order[near]], lag[near], np.full(int(near.sum()), width)))
        again = np.bincount(group, minlength=1)[group] > 1 if len(group) else new
        back = np.argsort(order[again], kind="stable")
        at, names = at[order[again]][back], group[again][back]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    at, lag, width = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((lag, at))
    return at[order], lag[order], width[order]


def runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, length and period of every run, by the word that ends it."""
    active: dict[int, tuple[int, int]] = {}  # by lag: the match length, and the last word matched
    out = []

    def end(lag: int) -> None:
        length, last = active.pop(lag)
        if length >= (LEAST_PERIODS - 1) * lag and length + lag >= LEAST_WORDS:
            out.append((last - length - lag + 1, length + lag, lag))

    word = -1
    for i, lag, width in zip(*(x.tolist() for x in occurrences(codes)), strict=True):
        if i != word:
            for other in [x for x, (_, last) in active.items() if last < i - 1]:
                end(other)
            word = i
        length = active[lag][0] + 1 if lag in active else width
        active[lag] = length, i
    for lag in list(active):
        end(lag)
    return out


def _batch(texts: list[str | None]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """The runs of each text by start and period, and the words that stay."""
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]  # bytes are split at ASCII white space
    number = itertools.count()
    codes = []
    for w in words:
        known: defaultdict[bytes, int] = defaultdict(number.__next__)
        codes.append(np.fromiter(map(known.__getitem__, w), np.int64, len(w)))
    starts = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    all_codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    for start, length, period in runs(all_codes):
        text = int(np.searchsorted(starts, start, "right")) - 1
        found[text].append((start - int(starts[text]), length, period))
    kept = []
    for w, own in zip(words, found, strict=True):
        own.sort(key=lambda r: (r[0], r[2]))
        if own:
            stays = np.ones(len(w), bool)
            for start, length, period in own:
                stays[start + period : start + length] = False
            w = list(itertools.compress(w, stays.tolist()))
        kept.append(b" ".join(w))
    return found, kept


def collapse(df: DataFrame, text: str = "text", runs_out: str = "runs") -> DataFrame:
    """``df`` with the words of ``text`` that stay, joined by one space, and the runs of the words before.

    Words are what stands between ASCII white space, and equal if identical. A run is a
    stretch with smallest period q of at least ``LEAST_WORDS`` words and ``LEAST_PERIODS``
    periods that can't be made longer; ``runs_out`` lists them by start and period. A word
    that a run holds after its first period goes. A null or empty text has no words and
    becomes empty. Texts are taken whole and nothing is shuffled. Other columns, whatever
    their names, and repeated rows stay; a column named ``runs_out`` is replaced.
    """
    names = [c for c in df.columns if c.lower() != runs_out.lower()]
    at = names.index(text)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            _, offsets = textbytes.buffers(b.column(at))
            for i, j in textbytes.slices(offsets, textbytes.CHUNK * 4):
                found, kept = _batch(b.column(at).slice(i, j - i).to_pylist())
                flat = np.array([r for own in found for r in own], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
                ends = np.concatenate(([0], np.cumsum([len(own) for own in found]))).astype(np.int32)
                columns = [b.column(k).slice(i, j - i) for k in range(len(names))]
                columns[at] = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), structs)], [*names, runs_out])
        textbytes.release()

    schema = df.select(*names).withColumn(runs_out, F.lit(None).cast(RUNS)).schema
    return df.select(*[F.col(c) for c in names]).mapInArrow(batches, schema)
