"""Best-fit packing: a configuration linear program over the histogram of piece lengths.

A configuration is a multiset of lengths that fit into one sequence. The program asks
for the least number of configurations that cover every length's count. It is solved by
multiplicative weights: a length's weight falls as it gets covered, and the
configurations of the largest weight are found by a knapsack dynamic program, which
prices the best configuration around each length at once. The solution is rounded, what
remains of the histogram is solved again, and the last ``REST`` of the pieces are packed best
fit, longest piece first, with the filling that leaves the least room.

Only the histogram (one number for each length) reaches the driver, and the plan of
configurations with their multiplicities goes back; both are bounded by the capacity,
not by the data. Pieces find their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.store import stored
from meterlens.llm.textbytes import release
from meterlens.llm.token_counts import token_ids

CAPACITY = 2048
ROUNDS = 30  # of the multiplicative weights
STEP = 0.2  # of a length's count, in a round
RATE = 2.0  # how fast a covered length's weight falls
REST = 0.05  # of the pieces, packed best fit after the program's
_NIL = 1e-9

Config = dict[int, int]


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns but ``text``, and ``piece, start, length, ids`` for each piece of every text.

    A text's tokens end with ``end_id``; a null text is empty. More than ``capacity``
    tokens are cut into pieces of that length, of which the first may be shorter. ``ids``
    are little-endian unsigned 32-bit numbers. Repeated rows and null ids are kept.
    """
    added = {"piece": F.lit(0), "start": F.lit(0).cast("long"), "length": F.lit(0).cast("long"), "ids": F.lit(b"")}
    others = [c for c in df.columns if c != text and c not in added]
    schema = df.select(*others).withColumns(added).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1024):
                b = whole.slice(at, 1024)
                row, piece, start, ids = [], [], [], []
                for i, t in enumerate(token_ids([t or "" for t in b.column(0).to_pylist()], path)):
                    tokens = np.append(t, np.uint32(end_id)).astype("<u4")
                    bounds = [0, *range(len(tokens) % capacity or capacity, len(tokens), capacity), len(tokens)]
                    for k, (x, y) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        row.append(i)
                        piece.append(k)
                        start.append(x)
                        ids.append(tokens[x:y].tobytes())
                kept = [b.column(i + 1).take(pa.array(row, pa.int64())) for i in range(len(others))]
                length = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([*kept, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), length, pa.array(ids, pa.binary())], schema.names)
        release()

    return df.select(F.col(text).alias("_text"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(others)]).mapInArrow(cut, schema)


def _price(values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The knapsack's best value for each capacity, and the length that it takes first (0: leave one free)."""
    best, first = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        total = values[1 : room + 1] + best[room - 1 :: -1][:room] if room > 1 else values[1:2] + best[:1]
        k = len(total) - 1 - int(total[::-1].argmax())  # the longest of equal ones
        if total[k] > best[room - 1]:
            best[room], first[room] = total[k], k + 1
        else:
            best[room] = best[room - 1]
    return best, first


def _trace(first: np.ndarray, room: int, config: Config) -> Config:
    while room > 0:
        length = int(first[room])
        if length:
            config[length] = config.get(length, 0) + 1
        room -= length or 1
    return config


def fractional(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[Config, float]]:
    """A solution of the program that covers no length more than its count: configurations and how often.

    A length's weight is its size, which is the price that full sequences pay, lessened as it gets
    covered. A round adds at most ``STEP`` of any length's count, so that prices follow.
    """
    lengths = np.flatnonzero(counts)
    covered = np.zeros(capacity + 1)
    solution: dict[tuple, float] = {}
    for _ in range(rounds):
        open_ = lengths[covered[lengths] < 1 - _NIL]
        if not len(open_):
            break
        values = np.zeros(capacity + 1)
        values[open_] = open_ * np.exp(-RATE * (covered[open_] - covered[open_].min()))
        values /= values.max()
        best, first = _price(values, capacity)
        around = values[open_] + best[capacity - open_]
        room = np.minimum(STEP, 1 - covered)
        for length in open_[np.argsort(-around, kind="stable")]:
            if room[length] < _NIL:
                continue
            config = _trace(first, capacity - int(length), {int(length): 1})
            step = min(counts[k] * room[k] / c for k, c in config.items())
            if step < _NIL:
                continue
            key = tuple(sorted(config.items()))
            solution[key] = solution.get(key, 0) + step
            for k, c in config.items():
                room[k] -= c * step / counts[k]
                covered[k] += c * step / counts[k]
    return [(dict(key), x) for key, x in solution.items()]


def _best_fill(lengths: list[int], counts: np.ndarray, room: int) -> Config:
    """Of the remaining pieces, those that leave the least of ``room``; longer ones where there is a choice."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        for _ in range(min(int(counts[length]), room // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
        if reach >> room & 1:
            break
    at, config = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> at & 1:
            config[length] = config.get(length, 0) + 1
            at -= length
    return config


def _free(config: Config, capacity: int) -> int:
    return capacity - sum(k * c for k, c in config.items())


def rounded(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[Config, int]], np.ndarray]:
    """Configurations of the program and how many sequences have each, and the few pieces that remain.

    Of each solution the whole parts are taken, then fractions are rounded up while counts
    last, those of the fullest configurations first: up to half of the pieces, and as long as
    they are as full as the fullest one or less than a quarter of the pieces is placed. The rest is
    solved again.
    """
    left = counts.astype(np.int64).copy()
    out: list[tuple[Config, int]] = []

    def take(config: Config, n: int) -> int:
        n = min(n, *(int(left[k]) // c for k, c in config.items()))
        if n:
            out.append((config, n))
            for k, c in config.items():
                left[k] -= c * n
        return n * sum(config.values())

    rest = REST * left.sum()
    while left.sum() > rest:
        before = int(left.sum())
        solution = sorted(fractional(left, capacity), key=lambda s: (_free(s[0], capacity), -s[1]))
        placed = sum(take(config, int(x)) for config, x in solution)
        least = _free(solution[0][0], capacity)
        for config, x in solution:
            if 2 * placed > before or (4 * placed > before and _free(config, capacity) > least):
                break
            placed += take(config, math.ceil(x - int(x)))
        if placed < REST * before:
            break  # too few pieces of a length for configurations that hold it more than once
    return out, left


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[Config, int]]:
    """Configurations and how many sequences have each; together they hold ``counts[length]`` of every length."""
    out, left = rounded(counts, capacity)
    lengths = [int(k) for k in np.flatnonzero(left)[::-1]]
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        config = _best_fill(lengths, left, capacity - longest)
        left[longest] += 1
        config[longest] = config.get(longest, 0) + 1
        n = min(int(left[k]) // c for k, c in config.items())
        out.append((config, n))
        for k, c in config.items():
            left[k] -= c * n
        lengths = [k for k in lengths if left[k]]
    return out


@dataclass
class Places:
    """For each length the ranges of ranks that a configuration takes, in order."""

    key: np.ndarray  # length and first rank
    rank: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, configs: list[tuple[Config, int]], capacity: int) -> Places:
        taken = np.zeros(capacity + 1, np.int64)
        rows, sequence = [], 0
        for config, n in configs:
            offset = 0
            for length, each in sorted(config.items(), reverse=True):
                rows.append((length, taken[length], sequence, each, offset))
                taken[length] += each * n
                offset += each * length
            sequence += n
        length, rank, first, each, offset = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        return cls((length << 48) + rank, rank, first, each, offset)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequence and the offset of the pieces of these lengths and ranks."""
        at = np.searchsorted(self.key, (length << 48) + rank, "right") - 1
        within = rank - self.rank[at]
        return self.sequence[at] + within // self.each[at], self.offset[at] + within % self.each[at] * length


def pack(df: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset``: its pieces in as few sequences as it can, gapless from 0.

    ``length`` must be from 1 to ``capacity``. Columns of the two new names are replaced,
    others and repeated rows stay. The pieces are written once with their task and place in
    it, so that a task that runs again can't number them otherwise.
    """
    names = [c for c in df.columns if c not in ("sequence_id", "offset")]
    at = names.index(length)
    inner = [f"_{i}" for i in range(len(names))]
    plain = df.select(*[F.col(c).cast("long").alias(k) if c == length else F.col(c).alias(k) for c, k in zip(names, inner, strict=True)])
    written = stored(plain.withColumns({"_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "pieces")
    ranked = written.withColumn("_rank", F.row_number().over(Window.partitionBy("_task", f"_{at}").orderBy("_row")) - 1)

    by_task = stored(written.groupBy(F.col(f"_{at}").alias("_length"), F.col("_task").alias("_of")).agg(F.count("*").alias("_n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("_length").agg(F.sum("_n").alias("n")).collect():
        counts[row["_length"]] = row["n"]
    places = Places.of(plan(counts, capacity), capacity)
    earlier = Window.partitionBy("_length").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("_length", "_of", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    numbered = ranked.join(bases, (F.col("_task") == F.col("_of")) & (F.col(f"_{at}") == F.col("_length")))

    out = df.select(*names).withColumns({length: F.lit(0).cast("long"), "sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.find(b.column(at).to_numpy(), b.column(len(names)).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], out.names)

    return numbered.select(*inner, (F.col("_rank") + F.col("_base")).alias("_rank")).mapInArrow(place, out)


def assemble(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """``sequence_id, tokens``: the ids of each sequence's pieces, joined in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", ids)))
    return packed.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x[ids])).alias("tokens"))
